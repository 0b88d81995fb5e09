"""Exact n-gram Jaccard join by a blocked sparse product with size-derived bounds.

A document's row of the incidence matrix is its set of distinct shingles (five words, ASCII
case folded; a shorter text is one shingle). Rows with equal sets are taken together first. Only a row's prefix
takes part in the product: its rarest ``n - ceil(3n/4) + 1`` shingles; rarity comes from a counting sketch of
fixed size over all shingles (a coarse count only costs speed). The entries are dealt into blocks of columns, and
columns with one row go.

The product adds up, over the columns, how many two rows share. Behind the prefixes they can share no more
than the rest, and a link asks for ``ceil(3(|a|+|b|)/7)`` shingles: pairs whose sum is below the difference
are discarded, and so are pairs that can't link by their sizes. What is left is compared by the whole texts.

Copies of one text aren't expanded into all pairs. First each column is multiplied with one row only, the one
that is in most columns; a row is compared with its best such pivot, and components are formed. Then the
product runs over all pairs of different components. There a column of many rows is cut into row blocks, and
tasks hand on sums of packed pairs. Rows that share rare shingles without linking all meet in this step: in
each such column it counts the square of its rows, in pieces of at most ``ROW_BLOCK`` by ``ROW_BLOCK``. No
link between different texts is lost.

Texts that are null or without words have an empty set and link with nothing. Repeated rows
and documents with equal sets share a component. Rows that repeat an id with another text are
judged by their own text. Rows without an id take part; a component of nothing else has no id either. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import ASCII_LOWER, components, gram_hashes, map_rows, mixed, texts_of
from corpusloom.llm.postings import BLOCK, Chunks, each_block, runs_of, signed, word_hashes
from corpusloom.plans.lineage import lookup_side, materialize

SHINGLE = 5
#: Counters of the rarity sketch, and the parts in which tasks ship it. Its size doesn't follow the data.
SKETCH_BITS, SKETCH_PARTS = 22, 64
#: Pairs a row above which rows are compared with their best partners before all others. Changes the work only.
FEW = 4
#: Rows compared with one copy of a pivot.
PIVOT_ROWS = 1000
#: Rows of a column that meet in one piece of work, entries of a block of work, pairs that a task adds up at once.
ROW_BLOCK, CELL_ENTRIES, PAIR_FLUSH = 800, 200_000, 1_000_000
#: Rows of a block that are Python objects at the same time.
ROWS_AT_ONCE = 20_000


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles."""
    words = text.encode("utf-8").translate(ASCII_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    return np.unique(gram_hashes(h, min(k, len(h))) + np.uint64(min(k, len(h))))


def set_id(grams: np.ndarray) -> int:
    """A 64-bit name of a set; 0 for the empty one."""
    if not len(grams):
        return 0
    with np.errstate(over="ignore"):
        both = np.array([mixed(grams).sum() + np.uint64(len(grams)), np.bitwise_xor.reduce(mixed(grams + np.uint64(77)))], np.uint64)
        return signed(mixed(both)[0] ^ mixed(mixed(both))[1])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 times the overlap of two sets is at least 75 times their union."""
    small, large = sorted((len(a), len(b)))
    if 4 * small < 3 * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (small + large - both)


def document_sets(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, size, set_id) of every row, stored, and the rarity sketch over all of them."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for doc_id, text in rows:
            grams = shingle_set(text)
            np.add.at(counts, slot(grams), 1)
            yield doc_id, len(grams), set_id(grams), None, None
        for part, c in enumerate(np.split(counts, SKETCH_PARTS)):
            yield None, None, None, part, zlib.compress(np.minimum(c, 255).astype(np.uint8).tobytes(), 1) + zlib.compress(c[c >= 255].tobytes(), 1)

    both = materialize(map_rows(docs.select("doc_id", "text"), run, "doc_id long, size long, set_id long, part int, data binary"), "sets")

    def total(rows: Iterable[tuple]) -> Iterator[tuple]:
        sums: dict[int, np.ndarray] = {}
        for part, data in rows:
            head = zlib.decompressobj()
            c = np.frombuffer(head.decompress(data), np.uint8).astype(np.uint64)
            c[c == 255] = np.frombuffer(zlib.decompress(head.unused_data), np.uint32)
            sums[part] = sums.get(part, np.zeros(len(c), np.uint64)) + c
        for part, c in sums.items():
            yield part, np.minimum(c, 2**32 - 1).astype(np.uint32).tobytes()

    parts = both.where("part is not null").select("part", "data").repartition(SKETCH_PARTS, "part")
    found = {r.part: r.data for r in map_rows(parts, total, "part int, data binary", batch=1).collect()}
    empty = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.uint32).tobytes()
    sketch = np.frombuffer(b"".join(found.get(p, empty) for p in range(SKETCH_PARTS)), np.uint32)
    return both.where("part is null").select("doc_id", "size", "set_id"), sketch


def slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def rare_prefix(grams: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set, as many as the size bounds ask for."""
    n = len(grams)
    return grams[np.lexsort((grams, sketch[slot(grams)]))[: n - -(-3 * n // 4) + 1]]


def meeting_rows(docs: DataFrame, sketch: np.ndarray, blocks: int) -> DataFrame:
    """Columns of the prefixes with more than one row: (gram, set_id, size), stored."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch)  # of fixed size

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        chunks = Chunks(blocks)
        for (text,) in rows:
            grams = shingle_set(text)
            if len(grams):
                yield from chunks.add(rare_prefix(grams, sent.value), set_id(grams), len(grams))
        yield from chunks.flush()

    def meet(keys: np.ndarray, owners: np.ndarray, sizes: np.ndarray) -> Iterator[tuple]:
        once = np.r_[True, (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])]
        keys, owners, sizes = keys[once], owners[once], sizes[once]
        n = runs_of(keys)[1]
        several = np.flatnonzero(np.repeat(n > 1, n))
        for i in range(0, len(several), ROWS_AT_ONCE):
            at = several[i : i + ROWS_AT_ONCE]
            yield from zip(keys[at].view(np.int64).tolist(), owners[at].tolist(), sizes[at].tolist())

    chunks = map_rows(docs.select("text"), run, "block int, data binary", batch=8)
    found = materialize(each_block(chunks, blocks, meet, "gram long, set_id long, size long"), "columns")
    sent.destroy()
    return found


def need(a: F.Column, b: F.Column) -> F.Column:
    """Columns of their prefixes that rows of these sizes must share to link.

    Of the two, the row whose prefix ends at the more frequent shingle has all it shares with the other's prefix
    in its own; behind the other's prefix they share no more than its rest.
    """
    return F.ceil((a + b) * 3 / 7) - F.ceil(F.greatest(a, b) * 3 / 4) + 1


def pivot_overlaps(columns: DataFrame) -> DataFrame:
    """(pivot, other, shared) of rows with the row of their columns that is in most columns.

    The number of shared columns is added up; pairs that can't link by their sizes and this number go.
    """
    degree = lookup_side(materialize(columns.groupBy("set_id").agg(F.count("*").alias("degree")), "degrees"), row_bytes=32)
    heads = columns.join(degree, "set_id").groupBy("gram").agg(F.max(F.struct("degree", "set_id", "size")).alias("p"))
    met = columns.join(heads.select("gram", F.col("p.set_id").alias("pivot"), F.col("p.size").alias("p_size")), "gram")
    met = met.where("pivot != set_id and 4 * size >= 3 * p_size and 4 * p_size >= 3 * size")
    counted = met.groupBy("pivot", F.col("set_id").alias("other"), "size", "p_size").agg(F.count("*").alias("shared"))
    return counted.where(F.col("shared") >= need(F.col("size"), F.col("p_size"))).select("pivot", "other", "shared")


def overlaps(columns: DataFrame) -> DataFrame:
    """(pivot, other, shared) of all pairs of ``columns(gram, set_id, size, component)`` that may link.

    A pair is of different components. Columns are dealt into blocks of work; a column of many
    rows comes as pairs of row blocks. Tasks add up the shared columns of each pair of rows over their
    columns and hand these sums on packed, in ranges of pairs, where they are added; pairs below what
    their sizes ask for are discarded.
    """
    several = columns.groupBy("gram").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    several = several.where("x != y").select("gram", F.ceil(F.col("n") / ROW_BLOCK).cast("int").alias("parts"))
    cells = columns.join(several, "gram").withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int"))
    cells = cells.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select("gram", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"), "part", "set_id", "size", "component")
    cells = materialize(cells, "cells")
    blocks = max(1, cells.count() // CELL_ENTRIES)
    spark = columns.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks)

    def multiply(rows: Iterable[tuple]) -> Iterator[tuple]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def summed() -> Iterator[tuple]:
            a, b, asked = (np.concatenate(x) for x in zip(*held))
            held.clear()
            if not len(a):
                return
            order = np.lexsort((b, a))
            a, b, asked = a[order], b[order], asked[order]
            first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            n = np.diff(np.r_[first, len(a)]).astype(np.uint32)
            a, b, asked = a[first], b[first], asked[first]
            part = (mixed(mixed(a.view(np.uint64)) + b.view(np.uint64)) % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            ends = np.append(np.flatnonzero(np.diff(part[order])) + 1, len(order))
            start = 0
            for end in ends.tolist():
                own = order[start:end]
                yield int(part[own[0]]), a[own].tobytes(), b[own].tobytes(), asked[own].tobytes(), n[own].tobytes()
                start = end

        def cell(rows: list[tuple]) -> tuple[np.ndarray, ...] | None:
            i, j = rows[0][1:3]
            part, ids, sizes, component = (np.array(x, np.int64) for x in zip(*(r[3:] for r in rows)))
            if i == j:
                x, y = np.triu_indices(len(ids), 1)
            else:
                x, y = (v.ravel() for v in np.meshgrid(np.flatnonzero(part == i), np.flatnonzero(part == j), indexing="ij"))
            small, large = np.minimum(sizes[x], sizes[y]), np.maximum(sizes[x], sizes[y])
            fits = (component[x] != component[y]) & (4 * small >= 3 * large)
            x, y, small, large = x[fits], y[fits], small[fits], large[fits]
            asked = -(-3 * (small + large) // 7) - -(-3 * large // 4) + 1
            return np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y]), asked.astype(np.int32)

        here: list[tuple] = []
        for row in rows:
            if here and row[:3] != here[0][:3]:
                held.append(cell(here))
                size += len(held[-1][0])
                here = []
                if size >= PAIR_FLUSH:
                    yield from summed()
                    size = 0
            here.append(row)
        if here:
            held.append(cell(here))
        if held:
            yield from summed()

    def add(rows: Iterable[tuple]) -> Iterator[tuple]:
        now, parts = None, []

        def enough() -> Iterator[tuple]:
            a, b, asked, n = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((b, a))
            a, b, asked, n = a[order], b[order], asked[order], n[order]
            first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            total = np.add.reduceat(n.astype(np.int64), first)
            kept = total >= asked[first]
            yield from zip(a[first][kept].tolist(), b[first][kept].tolist(), total[kept].tolist())

        for r, a, b, asked, n in rows:
            if r != now and parts:
                yield from enough()
                parts = []
            now = r
            parts.append((np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), np.frombuffer(asked, np.int32), np.frombuffer(n, np.uint32)))
        if parts:
            yield from enough()

    work = cells.repartition(blocks, "gram", "i", "j").sortWithinPartitions("gram", "i", "j")
    sums = map_rows(work, multiply, "part int, a binary, b binary, asked binary, n binary", batch=50)
    dealt = sums.repartition(ranges, "part").sortWithinPartitions("part")
    return map_rows(dealt, add, "pivot long, other long, shared long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs(pivot, other)`` that link, as (a, b), by the overlap of both texts.

    The pivot's row goes to each of its row blocks, ahead of the rows it is compared with.
    """
    n = pairs.groupBy("pivot").agg(F.count("*").alias("n")).withColumn("salts", F.ceil(F.col("n") / PIVOT_ROWS).cast("int"))
    salt = F.pmod(F.xxhash64("other"), F.col("salts")).cast("int")
    others = pairs.join(n, "pivot").select("pivot", salt.alias("salt"), F.lit(1).alias("place"), F.col("other").alias("set_id"))
    own = n.select("pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("place"), F.col("pivot").alias("set_id"))
    asked = lookup_side(materialize(others.unionByName(own), "asked"), row_bytes=48)
    rows = texts.join(asked, "set_id").repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "place")

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        now, pivot_grams = None, np.empty(0, np.uint64)
        for pivot, salt, place, other, text in rows:
            if (pivot, salt) != now:
                now, pivot_grams = (pivot, salt), np.empty(0, np.uint64)
            grams = shingle_set(text)
            if set_id(grams) != other:  # another text under the same document id
                continue
            if place == 0:
                pivot_grams = grams
            elif linked(pivot_grams, grams):
                yield pivot, other

    return map_rows(rows.select("pivot", "salt", "place", "set_id", "text"), run, "a long, b long")


def best_partners(pairs: DataFrame) -> DataFrame:
    """Each row's pair with the partner of most shared columns."""
    return materialize(pairs.groupBy("other").agg(F.max_by("pivot", F.struct("shared", "pivot")).alias("pivot")), "chosen")


def compared(pairs: DataFrame, first: DataFrame, docs: DataFrame) -> DataFrame:
    """The links among ``pairs(pivot, other)``, stored; only texts of their rows are moved."""
    ends = pairs.select(F.col("pivot").alias("set_id")).union(pairs.select("other")).distinct()
    wanted = lookup_side(materialize(ends.join(first, "set_id"), "wanted"), row_bytes=32)
    texts = texts_of(docs, wanted, "set_id", "long", lambda text: set_id(shingle_set(text))).select("set_id", "text")
    return materialize(verified(pairs, materialize(texts, "texts")), "links")


def labels(links: DataFrame) -> DataFrame:
    """(node, component) of all rows with a link, stored."""
    return materialize(components(links), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; the component is its smallest linked document id."""
    return classes(docs).select("doc_id", F.col("size").alias("n_shingles"), "component_id")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, set_id, component, component_id) of every row; empty sets have no component."""
    sets, sketch = document_sets(docs)
    # A quarter of the shingles is dealt into blocks.
    entries = sets.agg(F.sum("size")).first()[0] or 0
    columns = meeting_rows(docs, sketch, max(1, entries // 4 // BLOCK))
    first = sets.where("size > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    # A row hangs together with its best pivot, if with any: one text a row.
    links = compared(best_partners(pivot_overlaps(columns)), first, docs)
    label = labels(links)
    component = F.coalesce("component", "set_id").alias("component")
    known = lookup_side(label, row_bytes=32)
    columns = columns.join(known, columns.set_id == known.node, "left").select("gram", "set_id", "size", component)
    # What that doesn't show: all other pairs, across components.
    pairs = materialize(overlaps(columns), "pairs")
    if pairs.count() > FEW * pairs.select("other").distinct().count():
        links = links.unionByName(compared(best_partners(pairs), first, docs))
        label = labels(links)
        of = label.select(F.col("node").alias("pivot"), F.col("component").alias("x"))
        left = pairs.join(of, "pivot", "left").join(label.select(F.col("node").alias("other"), F.col("component").alias("y")), "other", "left")
        pairs = materialize(left.where(F.coalesce("x", "pivot") != F.coalesce("y", "other")).select("pivot", "other", "shared"), "pairs")
    if not pairs.isEmpty():
        links = links.unionByName(compared(pairs.select("pivot", "other"), first, docs))
        label = labels(links)
    named = first.join(label, first.set_id == label.node, "left").select("set_id", F.coalesce("component", "set_id").alias("component"), "doc_id")
    lowest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of = named.join(lowest, "component").select("set_id", "component", "component_id")
    empty = F.col("size") == 0
    full = sets.where(~empty).join(of, "set_id").select("doc_id", "size", "set_id", "component", "component_id")
    alone = sets.where(empty).select("doc_id", "size", "set_id", F.lit(None).cast("long"), F.col("doc_id"))
    return full.union(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest id; texts without words all stay.

    Of a class's rows with that id, or of those of a class without ids, the smallest text stays.
    """
    found = materialize(classes(docs), "classes")
    full = found.where("size > 0")
    id_first = F.struct(F.col("doc_id").isNull(), "doc_id", "set_id")
    best = full.groupBy("component").agg(F.min(id_first).alias("b")).select(F.col("b.doc_id").alias("id"), F.col("b.set_id").alias("set"))
    best = materialize(best, "best")
    times = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    repeated = materialize(times.where("n > 1").select(F.col("doc_id").alias("id")), "repeated")
    kept = best.where("id is not null").select("id").union(found.where("size = 0 and doc_id is not null").select("doc_id"))
    # Rows travel as one column, so that no column of theirs meets one of ours.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select("row", F.col("row.doc_id").alias("of"))
    single = rows.join(kept.join(repeated, "id", "left_anti"), F.col("of") == F.col("id"), "left_semi")
    # Rows whose id doesn't tell them apart are chosen by their set.
    same = rows.where("of is null")
    if not repeated.isEmpty():
        same = same.unionByName(rows.join(repeated, F.col("of") == F.col("id"), "left_semi"))

    # Spark would move the filters on a repeatable function below the column and call it there once more: two Python
    # workers a core in one stage, which then stay.
    set_of = F.udf(lambda text: set_id(shingle_set(text)), "long").asNondeterministic()
    same = same.withColumns({"text": F.col("row.text"), "own": set_of("row.text")})
    chosen = same.where("own != 0").join(best, F.col("of").eqNullSafe(F.col("id")) & (F.col("own") == F.col("set")), "left_semi")
    chosen = chosen.groupBy("of", "own").agg(F.min_by("row", "text").alias("row"))
    every = single.select("row").unionByName(chosen.select("row")).unionByName(same.where("own = 0").select("row"))
    return every.select("row.*")
