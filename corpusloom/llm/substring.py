"""Exact removal of repeated passages, found by backward search in one FM-index per shard.

Every window of ``width`` words has a content-defined anchor: the smallest hash among its
runs of eight words. Equal windows have equal anchors, so an anchor at one place of the corpus only
rules out all of its windows. Stretches of text around the remaining anchors are dealt by anchor into
shards of bounded size, equal stretches as one with their number. Each shard is indexed
(wavelet matrix over the Burrows-Wheeler transform of its words) and its stretches are streamed
through backward search, whose matching statistics give the passages that occur twice. Windows with
one of the most frequent anchors (a very common line, say) are dealt by their smallest other hash, too.

Words are maximal runs without ASCII white space, compared as they are. A window repeats if its words
start anywhere else, in the same document too; windows are judged on the input. Texts that are null
or have fewer words than a window keep all. Equal texts are taken together and get equal results,
repeated rows therefore lose everything from ``width`` words on. Empty tables give empty results;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import gram_hashes, map_rows, mixed, texts_of, words
from corpusloom.llm.fm_index import merged, repeated_windows
from corpusloom.llm.postings import BLOCK, Chunks, each_block, runs_of, signed, word_hashes
from corpusloom.plans.lineage import bounded_rows, materialize

WIDTH = 35
#: Words of an anchor.
ANCHOR = 8
#: Words of a shard on average.
SHARD_WORDS = 600_000
#: An anchor is frequent if it has more places than this, and more than this share of all; so at most 10,000 are.
MANY, SHARE = 500, 1 / 10_000
TOP = np.uint64(1 << 63)


def anchors(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of each window, and the eight-word hashes, from word hashes."""
    grams = gram_hashes(h, min(ANCHOR, width))
    return lowest(grams, width), grams


def lowest(grams: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of the runs inside each window."""
    low, span = grams, 1
    want = width - min(ANCHOR, width) + 1
    while span < want:
        step = min(span, want - span)
        low = np.minimum(low[: len(low) - step], low[step:])
        span += step
    return low


def dealt_by(low: np.ndarray, grams: np.ndarray, frequent: np.ndarray, width: int) -> np.ndarray:
    """What each window is dealt by: its anchor, or that and another hash if the anchor is frequent."""
    often = np.isin(grams, frequent)
    if not often.any():
        return low
    other = lowest(np.where(often, grams | TOP, grams & ~TOP), width)
    return np.where(np.isin(low, frequent), mixed(low ^ mixed(other)), low)


def anchor_places(h: np.ndarray, width: int) -> np.ndarray:
    """Anchor hashes, once for each place that is an anchor of some window."""
    low, grams = anchors(h, width)
    if not len(low):
        return low
    reach = len(grams) - len(low) + 1
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), low, np.zeros(reach - 1, np.uint64)])
    high, span = padded, 1
    while span < reach:
        step = min(span, reach - span)
        high = np.maximum(high[: len(high) - step], high[step:])
        span += step
    return grams[high == grams]


def digest_of(w: list[bytes]) -> str:
    """The digest of all words of a text."""
    return hashlib.sha256(b" ".join(w)).hexdigest()


def document_table(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_words, whole, places): the digest of all words and the anchors of every row, stored."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            w = words(text)
            places = anchor_places(word_hashes(w), width) if len(w) >= width else np.empty(0, np.uint64)
            yield doc_id, len(w), digest_of(w), places.tobytes()

    schema = "doc_id long, n_words long, whole string, places binary"
    return materialize(map_rows(docs.select("doc_id", "text"), run, schema, batch=500), "words")


def repeated_anchors(texts: DataFrame, blocks: int, many: int) -> DataFrame:
    """(owner, anchors) of ``texts(owner, places, copies)``: anchors at two places or more, block by block.

    Rows without an owner hold the anchors at more than ``many`` places.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        chunks = Chunks(blocks)
        for owner, places, copies in rows:
            yield from chunks.add(np.frombuffer(places, np.uint64), owner, min(copies, 2))
        yield from chunks.flush()

    def repeated(keys: np.ndarray, owners: np.ndarray, copies: np.ndarray) -> Iterator[tuple]:
        starts, n = runs_of(keys)
        if len(starts):
            often = n > many
            if often.any():
                yield None, keys[starts[often]].tobytes()
            several = np.repeat(np.add.reduceat(copies, starts) > 1, n)
            keys, owners = keys[several], owners[several]
            order = np.argsort(owners, kind="stable")
            keys, owners = keys[order], owners[order]
            starts, n = runs_of(owners)
            for s, k in zip(starts.tolist(), n.tolist()):
                yield int(owners[s]), np.unique(keys[s : s + k]).tobytes()

    chunks = map_rows(texts.select("owner", "places", "copies"), run, "block int, data binary", batch=8)
    return materialize(each_block(chunks, blocks, repeated, "owner long, anchors binary", batch=2000), "anchors")


def stretches(docs: DataFrame, frequent: np.ndarray, width: int) -> DataFrame:
    """(whole, start, anchor, digest, stretch, copies) for each run of windows with a repeated anchor."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for text, whole, copies, parts in rows:
            w = words(text)
            if digest_of(w) != whole:  # another text under the same id
                continue
            low, grams = anchors(word_hashes(w), width)
            wanted = np.isin(low, np.concatenate([np.frombuffer(p, np.uint64) for p in parts]))
            low = dealt_by(low, grams, frequent, width)
            edges = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (wanted[1:] != wanted[:-1])])
            ends = np.r_[edges[1:], len(low)]
            for a, b in zip(edges.tolist(), ends.tolist()):
                if wanted[a]:
                    stretch = b" ".join(w[a : b - 1 + width])
                    digest = int.from_bytes(hashlib.blake2b(stretch, digest_size=8).digest(), "little", signed=True)
                    yield whole, a, signed(low[a]), digest, stretch.decode(), min(copies, 2)

    schema = "whole string, start long, anchor long, digest long, stretch string, copies long"
    return materialize(map_rows(docs.select("text", "whole", "copies", "parts"), run, schema), "stretches")


def search_shards(distinct: DataFrame, n_shards: int, width: int) -> DataFrame:
    """(anchor, digest, spans) of stretches that hold a repeated window; spans are word ranges, flat."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        now, held = None, []
        for shard, *row in rows:
            if shard != now and held:
                yield from searched(held)
                held = []
            now = shard
            held.append(row)
        if held:
            yield from searched(held)

    def searched(rows: list) -> Iterator[tuple]:
        ids: dict[bytes, int] = {}
        seqs = [np.fromiter((ids.setdefault(w, len(ids) + 1) for w in words(r[2])), np.int64) for r in rows]
        spans = repeated_windows(seqs, [r[3] for r in rows], len(ids) + 1, width)
        for (anchor, digest, _, _), found in zip(rows, spans):
            if found:
                yield anchor, digest, [x for span in found for x in span]

    dealt = distinct.repartition(n_shards, "shard").sortWithinPartitions("shard", "anchor", "digest")
    rows = dealt.select("shard", "anchor", "digest", "stretch", "copies")
    return map_rows(rows, run, "anchor long, digest long, spans array<long>")


def repeated_spans(docs: DataFrame, table: DataFrame, width: int = WIDTH) -> DataFrame:
    """(whole, spans): word ranges [a, b), flat, to remove from each text that holds any."""
    once = table.where(F.col("n_words") >= width).groupBy("whole").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    once = materialize(once.withColumn("owner", F.xxhash64("whole")), "once")
    same = table.doc_id.eqNullSafe(once.doc_id) & (table.whole == once.whole)
    texts = table.join(once, same).select(once.owner, once.whole, "places", "copies").dropDuplicates(["whole"])
    n_words = table.agg(F.sum("n_words")).first()[0] or 0
    # About two anchor places in 29 words.
    places = n_words // 14
    found = repeated_anchors(texts, max(1, places // BLOCK), max(MANY, int(places * SHARE)))
    frequent = [r.anchors for r in bounded_rows(found.where("owner is null"), int(4 / SHARE), "frequent anchors")]
    frequent = np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(x, np.uint64) for x in frequent]])
    found = found.where("owner is not null").groupBy("owner").agg(F.collect_list("anchors").alias("parts"))
    chosen = texts_of(docs, found.join(once, "owner"), "whole", "string", lambda text: digest_of(words(text)))
    all_stretches = stretches(chosen, frequent, width)
    distinct = all_stretches.groupBy("anchor", "digest", "stretch").agg(F.sum("copies").alias("copies"))
    distinct = materialize(distinct, "distinct")
    size = distinct.agg(F.sum(F.length("stretch")).alias("c")).first()[0] or 0
    n_shards = max(1, int(size) // 6 // SHARD_WORDS)
    shards = distinct.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(n_shards)))
    found = search_shards(shards, n_shards, width)
    per_text = all_stretches.select("whole", "start", "anchor", "digest").join(found, ["anchor", "digest"])
    moved = per_text.select("whole", F.transform("spans", lambda x: x + F.col("start")).alias("spans"))
    return moved.groupBy("whole").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans) of every row; spans are the removed word ranges."""
    table = document_table(docs, width)
    spans = materialize(repeated_spans(docs, table, width), "spans")

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for text, whole, flat in rows:
            w = words(text)
            if digest_of(w) != whole:
                continue
            found = merged(list(zip(flat[::2], flat[1::2])))
            kept, at = [], 0
            for a, b in found:
                kept += w[at:a]
                at = b
            kept += w[at:]
            yield whole, len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), [x for s in found for x in s]

    one = table.groupBy("whole").agg(F.min("doc_id").alias("doc_id")).join(spans, "whole")
    texts = texts_of(docs, one, "whole", "string", lambda text: digest_of(words(text))).select("text", "whole", "spans")
    cut = map_rows(texts, run, "whole string, n_removed long, kept_sha256 string, spans array<long>").dropDuplicates(["whole"])
    return table.join(cut, "whole", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        F.coalesce("spans", F.expr("cast(array() as array<bigint>)")).alias("spans"),
    )
