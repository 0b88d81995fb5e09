"""n-gram language models held as count tables."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.vector import NEG_INF, POS_INF, safe_log
from corpusloom.plans.lineage import bounded_rows, lookup_side, materialize

CHUNK_TOKENS = 4_000_000  # tokens whose windows a task deals out at once
CELL_BYTES, MAX_CELLS = 2 << 20, 512  # estimated bytes of tokens to a cell of windows, and the most cells
OUT_ROWS = 50_000  # counted rows that leave Python at once
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"  # bytes of rows that reach Python at once


@dataclass(frozen=True)
class LanguageModel:
    """``ngrams(context, word, cnt)``, ``contexts(context, cnt)`` and ``vocab(word)``.

    A context is one string, its n-1 words separated by blanks.
    """

    n: int
    ngrams: DataFrame
    contexts: DataFrame
    vocab: DataFrame

    @property
    def vocab_size(self) -> DataFrame:
        """One-row table with the number of distinct tokens, boundary marks included."""
        return self.vocab.agg(F.count("*").alias("vocab_size"))

    @property
    def total_tokens(self) -> DataFrame:
        """One-row table with the number of predictions counted."""
        return self.contexts.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("total_tokens"))


def count_orders(docs: DataFrame, orders: list[int]) -> DataFrame:
    """``(n, context, word, cnt)`` for several orders in one pass over the tokens.

    A window of a lower order is the end of the longest one at the same place. So several orders from 2 on shuffle only
    the longest windows, by the words of the shortest one, and count all orders where these meet.
    """
    if 2 <= min(orders) < max(orders):
        return _count_nested_orders(docs, orders)

    def numbered(n: int):
        tag = lambda w: F.struct(F.lit(n).alias("n"), w["context"].alias("context"), w["word"].alias("word"))
        return F.transform(T.next_word_windows(F.col("tokens"), n), tag)

    parts = [numbered(n) for n in orders]
    each = parts[0] if len(parts) == 1 else F.concat(*parts)
    # A condition, not a filter: a filter would be pushed below a repartitioning and
    # tokenise the texts twice.
    return (
        docs.select(F.explode(F.when(F.size("tokens") > 0, each)).alias("w"))
        .select("w.*")
        .groupBy("n", "context", "word")
        .agg(F.count("*").alias("cnt"))
    )


def _count_nested_orders(docs: DataFrame, orders: list[int]) -> DataFrame:
    """``count_orders`` with the longest windows only in the shuffle, as compressed blocks of word numbers.

    A task numbers the words of about ``CHUNK_TOKENS`` tokens and deals their windows out to cells by the words that all
    orders share. A cell's blocks meet in one task, which sorts the windows once: those that agree in their last n words
    lie behind each other.
    """
    spark, least, most = docs.sparkSession, min(orders), max(orders)
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, "4m")
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cells = min(MAX_CELLS, max(16, size // CELL_BYTES))  # an estimate: it decides on the memory of a task, not on results

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        n = 0
        for batch in batches:
            held.append(batch.column(0))
            n += len(held[-1].flatten())
            if n >= CHUNK_TOKENS:
                yield from _window_blocks(held, least, most, cells)
                held, n = [], 0
        if n:
            yield from _window_blocks(held, least, most, cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column("blocks"):
                yield from _counted(row.as_py(), orders, least)

    said = docs.select(F.when(F.size("tokens") > 0, F.col("tokens")).alias("tokens"))
    blocks = said.mapInArrow(deal, "cell int, block binary")
    met = blocks.groupBy("cell").agg(F.collect_list("block").alias("blocks")).select("blocks")
    return met.mapInArrow(count, "n int, context string, word string, cnt bigint")


def _window_blocks(held: list[pa.Array], least: int, most: int, cells: int) -> Iterator[pa.RecordBatch]:
    """Blocks ``(cell, block)`` of the padded windows of token arrays, each word of a block held once."""
    lengths = np.concatenate([pc.list_value_length(x).drop_null().to_numpy() for x in held])
    lengths = lengths[lengths > 0].astype(np.int64)
    flat = pa.concat_arrays([pa.array([T.START, T.END]), *[x.flatten().cast(pa.string()) for x in held]])
    coded = flat.dictionary_encode(null_encoding="encode")
    words, numbers = coded.dictionary, coded.indices.to_numpy()
    # Each text: start marks, tokens, one end mark.
    sizes = lengths + most
    starts = np.cumsum(sizes) - sizes + most - 1
    stream = np.zeros(int(sizes.sum()), np.int32)
    place = np.arange(len(numbers) - 2) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    stream[place] = numbers[2:]
    stream[starts + lengths] = 1
    place = np.sort(np.concatenate([place, starts + lengths]))
    hashes = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) if w is not None else 1 for w in words.to_pylist()], np.uint64)
    mixed = np.zeros(len(place), np.uint64)
    for k in range(least):
        mixed = (mixed + hashes[stream[place - k]]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    cell = (mixed % np.uint64(cells)).astype(np.int32)
    place = place[np.lexsort((stream[place], cell))]
    ends = np.cumsum(np.bincount(cell, minlength=cells))
    for c in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
        own = place[ends[c - 1] if c else 0 : ends[c]]
        windows = np.stack([stream[own - k] for k in range(most)])
        used, local = np.unique(windows, return_inverse=True)
        said = words.take(pa.array(used)).to_pylist()
        order = sorted(range(len(said)), key=lambda i: said[i] or "")  # like words behind each other take less space
        rank = np.empty(len(said), np.int64)
        rank[order] = np.arange(len(said))
        block = _packed([said[i] for i in order], rank[local.reshape(windows.shape)])
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([block], pa.binary())], names=["cell", "block"])


def _packed(words: list[str | None], windows: np.ndarray) -> bytes:
    """Words and windows (places x windows) as compressed bytes."""
    plain = not any(w is None or "\n" in w for w in words)
    text = ("\n".join(words) if plain else json.dumps(words)).encode()
    small = windows.astype(np.uint16 if len(words) <= 1 << 16 else np.uint32)
    head = np.array([plain, len(text), small.itemsize, len(small)], np.int64)
    whole = head.tobytes() + text + small.tobytes()
    return len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def _unpacked(block: bytes) -> tuple[pa.Array, np.ndarray]:
    """What ``_packed`` was given."""
    whole = pa.decompress(block[8:], decompressed_size=int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    plain, size, itemsize, places = np.frombuffer(whole, np.int64, 4).tolist()
    text = whole[32 : 32 + size].decode()
    words = pa.array(text.split("\n") if plain else json.loads(text), pa.string())
    return words, np.frombuffer(whole, np.uint16 if itemsize == 2 else np.uint32, offset=32 + size).reshape(places, -1)


def _counted(blocks: list[bytes], orders: list[int], least: int) -> Iterator[pa.RecordBatch]:
    """``(n, context, word, cnt)`` of all windows of a cell."""
    parts = [_unpacked(b) for b in blocks]
    coded = pa.concat_arrays([w for w, _ in parts]).dictionary_encode(null_encoding="encode")
    words, numbers = coded.dictionary, coded.indices.to_numpy()
    first = np.cumsum([0] + [len(w) for w, _ in parts])
    back = np.concatenate([numbers[at : at + len(w)][x] for at, (w, x) in zip(first, parts)], axis=1)
    del parts
    # Two places make a key, so that fewer are sorted by.
    keys = [back[i].astype(np.int64) * len(words) + back[i + 1] if i + 1 < len(back) else back[i] for i in range(0, len(back), 2)]
    back = back[:, np.lexsort(keys[::-1])]
    del keys
    # Only without nulls and blanks in words do equal contexts mean equal words.
    apart = words.null_count or pc.any(pc.match_substring(words, " ")).as_py()
    new = np.zeros(back.shape[1], bool)
    new[0] = True
    for n in range(1, max(orders) + 1):
        new[1:] |= back[n - 1, 1:] != back[n - 1, :-1]
        if n not in orders:
            continue
        at = np.flatnonzero(new)
        cnt = np.diff(at, append=len(new))
        for i in range(0, len(at), OUT_ROWS) if not apart else [0]:
            some = at[i : i + OUT_ROWS] if not apart else at
            said = [words.take(pa.array(back[k, some])) for k in range(n)]
            if words.null_count:
                rows = zip(*[x.to_pylist() for x in said[:0:-1]])
                context = pa.array([" ".join(w for w in row if w is not None) for row in rows], pa.string())
            else:
                context = pc.binary_join_element_wise(*said[:0:-1], " ")
            found = pa.table({"context": context, "word": said[0], "cnt": cnt[i : i + len(some)], **{f"back{k}": said[k] for k in range(1, least)}})
            if apart:
                keys = [c for c in found.column_names if c != "cnt"]
                found = found.group_by(keys, use_threads=False).aggregate([("cnt", "sum")]).rename_columns({"cnt_sum": "cnt"})
            found = found.select(["context", "word", "cnt"]).add_column(0, "n", pa.repeat(pa.scalar(n, pa.int32()), len(found)))
            yield from found.to_batches(OUT_ROWS)


def vocab_of(ngrams: DataFrame) -> DataFrame:
    """Distinct words of an n-gram table, boundary marks included."""
    several = F.array_append(F.split("context", " "), F.col("word"))
    words = F.when(F.contains(F.col("context"), F.lit(" ")), several).otherwise(F.array("context", "word"))
    return ngrams.select(F.explode(words).alias("word")).where(F.col("word") != "").distinct()


def model_of(ngrams: DataFrame, n: int) -> LanguageModel:
    """A model from ``(context, word, cnt)``."""
    contexts = ngrams.groupBy("context").agg(F.sum("cnt").alias("cnt"))
    return LanguageModel(n, ngrams, contexts, vocab_of(ngrams))


def train(docs: DataFrame, n: int = 2) -> LanguageModel:
    """Count the n-grams of all padded, non-empty token sequences; counts, contexts and vocabulary are stored."""
    model = model_of(materialize(count_orders(docs, [n]).drop("n"), "lm-ngrams"), n)
    return replace(model, contexts=materialize(model.contexts, "lm-contexts"), vocab=materialize(model.vocab, "lm-vocab"))


def train_orders(docs: DataFrame, orders: list[int]) -> dict[int, LanguageModel]:
    """Models of several orders from one stored pass over the tokens."""
    ngrams = materialize(count_orders(docs, orders), "lm-orders")
    return {n: model_of(ngrams.where(F.col("n") == n).drop("n"), n) for n in orders}


def add_counts(model: LanguageModel, more: LanguageModel) -> LanguageModel:
    """The model after training on further text: counts add up, vocabularies unite."""
    ngrams = (
        model.ngrams.unionByName(more.ngrams).groupBy("context", "word").agg(F.sum("cnt").alias("cnt"))
    )
    return model_of(ngrams, model.n)


def with_probability(pairs: DataFrame, model: LanguageModel, smoothing: bool = True) -> DataFrame:
    """Append ``p`` to rows with ``context`` and ``word``.

    Add-one: (c + 1) / (C + V), 0 for an empty vocabulary. Otherwise c / C, 0 for an
    unseen context. While the distinct pairs are few, the stored counts are cut down to them before the
    joins, so that the model is scanned and not shuffled.
    """
    asked = materialize(pairs.select("context", "word").distinct(), "lm-pairs")
    few, ngrams, contexts = lookup_side(asked, row_bytes=192), model.ngrams, model.contexts
    if few is not asked:
        ngrams = ngrams.join(few, ["context", "word"], "left_semi")
        contexts = contexts.join(F.broadcast(asked.select("context").distinct()), "context", "left_semi")
    v = F.coalesce(model.vocab_size.scalar(), F.lit(0)).cast("double")
    c = F.coalesce(F.col("_c"), F.lit(0)).cast("double")
    total = F.coalesce(F.col("_total"), F.lit(0)).cast("double")
    p = F.try_divide(c + 1.0, total + v) if smoothing else F.try_divide(c, total)
    if smoothing:
        p = F.when(v > 0, p)
    return (
        pairs.join(ngrams.withColumnRenamed("cnt", "_c"), ["context", "word"], "left")
        .join(contexts.withColumnRenamed("cnt", "_total"), "context", "left")
        .withColumn("p", F.coalesce(p, F.lit(0.0)))
        .drop("_c", "_total")
    )


def sequence_scores(docs: DataFrame, model: LanguageModel, smoothing: bool = True) -> DataFrame:
    """Log likelihood, probability and perplexity per token sequence.

    An empty sequence has log likelihood 0 and perplexity +Infinity; one impossible
    word makes the log likelihood -Infinity, the probability 0 and the perplexity
    +Infinity.
    """
    windows = F.when(F.size("tokens") > 0, T.next_word_windows(F.col("tokens"), model.n))
    pairs = docs.select("doc_id", F.explode_outer(windows).alias("w")).select(
        "doc_id", "w.context", "w.word", F.col("w").isNotNull().alias("_said")
    )
    scored = with_probability(pairs, model, smoothing)
    per_doc = scored.groupBy("doc_id").agg(
        F.count_if("_said").alias("n_predictions"),
        F.coalesce(F.bool_or(F.col("_said") & (F.col("p") <= 0)), F.lit(False)).alias("_impossible"),
        F.coalesce(F.sum(F.when(F.col("_said") & (F.col("p") > 0), F.log("p"))), F.lit(0.0)).alias("_ll"),
    )
    ll = F.when(F.col("_impossible"), F.lit(NEG_INF)).otherwise(F.col("_ll"))
    perplexity = F.when((F.col("n_predictions") == 0) | F.col("_impossible"), F.lit(POS_INF)).otherwise(
        F.exp(-F.try_divide(F.col("_ll"), F.col("n_predictions")))
    )
    return per_doc.select(
        "doc_id",
        "n_predictions",
        ll.alias("log_likelihood"),
        F.when(F.col("_impossible"), F.lit(0.0)).otherwise(F.exp("_ll")).alias("probability"),
        perplexity.alias("perplexity"),
    )


def predict_next_words(
    contexts: DataFrame, model: LanguageModel, top_k: int = 5, smoothing: bool = True
) -> DataFrame:
    """The ``top_k`` most probable next words for each distinct ``context``.

    Ties go to the smaller word. With smoothing every vocabulary word is a candidate,
    but unseen words all share the lowest probability: they only fill up contexts with
    fewer than ``top_k`` seen words, and then the alphabetically first 2*top_k words
    of the vocabulary always suffice.
    """
    asked = materialize(contexts.select("context").distinct(), "lm-asked")
    ranked = Window.partitionBy("context").orderBy(F.col("cnt").desc(), "word")

    def best_words(ngrams: DataFrame) -> DataFrame:
        return ngrams.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_k)

    # Each task keeps only its own best words of a context before the shuffle. That needs
    # the ranking to come straight after the scan or a broadcast, not after a shuffle join
    # that gathers a frequent context in one task.
    few = lookup_side(asked, row_bytes=128)
    if few is not asked:
        seen = best_words(model.ngrams.join(few, "context", "left_semi"))
    else:
        seen = best_words(model.ngrams).join(asked, "context", "left_semi")
    totals = asked.join(model.contexts.withColumnRenamed("cnt", "total"), "context", "left")
    if not smoothing:
        p = F.col("cnt") / F.col("total").cast("double")
        return seen.join(totals, "context").select("context", "rank", "word", p.alias("p"))

    v = model.vocab_size.scalar()
    first = bounded_rows(model.vocab.orderBy("word").limit(2 * top_k), 2 * top_k, "fill words")
    fill_words = F.array(*[F.lit(r["word"]) for r in first]).cast("array<string>")
    # All seen words of a context with fewer than top_k of them are in `seen`.
    by_context = totals.join(
        seen.groupBy("context").agg(F.collect_list(F.struct("word", "cnt")).alias("_seen")), "context", "left"
    ).withColumn("_seen", F.coalesce("_seen", F.array().cast("array<struct<word:string,cnt:bigint>>")))
    unseen = F.when(
        F.size("_seen") < top_k,
        F.transform(
            F.array_except(fill_words, F.transform("_seen", lambda s: s["word"])),
            lambda w: F.struct(w.alias("word"), F.lit(0).cast("bigint").alias("cnt")),
        ),
    ).otherwise(F.array().cast("array<struct<word:string,cnt:bigint>>"))
    order = F.transform(
        F.concat("_seen", unseen),
        lambda s: F.struct((-s["cnt"]).alias("neg"), s["word"].alias("word")),
    )
    best = F.slice(F.array_sort(order), 1, top_k)
    p = (1.0 - F.col("_b.neg")) / (F.coalesce("total", F.lit(0)) + v).cast("double")
    return (
        by_context.select("context", "total", F.posexplode(best).alias("_i", "_b"))
        .select("context", (F.col("_i") + 1).alias("rank"), F.col("_b.word").alias("word"), p.alias("p"))
    )
