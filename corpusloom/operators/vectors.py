"""Word vectors: lookup, similarity, neighbours and pooling into document vectors.

A vector table is any DataFrame with ``word`` and ``vec ARRAY<DOUBLE or FLOAT>``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions import vector as V
from corpusloom.operators.counts import term_counts
from corpusloom.plans.lineage import BROADCAST_BYTES, lookup_side, materialize

POOL_BYTES = BROADCAST_BYTES  # counted size of the vectors that are looked up at once when they are pooled
PART_TOKENS = 2_500_000  # tokens of a part of the corpus that one task trains on


def check_vectors(vectors: DataFrame) -> None:
    """Reject anything that is not a (word, vec) table."""
    missing = {"word", "vec"} - set(vectors.columns)
    if missing:
        raise TypeError(f"a vector table needs columns word and vec; missing {sorted(missing)}")


def get_embedding(words: DataFrame, vectors: DataFrame, fold_case: bool = False) -> DataFrame:
    """Vector of each word, null where unknown; ``fold_case`` looks up the lower-case word."""
    check_vectors(vectors)
    key = F.lower("word") if fold_case else F.col("word")
    found = vectors.select(F.col("word").alias("_key"), "vec")
    return words.withColumn("_key", key).join(found, "_key", "left").drop("_key")


def vector_subset(vectors: DataFrame, vocab: DataFrame) -> DataFrame:
    """Vectors of the words listed in ``vocab(term)``."""
    check_vectors(vectors)
    return vectors.join(vocab.select(F.col("term").alias("word")), "word", "left_semi")


def similarities(vectors: DataFrame, word: str) -> DataFrame:
    """Cosine of every other vector with that of ``word``.

    Empty if the word is unknown or its vector is zero. Only the query vector passes
    through the driver; the table is scanned once, without a join or a shuffle.
    """
    check_vectors(vectors)
    found = vectors.where(F.col("word") == word).select("vec").first()
    if found is None or not any(found["vec"]):
        return vectors.limit(0).select("word", F.lit(0.0).alias("similarity"))
    query = F.lit([float(x) for x in found["vec"]])
    return vectors.where(F.col("word") != word).select(
        "word", V.cosine_similarity(F.col("vec"), query).alias("similarity")
    )


def nearest_neighbors(vectors: DataFrame, word: str, top_k: int = 5) -> DataFrame:
    """The ``top_k`` words most similar to ``word``, ties to the smaller word."""
    return similarities(vectors, word).orderBy(F.col("similarity").desc(), "word").limit(top_k)


def nearest_of(words: DataFrame, vectors: DataFrame, top_k: int = 5, block_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """``(query, rank, word, similarity)``: the ``top_k`` words most similar to each of ``words(word)``, without itself.

    Queries travel in blocks of at most ``block_bytes`` of vectors, each against the whole table; a task multiplies
    its rows with a block and keeps the best of each query, so pairs are never rows. Similarities equal to
    twelve decimals rank by the smaller word. Unknown words and zero vectors have no neighbours; a zero vector
    in the table has similarity 0. A repeated query counts once.
    """
    check_vectors(vectors)
    table = vectors.select("word", F.col("vec").cast("array<double>").alias("vec"))
    asked = materialize(table.join(words.select("word").distinct(), "word", "left_semi"), "queries")
    asked = asked.where(F.exists("vec", lambda x: x != 0))
    size = asked.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    per_block = max(1, block_bytes // (8 * (size["d"] or 1)))
    blocks = max(1, -(-size["n"] // per_block))
    schema = "query string, word string, similarity double"

    def best_in(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, queries = shared.value
            best: list[list[tuple[float, str]]] = [[] for _ in names]
            for batch in batches:
                if not batch.num_rows:
                    continue
                given = batch.column("word").to_pylist()
                x = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(len(given), -1)
                length = np.sqrt((x * x).sum(axis=1))
                x = x / np.where(length > 0, length, 1.0)[:, None]
                for i in range(0, len(names), 512):
                    near = np.round(queries[i : i + 512] @ x.T, 12)
                    # Everything at least as near as the k-th could stay; one more for the query itself.
                    k = min(top_k + 1, len(given))
                    limit = np.partition(near, len(given) - k, axis=1)[:, len(given) - k]
                    for j in range(len(near)):
                        found = np.flatnonzero(near[j] >= limit[j])
                        own = best[i + j] + [(-float(near[j, f]), given[f]) for f in found.tolist() if given[f] != names[i + j]]
                        best[i + j] = sorted(own)[:top_k]
            rows = [(names[i], word, -s) for i, own in enumerate(best) for s, word in own]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["query", "word", "similarity"])

        return run

    found = None
    for b in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("word"), F.lit(blocks)) == b).collect()  # about block_bytes
        if not own:
            continue
        names, queries = [r["word"] for r in own], np.array([r["vec"] for r in own])
        queries = queries / np.sqrt((queries * queries).sum(axis=1))[:, None]
        shared = vectors.sparkSession.sparkContext.broadcast((names, queries))
        part = materialize(table.mapInArrow(best_in(shared), schema), "nearest")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("query").orderBy(F.col("similarity").desc(), "word")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)
    return ranked.select("query", "rank", "word", "similarity")


def skipgram_pairs(docs: DataFrame, vocab: DataFrame, window: int = 2) -> DataFrame:
    """All ``(doc_id, center, context)`` pairs of known tokens at most ``window`` apart.

    Unknown tokens are dropped first, so distance is counted between known tokens.
    """
    if window < 1:
        raise ValueError(f"window must be at least 1, got {window}")
    known = lookup_side(vocab.select(F.col("term").alias("token")), row_bytes=64)
    kept = docs.select("doc_id", F.posexplode("tokens").alias("pos", "token")).join(known, "token", "left_semi")
    # Tokens stay rows: each sees the ones behind it, and both directions are made of plain columns.
    behind = Window.partitionBy("doc_id").orderBy("pos", "token")
    apart = kept.select("doc_id", "token", *[F.lead("token", d).over(behind).alias(f"_t{d}") for d in range(1, window + 1)])

    def pair(center: str, context: str, later: str) -> Column:
        return F.when(F.col(later).isNotNull(), F.struct(F.col(center).alias("center"), F.col(context).alias("context")))

    both = [pair(*ends, later) for later in (f"_t{d}" for d in range(1, window + 1)) for ends in (("token", later), (later, "token"))]
    pairs = apart.select("doc_id", F.explode(F.array(*both)).alias("p")).where(F.col("p").isNotNull())
    return pairs.select("doc_id", "p.center", "p.context")


def skipgram_fit(
    docs: DataFrame,
    dim: int = 100,
    window: int = 2,
    min_count: int = 5,
    epochs: int = 5,
    learning_rate: float = 0.025,
    seed: int = 42,
    partitions: int = 8,
) -> DataFrame:
    """Train skip-gram vectors with Spark's distributed trainer; returns (word, vec).

    The corpus is trained in at least ``partitions`` parts, and in more once a part would hold over ``PART_TOKENS``
    tokens, so that a task's work stays bounded. The vectors depend on these, never on the number of cores.
    Texts are trained whole: the trainer's sentence limit is lifted above any document.
    """
    said = docs.select("tokens").where(F.size("tokens") > 0)
    n_tokens = said.agg(F.sum(F.size("tokens").cast("bigint"))).first()[0]
    if not n_tokens:
        raise ValueError("no training text")
    trainer = Word2Vec(
        inputCol="tokens",
        outputCol="_out",
        vectorSize=dim,
        windowSize=window,
        minCount=min_count,
        maxIter=epochs,
        stepSize=learning_rate,
        seed=seed,
        numPartitions=max(partitions, -(-n_tokens // PART_TOKENS)),
        maxSentenceLength=2**31 - 1,
    )
    found = trainer.fit(said).getVectors()
    return found.select("word", vector_to_array("vector").alias("vec"))


def _pool(terms: DataFrame, vectors: DataFrame, weight: Column, dim: int) -> DataFrame:
    """Weighted mean of the vectors of known words; a document without any gets zeros.

    Each dimension is one sum, so a document is one row of partial sums in the shuffle
    and never ``dim`` rows. A table of more than ``POOL_BYTES`` is looked up block by block, so
    vectors never travel with the terms. A vector of another length than ``dim`` is an error.
    """
    check_vectors(vectors)
    wrong = F.raise_error(F.format_string("a vector has %s components, not %s", F.size("vec"), F.lit(dim)))
    checked = F.when(F.col("vec").isNull() | (F.size("vec") == dim), F.col("vec")).otherwise(wrong)
    table = vectors.select(F.col("word").alias("term"), checked.alias("vec"))
    blocks = max(1, -(-table.count() * (64 + 8 * dim) // POOL_BYTES))

    def partial(terms: DataFrame, table: DataFrame) -> DataFrame:
        known = F.col("vec").isNotNull()
        weighed = terms.join(F.broadcast(table), "term", "left").select(  # at most about POOL_BYTES
            "doc_id", F.when(known, F.col("cnt")).alias("n"), F.when(known, weight).cast("double").alias("w"), "vec"
        )
        return weighed.groupBy("doc_id").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_valid"),
            F.coalesce(F.sum("w"), F.lit(0.0)).alias("_w"),
            *[F.sum(F.col("w") * F.get("vec", i).cast("double")).alias(f"_s{i}") for i in range(dim)],
        )

    if blocks == 1:
        sums = partial(terms, table)
    else:
        # Every row of terms falls into one block, so every document is in at least one.
        own = lambda b: F.pmod(F.xxhash64("term"), F.lit(blocks)) == b
        parts = [materialize(partial(terms.where(own(b)), table.where(own(b))), "pool") for b in range(blocks)]
        stacked = reduce(DataFrame.unionByName, parts)
        sums = stacked.groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in stacked.columns if c != "doc_id"])
    mean = [
        F.when(F.col("_w") > 0, F.try_divide(F.col(f"_s{i}"), F.col("_w"))).otherwise(F.lit(0.0))
        for i in range(dim)
    ]
    return sums.select("doc_id", "n_valid", F.array(*mean).alias("vec"))


def pool_mean(docs: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """Mean vector over the known token occurrences of each document."""
    terms = term_counts(docs.select("doc_id", "tokens"), keep_empty=True)
    return _pool(terms, vectors, F.col("cnt"), dim)


def pool_tfidf(
    docs: DataFrame, vectors: DataFrame, idf: DataFrame, dim: int, default_idf: float | None = None
) -> DataFrame:
    """Mean vector weighted by count times IDF.

    A word missing from ``idf(term, idf)`` weighs ``default_idf``, or 1.0 if none is given.
    """
    terms = term_counts(docs.select("doc_id", "tokens"), keep_empty=True)
    terms = terms.join(lookup_side(idf.select("term", "idf"), row_bytes=96), "term", "left")
    fallback = F.lit(1.0 if default_idf is None else float(default_idf))
    return _pool(terms, vectors, F.col("cnt") * F.coalesce("idf", fallback), dim)


def as_features(doc_vectors: DataFrame) -> DataFrame:
    """Document vectors as ``(doc_id, idx, value)`` rows."""
    return doc_vectors.select("doc_id", F.posexplode("vec").alias("idx", "value")).withColumn(
        "idx", F.col("idx").cast("bigint")
    )
