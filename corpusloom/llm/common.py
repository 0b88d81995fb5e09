"""Helpers of several operators: words, hashing, Arrow mapping and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.plans.lineage import materialize

MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of rows that reach Python at once, unless the session sets it. Spark counts rows otherwise, whatever texts they hold.
BATCH_BYTES, BATCH_SETTING = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"
#: Upper-case ASCII letters to lower case; other bytes stay.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a text: maximal runs without blank, tab, line feed, vertical tab, form feed or return."""
    return text.encode("utf-8").split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of splitmix64)."""
    h = h.astype(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of ``k`` consecutive words."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * MIX + word_hashes[j : j + n]
    return mixed(h)


def map_rows(df: DataFrame, fn: Callable[[Iterable[tuple]], Iterator[tuple]], schema: str, batch: int = 2000) -> DataFrame:
    """Map all rows of each partition through ``fn``: an iterator of tuples to an iterator of tuples.

    Rows travel in Arrow batches and stay in the order of the partition; ``fn`` may keep
    state over the partition and must tolerate a re-run after a lost executor.
    A batch holds ``BATCH_BYTES`` of rows at most, or one row more: both Spark and the Python worker hold batches whole,
    on each core. That is a setting of the session, as the frame may run at any later time.
    """
    if df.sparkSession.conf.get(BATCH_SETTING, None) is None:
        df.sparkSession.conf.set(BATCH_SETTING, BATCH_BYTES)
    names = df.columns
    fields = df.sparkSession.createDataFrame([], schema).schema
    out = to_arrow_schema(fields)

    def run(batches):
        def rows():
            for b in batches:
                for i in range(0, b.num_rows, 1000):  # long texts are Python objects only a few at a time
                    yield from zip(*(b.column(n).slice(i, 1000).to_pylist() for n in names))

        kept: list[tuple] = []
        for row in fn(rows()):
            kept.append(row)
            if len(kept) >= batch:
                yield as_batch(kept, out)
                kept = []
        if kept:
            yield as_batch(kept, out)

    return df.mapInArrow(run, fields)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Tuples as an Arrow batch."""
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def texts_of(docs: DataFrame, wanted: DataFrame, name: str, kind: str, key: Callable[[str | None], object]) -> DataFrame:
    """``wanted(name, doc_id, ...)`` with the texts of ``docs(doc_id, text)``.

    Rows are found by their document id. What only rows without an id hold is found by ``key``, which
    makes ``name``, of SQL type ``kind``, from a text; so a text comes once for each such row.
    """
    given = docs.select("doc_id", "text")
    if given.where("doc_id is null").isEmpty():
        return given.join(wanted, "doc_id")

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for (text,) in rows:
            yield key(text), text

    nameless = map_rows(given.where("doc_id is null").select("text"), run, f"{name} {kind}, text string")
    own = wanted.where("doc_id is null").join(nameless.dropDuplicates([name]), name)
    return given.join(wanted, "doc_id").unionByName(own)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: (node, component), component the smallest node.

    Alternating large-star and small-star steps, each a grouped minimum and a join, until the
    edge set no longer changes. Every step is stored in the shared folder. Loops, repeated
    edges and either direction are allowed; rows with a null end are ignored; nodes without
    an edge to another node have no row.
    """
    e = (
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b")
        .distinct()
    )
    e = materialize(e, "edges")
    seen = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen = now
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(
            F.explode(F.array(F.struct(F.col("m"), F.col("a").alias("x")), F.struct(F.col("m"), F.col("b").alias("x")))).alias("e")
        )
        e = materialize(
            small.select(F.col("e.m").alias("a"), F.col("e.x").alias("b")).where("a < b").distinct(), "edges"
        )
    first = e.groupBy("b").agg(F.min("a").alias("component")).withColumnRenamed("b", "node")
    roots = e.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    return first.union(roots)
