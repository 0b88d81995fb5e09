"""Nearest neighbours by multi-index hashing over learned rotated binary codes.

Codes are signs of rotated principal components; each rotation is learned by alternating between
signs and the best rotation onto them. As many rotations as the code length asks for start from
different seeds. They are fitted on a bounded sample (``sample_rows`` vectors, smallest hash
of the id); every vector is indexed.

A shard holds a bounded number of distinct vectors. It indexes each substring of the codes: the rows by
their value in it. For a query and a Hamming radius, the pigeonhole principle gives a radius for each
substring, such that every code within the whole radius lies within one of them; the buckets within
these are probed and the codes found checked. The radius grows until ``enough`` codes lie within
it or the shard is exhausted. All of them are ranked by their exact distance, in double precision, and the
shards' best are merged. Queries come in blocks, so neither side is ever whole in a task.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part.
Equal vectors are indexed once, with their smallest ids, which is exact because ties go to smaller ids.
Rows that repeat an id count as that many candidates only if their vectors differ; a query id with
several vectors has one list, of the best over all of them. Empty tables
give empty results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.plans.lineage import materialize

BITS, SUBSTRING = 256, 8
#: Distinct vectors of a shard on average, and queries of a block.
SHARD_ROWS, BLOCK_QUERIES = 20_000, 1_000
#: DISTANCE[v, d]: the values of a substring at Hamming distance d from v.
NEAR = [[np.array([v ^ x for x in range(256) if bin(x).count("1") == d], np.int64) for d in range(9)] for v in range(256)]


def usable(vector: Column) -> Column:
    """Whether a vector is there, finite in every component and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass
class Codes:
    """Mean, and projections onto principal components rotated by each learned rotation."""

    mean: np.ndarray
    axes: np.ndarray

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes as rows of substrings (one byte each)."""
        return np.packbits((x - self.mean) @ self.axes > 0, axis=1)


def learn_codes(sample: np.ndarray, bits: int = BITS, rounds: int = 30, seed: int = 5) -> Codes:
    """Rotations from a sample of vectors."""
    mean = sample.mean(0)
    centred = sample - mean
    _, v = np.linalg.eigh(centred.T @ centred)
    z = centred @ v
    rng, parts = np.random.default_rng(seed), []
    while sum(p.shape[1] for p in parts) < bits:
        r = np.linalg.qr(rng.normal(size=(z.shape[1], z.shape[1])))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(z.T @ np.where(z @ r > 0, 1.0, -1.0))
            r = u @ w
        parts.append(v @ r)
    return Codes(mean, np.concatenate(parts, 1)[:, :bits])


class SubstringIndex:
    """Buckets of rows by the value of each substring of their codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.edges = [np.searchsorted(codes[o, j], np.arange(257)) for j, o in enumerate(self.order.T)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code lies within a Hamming radius."""
        m = self.codes.shape[1]
        # If each substring j were farther than r_j, the whole would be farther than sum(r_j + 1) - 1.
        least, more = divmod(radius + 1 - m, m)
        hit = np.zeros(len(self.codes), bool)
        for j in range(m):
            own = min(8, least + (j < more))
            for d in range(own + 1):
                for value in NEAR[int(code[j])][d]:
                    hit[self.order[self.edges[j][value] : self.edges[j][value + 1], j]] = True
        rows = np.flatnonzero(hit)
        apart = np.bitwise_count(self.codes[rows] ^ code).sum(1)
        return rows[apart <= radius]


def search(index: SubstringIndex, vectors: np.ndarray, code: np.ndarray, query: np.ndarray, k: int, enough: int, first: int, step: int):
    """Rows and exact distances of the ``k`` best among the codes near a query."""
    radius, most = first, 8 * index.codes.shape[1]
    rows = index.within(code, radius)
    while len(rows) < min(enough, len(vectors)) and radius < most:
        radius = min(radius + step, most)
        rows = index.within(code, radius)
    d = np.sqrt(((vectors[rows] - query) ** 2).sum(1))
    best = np.argsort(d, kind="stable")
    if len(best) > k:
        best = best[d[best] <= d[best[k - 1]]]
    return rows[best], d[best]


def neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    sample_rows: int = 10_000,
    enough: int = 600,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``vectors(vec_id, embedding)`` to each of ``queries``.

    A query is no candidate of itself.
    """
    spark = vectors.sparkSession
    double = F.col("embedding").cast("array<double>")
    given = vectors.select("vec_id", double.alias("v")).where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    asked = queries.select("vec_id", double.alias("v")).where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    lengths = given.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    given, asked = (x.where(F.size("v") == lengths.n).distinct() for x in (given, asked))
    # Ids may repeat, so points and queries are named by their vectors.
    first = Window.partitionBy("v").orderBy("vec_id")
    kept = given.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    points = kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = points.withColumns({"point": F.xxhash64("v", F.array_min("ids")), "least": F.array_min("ids")})
    points = materialize(points, "points")
    # More than k: a query may have to leave itself out, with each of its vectors.
    most = points.select(F.explode("ids").alias("id")).groupBy("id").count().agg(F.max("count")).first()[0]
    wide = k + most
    enough = max(enough, wide)
    sample = points.orderBy(F.xxhash64("least"), "least", "point").limit(sample_rows).select("v").collect()
    codes = learn_codes(np.array([r.v for r in sample]))
    n_points, n_asked = points.count(), asked.select("v").distinct().count()
    shards, blocks = max(1, n_points // SHARD_ROWS), max(1, n_asked // BLOCK_QUERIES)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = points.select((F.pmod(F.xxhash64("least"), F.lit(shards))).alias("shard"), every(blocks).alias("block"), "point", "v")
    q = asked.groupBy("v").agg(F.min("vec_id").alias("least"))
    q = q.select("v", "least", F.xxhash64("v", "least").alias("query"))
    right = q.select(every(shards).alias("shard"), F.pmod(F.xxhash64("least"), F.lit(blocks)).alias("block"), "query", "v")

    def run(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(ours) and len(theirs):
            x, y = np.array(ours["v"].tolist()), np.array(theirs["v"].tolist())
            index, ids = SubstringIndex(codes.encode(x)), ours["point"].to_numpy()
            for query, vector, code in zip(theirs["query"], y, codes.encode(y)):
                rows, d = search(index, x, code, vector, wide, enough, first=BITS // 4, step=BITS // 16)
                found += [(query, ids[r], s) for r, s in zip(rows, d)]
        return pd.DataFrame(found, columns=["query", "point", "score"])

    near = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(run, "query long, point long, score double")
    # The k best points of a query, those tied with the last included, hold its k best rows.
    near = near.withColumn("r", F.rank().over(Window.partitionBy("query").orderBy("score"))).where(F.col("r") <= wide)
    rows = near.join(points.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("vec_id"))
    asking = asked.join(q, "v").select("query", F.col("vec_id").alias("query_id"))
    pairs = rows.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))).where(F.col("n") <= wide)
    pairs = asking.join(pairs.drop("n"), "query").where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
