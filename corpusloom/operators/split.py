"""Reproducible stratified train/test split."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.plans.lineage import bounded_rows, materialize

MAX_CLASSES = 10_000
_BUCKET_DIGITS = 4  # hex digits of the hash used as histogram bucket


def split_key(seed: int, doc_id: Column) -> Column:
    """Hash that decides the order of documents inside their class."""
    return F.md5(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"))


def test_allocation(sizes: dict[str, int], test_size: float) -> dict[str, int]:
    """Test documents per class: total rounded up, largest remainders first."""
    total = sum(sizes.values())
    want = math.ceil(Decimal(total) * Decimal(str(test_size)))
    exact = {c: n * want / total for c, n in sizes.items()} if total else {}
    out = {c: int(x) for c, x in exact.items()}
    rest = want - sum(out.values())
    for c in sorted(exact, key=lambda c: (-(exact[c] - out[c]), c))[:rest]:
        out[c] += 1
    return out


def stratified_split(
    docs: DataFrame,
    test_size: float = 0.2,
    seed: int = 42,
    unit: str = "doc_id",
) -> DataFrame:
    """Append ``split`` ('train' or 'test'), with exact test counts per class.

    In each class the documents with the smallest hashes are the test documents. The
    cut value is found from a histogram of the hashes, so a class is never sorted as a
    whole; the documents themselves are only compared with the cut of their class and
    are not shuffled.

    ``unit`` may name a group key, for example a text hash, to keep copies on one
    side; test counts then are the closest reachable from below. A group whose documents
    have several classes counts with all of them for the most frequent one (ties: the
    smaller name), so it too stays on one side. Documents without a key are one group.
    """
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must lie between 0 and 1")
    if unit != "doc_id":
        per_class = docs.groupBy(unit, "category").agg(F.count("*").alias("_n"))
        main = F.min(F.struct((-F.col("_n")).alias("_n"), "category"))["category"].alias("_class")
        groups = per_class.groupBy(F.col(unit).alias("_unit")).agg(main, F.sum("_n").alias("_size"))
        groups = materialize(groups, "split-groups")
        units = groups.select(F.col("_class").alias("category"), F.coalesce(F.col("_unit").cast("string"), F.lit("")).alias("_key"), "_size")
        docs_of = docs.join(groups.select("_unit", "_class"), F.col(unit).eqNullSafe(F.col("_unit")))
        docs_of = docs_of.withColumn("_key", F.coalesce(F.col(unit).cast("string"), F.lit("")))
    else:
        units = docs.select("category", F.col(unit).alias("_key"), F.lit(1).cast("bigint").alias("_size"))
        docs_of = docs.withColumns({"_class": F.col("category"), "_key": F.col(unit)})
    columns, unit = docs.columns, "_key"
    keyed = units.withColumn("_h", split_key(seed, F.col(unit)))
    keyed = keyed.withColumn("_bucket", F.substring("_h", 1, _BUCKET_DIGITS))
    histogram = keyed.groupBy("category", "_bucket").agg(F.sum("_size").alias("_n"))

    sizes = {
        r["category"]: r["n"]
        for r in bounded_rows(
            units.groupBy("category").agg(F.sum("_size").alias("n")), MAX_CLASSES, "classes to split"
        )
    }
    take = test_allocation(sizes, test_size)
    spark = docs.sparkSession
    wanted = spark.createDataFrame(list(take.items()), "category string, _want bigint")

    # The bucket in which the running count passes the wanted count, per class.
    running = Window.partitionBy("category").orderBy("_bucket")
    cut = (
        histogram.withColumn("_upto", F.sum("_n").over(running))
        .join(F.broadcast(wanted), "category")  # one row per class
        .where((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
        .select(
            "category",
            F.col("_bucket").alias("_cut"),
            (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_need"),
        )
    )
    # Inside that bucket: the last hash that still belongs to the test side.
    inside = Window.partitionBy("category").orderBy("_h", unit)
    edge = (
        keyed.join(F.broadcast(cut), "category")  # one row per class
        .where(F.col("_bucket") == F.col("_cut"))
        .withColumn("_upto", F.sum("_size").over(inside))
        .where(F.col("_upto") <= F.col("_need"))
        .groupBy("category")
        .agg(F.max(F.struct(F.col("_h"), F.col(unit).alias("_u"))).alias("_last"))
    )
    cuts = bounded_rows(
        cut.join(edge, "category", "left").select("category", "_cut", "_last._h", "_last._u"),
        MAX_CLASSES,
        "classes to split",
    )
    limits = spark.createDataFrame(
        [tuple(r) for r in cuts],
        f"_class string, _cut string, _last_h string, _last_u {units.schema[unit].dataType.simpleString()}",
    )
    h, bucket = F.col("_hash"), F.substring("_hash", 1, _BUCKET_DIGITS)
    in_cut = (h < F.col("_last_h")) | ((h == F.col("_last_h")) & (F.col(unit) <= F.col("_last_u")))
    is_test = (bucket < F.col("_cut")) | F.coalesce(in_cut, F.lit(False))
    return (
        docs_of.join(F.broadcast(limits), "_class", "left")  # one row per class
        .withColumn("_hash", split_key(seed, F.col(unit)))
        .withColumn("split", F.when(is_test, "test").otherwise("train"))
        .select(*columns, "split")
    )
