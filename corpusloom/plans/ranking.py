"""Dense row numbers in a total order, without passing all rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.plans.lineage import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def ordered_index(df: DataFrame, order: list[Column], name: str = "idx") -> DataFrame:
    """Append the 0-based rank of each row in the given total order.

    The rows are range-partitioned and sorted once and stored with their partition
    and row number; each partition then only needs the sizes of those before it,
    which is one row per partition.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    stored = materialize(placed, "ordered")
    part = F.shiftrightunsigned("_slot", _ROW_BITS)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    row_in_part = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per shuffle partition
        .withColumn(name, F.col("_before") + row_in_part)
        .drop("_part", "_before", "_slot")
    )
