"""Where intermediate tables live, and how small tables reach the driver."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


class BoundExceeded(ValueError):
    """A table that must stay small turned out to be larger than its bound."""


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Where that is unset, a session in one process has a folder of its own; on a cluster a
    machine-local path would be lost together with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _own_dir()


@cache
def _own_dir() -> str:
    """The folder of a process whose session names none."""
    return tempfile.mkdtemp(prefix="corpusloom-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives executor loss, and gives the planner true sizes,
    so later joins are broadcast exactly when the table is small enough.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_rows(df: DataFrame, limit: int, what: str) -> list[Row]:
    """Collect a table that is small by nature, and fail loudly if it is not."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise BoundExceeded(f"{what}: more than {limit} rows")
    return rows


BROADCAST_BYTES = 256 * 1024 * 1024


def lookup_side(table: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a stored lookup table for broadcast if its counted size allows it.

    Broadcasting keeps the rows of a document together, so what is summed per document
    afterwards is combined before it is shuffled. A larger table is joined by shuffle,
    where adaptive execution splits skewed keys.
    """
    return F.broadcast(table) if table.count() * row_bytes <= max_bytes else table


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash the rows over the cores by ``key`` if the scan has fewer splits than cores.

    A table of a few small files would otherwise be processed by a few tasks. A
    large table already has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def array_of_structs(rows: list[dict]) -> F.Column:
    """A literal array of structs from a few driver-side rows."""
    return F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in rows])
