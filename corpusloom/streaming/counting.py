"""Language-model counts that grow with a stream of token sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.language_model import LanguageModel, count_orders, model_of


def count_stream(docs: DataFrame, n: int, out: str, checkpoint: str) -> StreamingQuery:
    """Add the n-gram counts of each micro-batch of ``docs(tokens)`` below ``out``.

    Counts are additive, so each batch keeps its own partial counts; a repeated batch
    overwrites its folder and is not counted twice.
    """

    def count(batch: DataFrame, number: int) -> None:
        count_orders(batch, [n]).drop("n").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        docs.writeStream.foreachBatch(count)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def streamed_model(spark: SparkSession, out: str, n: int) -> LanguageModel:
    """The model of all batches counted so far."""
    ngrams = spark.read.parquet(out).groupBy("context", "word").agg(F.sum("cnt").alias("cnt"))
    return model_of(ngrams, n)
