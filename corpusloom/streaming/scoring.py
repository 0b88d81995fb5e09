"""Scoring a stream of texts with fitted models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corpusloom.plans.jobs import Trained, job_score


def score_stream(trained: Trained, texts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Score each micro-batch of ``texts(doc_id, text)`` and write votes below ``out``.

    A batch writes to a folder of its own number and overwrites it when repeated after
    a failure, so every text is scored once.
    """

    def score(batch: DataFrame, number: int) -> None:
        job_score(trained, batch).consensus.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        texts.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
