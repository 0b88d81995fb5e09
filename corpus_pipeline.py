"""A training corpus from raw documents: five stages, each over all that its predecessor kept.

Toxic documents go; of each class of near copies one document stays; personal data is replaced by
its kind; sources are mixed to target weights (documents of short sources may come in several epochs,
as repeated rows); the result is packed into sequences. All stages but the last return the columns of
``documents``. Every stage's result is written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import mixing, ngram_join, packing, pii, queries, toxicity
from corpusloom.plans.lineage import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.5."""
    scored, score = toxicity.with_verdict(docs, queries.toxicity_model(spark, sf_dir, docs))
    return scored.where(F.col(score) < 0.5).select(*docs.columns)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near copies."""
    return ngram_join.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target mix takes them."""
    own = [next(n for n in (f"{c}{'_' * i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns) for c in ("epoch", "tokens", "domain")]
    return mixing.mix(docs, queries.mix_config(), *own).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place."""
    return packing.best_fit_packing(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", keep_one_copy),
    ("PII", redact_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Tokenising and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
