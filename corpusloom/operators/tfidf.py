"""TF-IDF features over word n-grams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.counts import term_counts, vocabulary
from corpusloom.plans.lineage import lookup_side, materialize
from corpusloom.plans.ranking import ordered_index

MAX_TOP = 50_000  # terms that each task may keep of its own when the most frequent are picked


@dataclass(frozen=True)
class Tfidf:
    """Fitted state: ``vocab(term, df, idf, idx)`` and how to apply it."""

    vocab: DataFrame
    low: int = 1
    high: int = 1
    sublinear: bool = False
    l2: bool = True


def fit(
    docs: DataFrame,
    low: int = 1,
    high: int = 1,
    min_df: int = 1,
    max_features: int | None = None,
    sublinear: bool = False,
    l2: bool = True,
) -> Tfidf:
    """Learn terms and smoothed IDF from the training documents.

    Keeps terms in at least ``min_df`` documents, the ``max_features`` most frequent of
    them (ties by term), numbered in ascending order. The vocabulary is stored.
    """
    n_docs = docs.count()
    if n_docs == 0:
        raise ValueError("cannot fit on an empty corpus")
    kept = vocabulary(docs, low, high).where(F.col("df") >= min_df)
    idf = F.log((F.lit(float(n_docs)) + 1.0) / (F.col("df") + 1.0)) + 1.0
    if max_features is not None:
        if max_features <= MAX_TOP:
            kept = kept.orderBy(F.col("df").desc(), "term").limit(max_features)
        else:
            ranked = ordered_index(kept, [F.col("df").desc(), F.col("term")], "_rank")
            kept = ranked.where(F.col("_rank") < max_features).drop("_rank")
        kept = materialize(kept, "kept-terms")
    vocab = ordered_index(kept.withColumn("idf", idf), [F.col("term")])
    return Tfidf(vocab, low, high, sublinear, l2)


def transform(docs: DataFrame, model: Tfidf) -> DataFrame:
    """``(doc_id, term, idx, value)`` for in-vocabulary terms.

    A document without known terms has no rows: its vector is zero.
    """
    tf = F.log("cnt") + 1.0 if model.sublinear else F.col("cnt").cast("double")
    weighed = (
        term_counts(docs.select("doc_id", "tokens"), model.low, model.high)
        .join(lookup_side(model.vocab.select("term", "idx", "idf"), row_bytes=112), "term")
        .select("doc_id", F.struct("term", "idx", (tf * F.col("idf")).alias("value")).alias("e"))
    )
    if not model.l2:
        return weighed.select("doc_id", "e.*")
    # One row per document crosses the network, not one per term.
    length = F.sqrt(F.sum(F.col("e.value") * F.col("e.value")))
    per_doc = weighed.groupBy("doc_id").agg(F.collect_list("e").alias("es"), length.alias("_len"))
    unit = F.when(F.col("_len") == 0, F.lit(1.0)).otherwise(F.col("_len"))
    return per_doc.select("doc_id", unit.alias("_u"), F.explode("es").alias("e")).select(
        "doc_id", "e.term", "e.idx", (F.col("e.value") / F.col("_u")).alias("value")
    )


def l2_normalize(values: DataFrame, key: str = "doc_id") -> DataFrame:
    """Divide ``value`` by the length of its document vector; a zero vector stays."""
    length = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy(key)))
    return values.withColumn("value", F.col("value") / F.when(length == 0, F.lit(1.0)).otherwise(length))


def explain(
    docs: DataFrame, model: Tfidf, weights: DataFrame, top_k: int = 5
) -> DataFrame:
    """The ``top_k`` active terms per document and class by contribution value * weight.

    ``weights(term, category, weight)``; negative contributions are ranked too, ties go
    to the smaller term.
    """
    contribution = F.col("value") * F.col("weight")
    ranked = Window.partitionBy("doc_id", "category").orderBy(F.col("contribution").desc(), "term")
    return (
        transform(docs, model)
        .join(weights, "term")
        .select("doc_id", "category", "term", F.col("value").alias("tfidf"), "weight", contribution.alias("contribution"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= top_k)
    )
