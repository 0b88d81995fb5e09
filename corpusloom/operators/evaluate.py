"""Confusion matrices, metrics, model comparison, votes and error reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import text_preview


def truth_vs_pred(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """``(doc_id, actual, predicted)`` from ``truth(doc_id, category)`` and predictions."""
    return truth.select("doc_id", F.col("category").alias("actual")).join(
        predictions.select("doc_id", "predicted"), "doc_id"
    )


def _pair_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("actual", "predicted").agg(F.count("*").alias("n"))


def confusion_matrix(pairs: DataFrame, classes: list[str]) -> DataFrame:
    """``(actual, predicted, n)`` for every pair of classes; other labels are left out."""
    names = F.array(*[F.lit(c) for c in classes])
    grid = (
        pairs.sparkSession.range(1)
        .select(F.explode(names).alias("actual"))
        .select("actual", F.explode(names).alias("predicted"))
    )
    counts = _pair_counts(pairs)
    return grid.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n")
    )


def confusion_wide(pairs: DataFrame, classes: list[str]) -> DataFrame:
    """The confusion matrix with one column per predicted class."""
    return confusion_matrix(pairs, classes).groupBy("actual").pivot("predicted", classes).sum("n")


def _ratio(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _class_scores(pairs: DataFrame, classes: list[str]) -> DataFrame:
    """Unrounded precision, recall and F1 per class, from the pair counts alone."""
    matrix = confusion_matrix(pairs, classes)
    each = F.explode(F.array(*[F.lit(c) for c in classes])).alias("category")
    n, hit_a, hit_p = F.col("n"), F.col("actual") == F.col("category"), F.col("predicted") == F.col("category")
    sums = (
        matrix.select("*", each)
        .groupBy("category")
        .agg(
            F.sum(F.when(hit_a & hit_p, n).otherwise(0)).cast("double").alias("tp"),
            F.sum(F.when(hit_p, n).otherwise(0)).cast("double").alias("said"),
            F.sum(F.when(hit_a, n).otherwise(0)).alias("support"),
        )
    )
    scored = sums.select(
        "category",
        _ratio(F.col("tp"), F.col("said")).alias("p"),
        _ratio(F.col("tp"), F.col("support").cast("double")).alias("r"),
        "support",
        "tp",
    )
    return scored.withColumn("f", _ratio(2.0 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))


def per_class_metrics(pairs: DataFrame, classes: list[str]) -> DataFrame:
    """Precision, recall, F1 (4 decimals) and support per class; 0/0 counts as 0."""
    return _class_scores(pairs, classes).select(
        "category",
        F.round("p", 4).alias("precision"),
        F.round("r", 4).alias("recall"),
        F.round("f", 4).alias("f1"),
        "support",
    )


def summary_metrics(pairs: DataFrame, classes: list[str]) -> DataFrame:
    """Accuracy over all rows, macro averages and support-weighted F1, to 4 decimals.

    The weighted F1 averages the already rounded F1 values. An empty input scores 0.
    """
    total = pairs.agg(F.count("*").cast("double").alias("n")).scalar()
    return _class_scores(pairs, classes).agg(
        F.round(_ratio(F.sum("tp"), total), 4).alias("accuracy"),
        F.round(F.avg("p"), 4).alias("macro_precision"),
        F.round(F.avg("r"), 4).alias("macro_recall"),
        F.round(F.avg("f"), 4).alias("macro_f1"),
        F.round(_ratio(F.sum(F.round("f", 4) * F.col("support")), F.sum("support").cast("double")), 4).alias(
            "weighted_f1"
        ),
    )


def accuracy(pairs: DataFrame) -> DataFrame:
    """Share of rows whose prediction is the truth."""
    return pairs.agg(F.avg((F.col("actual") == F.col("predicted")).cast("double")).alias("accuracy"))


def model_comparison(metrics: list[tuple[str, str, str, DataFrame]]) -> DataFrame:
    """Stack summary metrics as ``(ord, pipeline_id, model, representation, ..)``.

    Each entry is ``(id, model, representation, summary)``; figures become 4-decimal text.
    """
    names = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1"]
    parts = [
        m.select(
            F.lit(i).alias("ord"),
            F.lit(key.upper()).alias("pipeline_id"),
            F.lit(model).alias("model"),
            F.lit(representation).alias("representation"),
            *[F.format_string("%.4f", F.col(n)).alias(n) for n in names],
        )
        for i, (key, model, representation, m) in enumerate(metrics, 1)
    ]
    return reduce(DataFrame.unionByName, parts)


def consensus_vote(predictions: DataFrame) -> DataFrame:
    """Most common label per document over ``(doc_id, model_ord, predicted)``.

    A tie goes to the label that comes first in model order.
    """
    votes = predictions.groupBy("doc_id", "predicted").agg(
        F.count("*").alias("n"), F.min("model_ord").alias("first")
    )
    best = F.max(F.struct(F.col("n"), (-F.col("first")).alias("neg"), F.col("predicted")))
    return votes.groupBy("doc_id").agg(best.alias("b"), F.sum("n").alias("n_models")).select(
        "doc_id", F.col("b.predicted").alias("label"), F.col("b.n").alias("agree"), "n_models"
    )


def probability_table(scores: DataFrame, models: list[str]) -> DataFrame:
    """Class-by-model table of ``(doc_id, category, model, probability)`` as percentages."""
    wide = scores.groupBy("doc_id", "category").pivot("model", models).agg(F.max("probability"))
    return wide.select(
        "doc_id",
        "category",
        *[
            F.format_string("%.2f%%", F.coalesce(F.col(f"`{m}`"), F.lit(0.0)) * 100).alias(m)
            for m in models
        ],
    )


# Observed reasons for confusing two classes.
REASONS = (
    ("sport", "business", "The article covers corporate, contractual, or financial aspects of sports (e.g. club takeover, sponsorship, broadcasting rights), leading business-weighted terms to outweigh sporting terms."),
    ("business", "politics", "The article discusses government economic policies, state fiscal budgets, or ministerial regulatory announcements, where political terminology heavily overlaps with economic indicators."),
    ("politics", "business", "The political article centers on corporate legislation, employment figures, or market taxation, triggering positive business model coefficients."),
    ("tech", "business", "The article reports on commercial technology companies, intellectual property acquisitions, or quarterly earnings of software corporations, resulting in dominant business features."),
    ("business", "tech", "The business article focuses on high-tech startups, digital infrastructure, or telecom networks, activating technology-weighted coefficients."),
    ("entertainment", "business", "The entertainment article covers box office grosses, studio mergers, or film budget financing, emphasizing financial vocabulary."),
    ("tech", "politics", "The piece covers governmental cyber-security policies, state digital surveillance laws, or parliamentary internet censorship."),
    ("entertainment", "politics", "The article discusses cultural censorship, public broadcasting funding disputes, or political figures appearing in media events."),
)
# Fixed value: the reason where no rule fits.
DEFAULT_REASON = "Cross-domain terminology: text contains strong positive indicators for %s which statistically outnumbered unique features for %s."


def with_reason(pairs: DataFrame, rules: list[tuple[str, str, str]] | tuple = REASONS) -> DataFrame:
    """Append the explanation of an (actual, predicted) confusion."""
    table = pairs.sparkSession.createDataFrame(list(rules), "actual string, predicted string, reason string")
    fallback = F.format_string(DEFAULT_REASON, F.col("predicted"), F.col("actual"))
    return pairs.join(F.broadcast(table), ["actual", "predicted"], "left").withColumn(  # a few rules
        "reason", F.coalesce("reason", fallback)
    )


def ranked_errors(pairs: DataFrame, limit: int = 20) -> DataFrame:
    """The first ``limit`` misclassified documents by id, numbered, with the error total."""
    wrong = pairs.where(F.col("actual") != F.col("predicted"))
    total = wrong.agg(F.count("*").alias("n")).scalar()
    first = wrong.orderBy("doc_id").limit(limit)
    return first.withColumn("rank", F.row_number().over(Window.orderBy("doc_id"))).withColumn("n_errors", total)


def error_analysis(
    docs: DataFrame,
    predictions: DataFrame,
    classes: list[str],
    explanations: DataFrame,
    limit: int = 20,
    shown_terms: int = 4,
) -> DataFrame:
    """Report rows for the first misclassified documents.

    ``docs(doc_id, category, title, text)``, predictions with class probabilities, and
    ``explanations(doc_id, category, rank, term, weight)`` of the same documents.
    """
    errors = ranked_errors(truth_vs_pred(docs, predictions), limit)
    facts = (
        F.broadcast(errors)  # at most `limit` rows
        .join(docs.select("doc_id", "title", "text"), "doc_id")
        .join(predictions.select("doc_id", "probabilities"), "doc_id")
    )
    shown = (
        explanations.where(F.col("rank") <= shown_terms)
        .join(F.broadcast(errors.select("doc_id")), "doc_id", "left_semi")
        .groupBy("doc_id", "category")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("rank", F.format_string("%s (w=%.2f)", F.col("term"), F.col("weight")).alias("s"))
                )
            ).alias("ts")
        )
        .select("doc_id", "category", F.array_join(F.transform("ts", lambda t: t["s"]), ", ").alias("terms"))
    )
    for side in ("predicted", "actual"):
        named = shown.select("doc_id", F.col("category").alias(side), F.col("terms").alias(f"{side}_terms"))
        facts = facts.join(named, ["doc_id", side], "left")
    line = F.array_join(
        F.array(
            *[
                F.format_string("%s: %.1f%%", F.lit(c), F.get("probabilities", i) * 100)
                for i, c in enumerate(classes)
            ]
        ),
        " | ",
    )
    return with_reason(facts).select(
        "rank",
        "n_errors",
        "doc_id",
        "actual",
        "predicted",
        F.coalesce("title", F.lit("No Title")).alias("title"),
        text_preview(F.col("text")).alias("preview"),
        line.alias("probability_line"),
        F.round(F.array_max("probabilities"), 6).alias("confidence"),
        F.coalesce("predicted_terms", F.lit("")).alias("predicted_terms"),
        F.coalesce("actual_terms", F.lit("")).alias("actual_terms"),
        "reason",
    )
