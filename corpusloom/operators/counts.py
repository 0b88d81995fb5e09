"""Term counts, vocabularies and inverse document frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.plans.lineage import lookup_side, materialize
from corpusloom.plans.ranking import ordered_index


def term_counts(docs: DataFrame, low: int = 1, high: int = 1, keep_empty: bool = False) -> DataFrame:
    """``(.., term, cnt)`` per document and distinct n-gram, without a shuffle.

    With ``keep_empty`` a document without terms keeps one row with a null term.
    """
    rest = [c for c in docs.columns if c != "tokens"]
    explode = F.explode_outer if keep_empty else F.explode
    return docs.select(
        *rest, explode(T.term_histogram(T.ngram_range(F.col("tokens"), low, high))).alias("_h")
    ).select(*rest, F.col("_h.term").alias("term"), F.col("_h.cnt").alias("cnt"))


def vocabulary(docs: DataFrame, low: int = 1, high: int = 1) -> DataFrame:
    """Distinct terms with document frequency."""
    terms = F.array_distinct(T.ngram_range(F.col("tokens"), low, high))
    return docs.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def term_totals(docs: DataFrame) -> DataFrame:
    """Distinct tokens with their number of occurrences."""
    return docs.select(F.explode("tokens").alias("term")).groupBy("term").agg(F.count("*").alias("cnt"))


def bow_fit(docs: DataFrame) -> DataFrame:
    """Distinct tokens numbered in ascending order."""
    terms = docs.select(F.explode(F.array_distinct("tokens")).alias("term")).distinct()
    return ordered_index(terms, [F.col("term")])


def bow_transform(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Counts of in-vocabulary terms per document."""
    known = lookup_side(vocab.select("term", "idx"), row_bytes=96)
    return term_counts(docs).join(known, "term").select("doc_id", "term", "idx", "cnt")


def frequency_vocab(docs: DataFrame, min_count: int = 5) -> DataFrame:
    """Terms seen at least ``min_count`` times, numbered by falling count, then term.

    If no term is that frequent, all terms are kept. The totals are stored: the tokens are read once.
    """
    counts = materialize(term_totals(docs), "term-totals")
    top = counts.agg(F.max("cnt").alias("m")).scalar()
    kept = counts.where((F.col("cnt") >= min_count) | (top < min_count))
    return ordered_index(kept, [F.col("cnt").desc(), F.col("term")])


def vocab_union(*corpora: DataFrame) -> DataFrame:
    """Distinct tokens over several token tables."""
    parts = [c.select(F.explode(F.array_distinct("tokens")).alias("term")) for c in corpora]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def oov_terms(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Per-document counts of terms missing from the vocabulary."""
    return term_counts(docs).join(vocab.select("term"), "term", "left_anti")


def active_terms(docs: DataFrame, vocab: DataFrame, low: int = 1, high: int = 1) -> DataFrame:
    """Distinct in-vocabulary n-grams per document."""
    return term_counts(docs, low, high).join(vocab.select("term"), "term", "left_semi").drop("cnt")


def document_frequency(docs: DataFrame) -> DataFrame:
    """Number of documents each term occurs in."""
    return vocabulary(docs)


def idf_table(docs: DataFrame, smooth: bool = True) -> tuple[DataFrame, DataFrame]:
    """``idf(term, df, idf)`` and its one-row ``meta(n_train, default_idf)``.

    Documents without tokens count towards n_train. An empty corpus gives an empty
    table and the default 1.0.
    """
    n = F.col("n_train").cast("double")
    unseen = F.log(n + 1.0) + (1.0 if smooth else 0.0)
    meta = docs.agg(F.count("*").alias("n_train")).select(
        "n_train", F.when(n == 0, F.lit(1.0)).otherwise(unseen).alias("default_idf")
    )
    total = docs.agg(F.count("*").cast("double").alias("n")).scalar()
    df = F.col("df").cast("double")
    value = F.log((total + 1.0) / (df + 1.0)) + 1.0 if smooth else F.log(total / df)
    return document_frequency(docs).withColumn("idf", value), meta
