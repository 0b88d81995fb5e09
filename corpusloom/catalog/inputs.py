"""How the given tables become corpora, vectors, weights and predictions for the queries.

``documents`` is the corpus with its language as category; ``embeddings`` supplies word
vectors: vocabulary word number i gets vector i modulo their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import counts
from corpusloom.operators.linear import OneVsRest
from corpusloom.operators.preprocess import TextConfig, preprocess
from corpusloom.operators.split import stratified_split
from corpusloom.plans.lineage import materialize, spread

LANGS = ["de", "en", "es", "fr"]
DIM = 64


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled corpus (doc_id, category, text)."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("category"), "text")
    return spread(docs, "doc_id")


def tokens(spark: SparkSession, sf: str, config: TextConfig = TextConfig()) -> DataFrame:
    """The tokenised corpus (doc_id, category, tokens)."""
    return preprocess(documents(spark, sf), config)


def benchmark_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out texts as token sequences."""
    held = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return preprocess(spread(held, "doc_id"))


def conversation_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of conversations as token sequences."""
    turns = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    return preprocess(spread(turns, "doc_id"))


def split_tokens(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Training and test tokens. Tokens are stored: several passes follow."""
    stored = materialize(tokens(spark, sf), "tokens")
    both = stratified_split(stored)
    return [both.where(F.col("split") == s).drop("split") for s in ("train", "test")]


def word_vectors(spark: SparkSession, sf: str, docs: DataFrame, stored: bool = True) -> DataFrame:
    """(word, vec) for every token of the corpus; not ``stored``, a filter on words comes before their vectors are looked up."""
    given = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    n = given.count()
    vocab = counts.bow_fit(docs).withColumn("vec_id", F.col("idx") % n)
    found = vocab.join(given, "vec_id").select(F.col("term").alias("word"), "vec")
    return materialize(found, "vectors") if stored else found


def given_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The embeddings with a word made of their id."""
    return table(spark, sf, "embeddings").select(
        F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"), F.col("embedding").alias("vec")
    )


def hash_weight(category, term):
    """A reproducible weight in [-0.5, 0.5) for a class and a term."""
    digest = F.md5(F.concat(category, F.lit(":"), term).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32) - 0.5


def hash_model(vocab: DataFrame) -> OneVsRest:
    """A one-vs-rest model over (term, idx) with reproducible weights and biases."""
    spark = vocab.sparkSession
    each = F.explode(F.array(*[F.lit(c) for c in LANGS])).alias("category")
    weights = vocab.select("idx", "term", each).select(
        "category", "idx", "term", hash_weight(F.col("category"), F.col("term")).alias("weight")
    )
    bias = spark.createDataFrame(
        [(c, -0.5 + 0.1 * i) for i, c in enumerate(LANGS)], "category string, bias double"
    )
    return OneVsRest(LANGS, weights, bias)


def noisy_predictions(spark: SparkSession, sf: str, salt: str = "a") -> DataFrame:
    """(doc_id, category, predicted): the true label, replaced for about a fifth of the documents."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("category"))
    digest = F.md5(F.concat(F.lit(salt), F.col("doc_id").cast("string")).cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    other = F.get(F.array(*[F.lit(c) for c in LANGS]), F.floor(number / 5).cast("int") % 4)
    return docs.withColumn("predicted", F.when(number % 5 == 0, other).otherwise(F.col("category")))


def components(found: DataFrame) -> DataFrame:
    """All components of ``found(word, vec)`` as (word, dim, value)."""
    return found.select("word", F.posexplode("vec").alias("dim", "value")).select(
        "word", F.col("dim").cast("bigint").alias("dim"), r6(F.col("value"), "value")
    )


def weighted_sum(vec):
    """One number that every component of a vector changes: the sum of i times component i, from 1."""
    products = F.transform(vec, lambda x, i: x.cast("double") * (i + 1))
    return F.aggregate(products, F.lit(0.0), lambda a, x: a + x)


def r6(column, name: str):
    """Six decimals, for comparison."""
    return F.round(column, 6).alias(name)
