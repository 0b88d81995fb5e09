"""Registered queries of this subpackage and their DuckDB equivalents, where SQL can express one.

Each query reads its whole table and applies its operator with production parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import chat, cover_tree, langid, mixing, multi_index, ngram_join, packing, pii, substring, toxicity, word_queries


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def held_out(n: int, remainder_is: int) -> F.Column:
    """Whether crc32 of the document id as text leaves this remainder modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == remainder_is


def toxicity_model(spark: SparkSession, sf: str, docs: DataFrame) -> toxicity.ToxicityModel:
    """Learned from the labelled documents that aren't held out."""
    return toxicity.fit(docs, table(spark, sf, "labels"), ~held_out(5, 0))


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without its passages of 35 words or more that occur again."""
    found = substring.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_multi_index_hashing(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    vectors = table(spark, sf, "embeddings")
    return multi_index.neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op6_cover_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector's links and class at cosine 0.9."""
    return cover_tree.near_duplicates(table(spark, sf, "embeddings"))


def op8_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its class of near copies."""
    return ngram_join.near_duplicates(table(spark, sf, "documents"))


#: The query's tree: a source's number modulo 4 is its domain.
DOMAIN = "'domain' || cast(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4 as string)"
MIX = {
    "domain_weights": {"domain0": 0.4, "domain1": 0.3, "domain2": 0.2, "domain3": 0.1},
    "lang_weights": {"en": 0.55, "de": 0.2, "fr": 0.15, "es": 0.1},
}


def mix_config() -> mixing.MixConfig:
    """The production mix; made when a session is there, as it holds a column."""
    return mixing.MixConfig(domain=F.expr(DOMAIN), **MIX)


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Which documents the target mix takes, how often."""
    mixed = mixing.mix(table(spark, sf, "documents"), mix_config())
    return mixed.select("doc_id", "lang", "source", "domain", "tokens", "epoch")


def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's personal data."""
    found = pii.find_spans(table(spark, sf, "documents"))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in pii.KINDS],
        F.sha2(pii.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's toxicity score and its toxic passages."""
    docs = table(spark, sf, "documents")
    scored = toxicity.score_documents(docs, toxicity_model(spark, sf, docs))
    return scored.select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("segments").cast("long").alias("n_segments"),
    )


def op5_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as tokens in sequences of at most 2,048."""
    return packing.best_fit_packing(table(spark, sf, "documents"))


def op9_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and one that spells control strings, formatted and read back."""
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], given.schema)
    return chat.chat_digest(chat.format_turns(given.union(more)))


def op10_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's language."""
    docs = table(spark, sf, "documents")
    model = langid.fit(docs, ~held_out(3, 1))
    return langid.predict(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_multi_index_hashing": op2_multi_index_hashing,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_cover_tree": op6_cover_tree,
    "op7_pii": op7_pii,
    "op8_ngram_join": op8_ngram_join,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_language_id": op10_language_id,
    **word_queries.QUERIES,
}

SQL: dict[str, str] = {
    "op3_mixing": mixing.mix_sql(
        "'domain' || (try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 4)::VARCHAR",
        mixing.MixConfig(domain=None, **MIX),
    ),
    **word_queries.SQL,
}
