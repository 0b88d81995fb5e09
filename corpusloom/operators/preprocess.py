"""From raw text to token arrays."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.lexicon import LEMMAS, STOP_WORDS, SUFFIX_RULES
from corpusloom.plans.lineage import materialize

MAX_MAPPED = 1_000  # lemmas of a table that are applied as a map


def default_lemmas() -> dict[str, str]:
    """Built-in mapping token -> lemma, the verb lemma first if it changes the token."""
    verbs = {t: lemma for t, pos, lemma in LEMMAS if pos == "v" and lemma != t}
    nouns = {t: lemma for t, pos, lemma in LEMMAS if pos == "n"}
    return {**nouns, **verbs}


@dataclass(frozen=True)
class TextConfig:
    """How to turn text into tokens; a fitted model keeps it for scoring."""

    preserve_numbers: bool = False
    drop_stop_words: bool = True
    stop_words: tuple[str, ...] = STOP_WORDS
    lemmatize: bool = True
    lemmas: dict[str, str] = field(default_factory=default_lemmas)
    split_fused: bool = True


def tokens_column(text: Column, config: TextConfig) -> Column:
    """Token array of a text column."""
    tokens = T.tokenize(text, config.preserve_numbers, config.split_fused, drop_empty=not config.drop_stop_words)
    if config.drop_stop_words:
        tokens = T.remove_stopwords(tokens, config.stop_words)
    if config.lemmatize:
        tokens = T.map_tokens(tokens, config.lemmas)
    return tokens


def preprocess(
    docs: DataFrame,
    config: TextConfig = TextConfig(),
    lemma_table: DataFrame | None = None,
    text_col: str = "text",
    as_text: bool = False,
) -> DataFrame:
    """Replace the text column by ``tokens`` (an array, or one joined string).

    ``lemma_table(token, pos, lemma)`` replaces the built-in lemma mapping by a table
    of any size.
    """
    rest = [c for c in docs.columns if c != text_col]
    if lemma_table is None:
        out = docs.select(*rest, tokens_column(F.col(text_col), config).alias("tokens"))
    else:
        plain = TextConfig(**{**config.__dict__, "lemmatize": False})
        out = docs.select(*rest, tokens_column(F.col(text_col), plain).alias("tokens"))
        if config.lemmatize:
            out = lemmatize_tokens(out, lemma_table)
    return out.withColumn("tokens", F.array_join("tokens", " ")) if as_text else out


def effective_lemmas(lemma_table: DataFrame) -> DataFrame:
    """One lemma per token: the verb lemma if it differs from the token, else the noun lemma."""
    changed = (F.col("pos") == "v") & (F.col("lemma") != F.col("token"))
    return (
        lemma_table.groupBy("token")
        .agg(
            F.min(F.when(changed, F.col("lemma"))).alias("_v"),
            F.min(F.when(F.col("pos") == "n", F.col("lemma"))).alias("_n"),
        )
        .select("token", F.coalesce("_v", "_n").alias("lemma"))
        .where(F.col("lemma").isNotNull())
    )


def lemmatize_tokens(docs: DataFrame, lemma_table: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lemmatise the ``tokens`` arrays; tokens outside the table stay. Rows of the same key become one.

    A table of at most ``MAX_MAPPED`` lemmas is applied inside the arrays, a larger one by a join of the tokens.
    """
    rest = [c for c in docs.columns if c not in (key, "tokens")]
    lemma = materialize(effective_lemmas(lemma_table), "lemmas")
    few = lemma.limit(MAX_MAPPED + 1).collect()
    if len(few) <= MAX_MAPPED:
        mapped = T.map_tokens(F.col("tokens"), {r["token"]: r["lemma"] for r in few if r["token"] is not None})
        entries = F.transform(mapped, lambda t, i: F.struct(i.alias("_pos"), t.alias("token")))
        entries = F.coalesce(F.filter(entries, lambda e: e["token"].isNotNull()), F.array().cast("array<struct<_pos:int,token:string>>"))
        whole = docs.select(key, *rest, entries.alias("_e")).groupBy(key).agg(
            *[F.any_value(c).alias(c) for c in rest], F.flatten(F.collect_list("_e")).alias("_e"), F.count("*").alias("_rows")
        )
        ordered = F.when(F.col("_rows") > 1, F.array_sort("_e")).otherwise(F.col("_e"))
        return whole.select(key, *rest, F.transform(ordered, lambda e: e["token"]).alias("tokens"))
    each = docs.select(key, *rest, F.posexplode_outer("tokens").alias("_pos", "token"))
    mapped = each.join(lemma, "token", "left")
    entry = F.when(
        F.col("token").isNotNull(), F.struct("_pos", F.coalesce("lemma", "token").alias("token"))
    )
    return (
        mapped.groupBy(key)
        .agg(*[F.any_value(c).alias(c) for c in rest], F.array_sort(F.collect_list(entry)).alias("_e"))
        .select(key, *rest, F.transform("_e", lambda e: e["token"]).alias("tokens"))
    )


def derive_lemmas(words: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """Build a lemma table for ``words(token)`` from a dictionary ``lexicon(word, pos)``.

    A lemma is the shortest dictionary word among the token itself and the token with
    an ending replaced; ``exceptions(token, pos, lemma)`` come before the rules.
    """
    rules = F.array(
        *[
            F.struct(F.lit(p).alias("pos"), F.lit(end).alias("end"), F.lit(new).alias("new"))
            for p, end, new in SUFFIX_RULES
        ],
        *[F.struct(F.lit(p).alias("pos"), F.lit("").alias("end"), F.lit("").alias("new")) for p in "nv"],
    )
    candidates = (
        words.select("token", F.explode(rules).alias("r"))
        .where(F.expr("endswith(token, r.end)"))
        .select(
            "token",
            F.col("r.pos").alias("pos"),
            F.expr("concat(left(token, length(token) - length(r.end)), r.new)").alias("word"),
        )
    )
    by_rule = (
        candidates.join(lexicon.select("word", "pos").distinct(), ["word", "pos"])
        .groupBy("token", "pos")
        .agg(F.min(F.struct(F.length("word"), "word"))["word"].alias("lemma"))
    )
    if exceptions is None:
        return by_rule
    known = exceptions.join(words, "token", "left_semi").select("token", "pos", "lemma")
    return known.unionByName(by_rule.join(known, ["token", "pos"], "left_anti"))


def drop_stop_rows(tokens: DataFrame, stop_table: DataFrame) -> DataFrame:
    """Stop-word removal on exploded ``(.., token)`` rows with the list held in a table."""
    return tokens.where(F.length("token") > 1).join(stop_table, "token", "left_anti")


def input_status(docs: DataFrame, vocabularies: list[DataFrame], text_col: str = "text",
                 config: TextConfig = TextConfig(preserve_numbers=True)) -> DataFrame:
    """Size, token count, coverage by two vocabularies and a status per document.

    Status is ``empty`` (blank text), ``no_tokens``, ``oov`` (no token known to either
    vocabulary) or ``ok``.
    """
    stripped = T.strip(F.coalesce(F.col(text_col), F.lit("")))
    sized = docs.select(
        "doc_id",
        F.length(stripped).cast("bigint").alias("n_chars"),
        tokens_column(F.col(text_col), config).alias("tokens"),
    )
    terms = sized.select(
        "doc_id",
        "n_chars",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.explode_outer(T.term_histogram(F.col("tokens"))).alias("h"),
    ).select("doc_id", "n_chars", "n_tokens", F.col("h.term").alias("term"), F.col("h.cnt").alias("cnt"))
    for i, vocab in enumerate(vocabularies, 1):
        known = vocab.select("term", F.lit(1).alias(f"_in{i}"))
        terms = terms.join(known, "term", "left")
    covered = [
        F.coalesce(F.sum(F.when(F.col(f"_in{i}") == 1, F.col("cnt"))), F.lit(0)).alias(f"covered_{i}")
        for i in range(1, len(vocabularies) + 1)
    ]
    per_doc = terms.groupBy("doc_id", "n_chars", "n_tokens").agg(*covered)
    hits = [F.col(f"covered_{i}") for i in range(1, len(vocabularies) + 1)]
    percents = [
        F.coalesce(F.try_divide(h * F.lit(100.0), F.col("n_tokens")), F.lit(0.0)).alias(f"percent_{i}")
        for i, h in enumerate(hits, 1)
    ]
    all_oov = (F.col("n_tokens") > 0) & (sum(hits[1:], hits[0]) == 0)
    status = (
        F.when(F.col("n_chars") == 0, "empty")
        .when(F.col("n_tokens") == 0, "no_tokens")
        .when(all_oov, "oov")
        .otherwise("ok")
    )
    return per_doc.select("*", *percents, all_oov.alias("all_oov"), status.alias("status"))
