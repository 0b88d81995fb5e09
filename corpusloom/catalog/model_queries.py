"""Queries for counts, language models, naive Bayes, TF-IDF and the split."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.catalog import inputs as I
from corpusloom.catalog import sql as S
from corpusloom.operators import counts, language_model as lm, naive_bayes as nb, split, tfidf
from corpusloom.plans.lineage import materialize, scratch_path
from corpusloom.sources import models


def stratified_split(spark, sf):
    return split.stratified_split(I.documents(spark, sf)).select("doc_id", "category", "split")


# --- counts ---------------------------------------------------------------------------------


def bow_fit(spark, sf):
    return counts.bow_fit(I.tokens(spark, sf)).select("term", "idx")


def bow_transform(spark, sf):
    train, test = I.split_tokens(spark, sf)
    return counts.bow_transform(test, counts.bow_fit(train)).select("doc_id", "term", "idx", "cnt")


def vocab_lookup(spark, sf):
    docs = materialize(I.tokens(spark, sf), "tokens")
    vocab = counts.frequency_vocab(docs, 5)
    return counts.bow_transform(docs, vocab).select("doc_id", "idx", "cnt")


def vocab_index(spark, sf):
    return counts.frequency_vocab(I.tokens(spark, sf), 1).select("term", "cnt", "idx")


def w2v_vocab(spark, sf):
    return counts.frequency_vocab(I.tokens(spark, sf), 5).select("term", "cnt", "idx")


def oov_tokens(spark, sf):
    held = counts.vocab_union(I.tokens(spark, sf))
    return counts.oov_terms(I.benchmark_tokens(spark, sf), held).select("doc_id", "term", "cnt")


def vocab_union(spark, sf):
    return counts.vocab_union(*[f(spark, sf) for f in (I.tokens, I.benchmark_tokens, I.conversation_tokens)])


def active_terms(spark, sf):
    train, test = I.split_tokens(spark, sf)
    model = tfidf.fit(train, 1, 2, 2, 8000)
    return counts.active_terms(test, model.vocab, 1, 2).select("doc_id", "term")


def document_frequency(spark, sf):
    return counts.document_frequency(I.tokens(spark, sf))


def idf(spark, sf):
    train, _ = I.split_tokens(spark, sf)
    smooth, _ = counts.idf_table(train)
    plain, meta = counts.idf_table(train, smooth=False)
    both = smooth.join(plain.select("term", F.col("idf").alias("plain")), "term")
    default = meta.select("default_idf").scalar()
    return both.select("term", "df", I.r6(F.col("idf"), "idf"), I.r6(F.col("plain"), "plain"), I.r6(default, "default_plain"))


def idf_lookup(spark, sf):
    train, test = I.split_tokens(spark, sf)
    table, meta = counts.idf_table(train)
    default = meta.select("default_idf").scalar()
    return counts.term_counts(test).join(table.select("term", "idf"), "term", "left").select(
        "doc_id", "term", I.r6(F.coalesce("idf", default), "idf")
    )


# --- language models ------------------------------------------------------------------------


def lm_train(spark, sf):
    grams = lm.count_orders(I.tokens(spark, sf), [2, 3, 4, 5])
    return grams.select(F.col("n").cast("int").alias("n"), "context", "word", "cnt")


def lm_vocab_size(spark, sf):
    model = lm.train(I.tokens(spark, sf), 2)
    return model.vocab_size.join(model.total_tokens)


def lm_probability(spark, sf):
    model = lm.train(I.tokens(spark, sf), 2)
    pairs = lm.count_orders(I.benchmark_tokens(spark, sf), [2]).select("context", "word")
    smooth = lm.with_probability(pairs, model).withColumnRenamed("p", "laplace")
    both = lm.with_probability(smooth, model, smoothing=False)
    return both.select(
        "context", "word",
        F.round(F.col("laplace"), 9).alias("laplace"), F.round(F.col("p"), 9).alias("mle"),
    )


def lm_log_likelihood(spark, sf):
    model = lm.train(I.tokens(spark, sf), 2)
    held = I.benchmark_tokens(spark, sf)
    smooth = lm.sequence_scores(held, model).select("doc_id", I.r6(F.col("log_likelihood"), "laplace"))
    plain = lm.sequence_scores(held, model, False).select("doc_id", (F.col("log_likelihood") < -1e300).alias("mle_impossible"))
    return smooth.join(plain, "doc_id")


def lm_sequence_probability(spark, sf):
    model = lm.train(I.tokens(spark, sf), 2)
    turns = lm.sequence_scores(I.conversation_tokens(spark, sf), model)
    p = F.col("probability")
    power = F.when(p < 1e-300, F.lit(0.0)).otherwise(F.floor(F.log10(p)).cast("double"))  # below it, doubles lose digits
    digits = F.when(p < 1e-300, F.lit(0.0)).otherwise(p / F.pow(F.lit(10.0), power))
    return turns.select("doc_id", power.cast("int").alias("power"), F.round(digits, 5).alias("digits"))


def lm_perplexity(spark, sf):
    scored = lm.sequence_scores(I.benchmark_tokens(spark, sf), lm.train(I.tokens(spark, sf), 2))
    return scored.select("doc_id", "n_predictions", F.round("perplexity", 3).alias("perplexity"))


def predict_next_words(spark, sf):
    model = lm.train(I.tokens(spark, sf), 2)
    asked = model.contexts.select("context").unionByName(
        lm.count_orders(I.benchmark_tokens(spark, sf), [2]).select("context")
    )
    best = lm.predict_next_words(asked, model, 3)
    return best.select("context", F.col("rank").cast("int").alias("rank"), "word", F.round("p", 9).alias("p"))


def predict_next_words_mle(spark, sf):
    model = lm.train(I.tokens(spark, sf), 2)
    best = lm.predict_next_words(model.contexts.select("context"), model, 3, smoothing=False)
    return best.select("context", F.col("rank").cast("int").alias("rank"), "word", F.round("p", 9).alias("p"))


# --- naive Bayes ----------------------------------------------------------------------------


def nb_priors(spark, sf):
    train, _ = I.split_tokens(spark, sf)
    return nb.class_priors(train.select("category")).select(
        "category", "n_docs", I.r6(F.col("prior"), "prior"), I.r6(F.col("log_prior"), "log_prior")
    )


def nb_word_likelihood(spark, sf):
    train, _ = I.split_tokens(spark, sf)
    return nb.word_likelihood(nb.fit(train)).select("category", "term", "cnt", I.r6(F.col("log_prob"), "log_prob"))


def class_word_grid(spark, sf):
    train, _ = I.split_tokens(spark, sf)
    return nb.word_likelihood(nb.fit(train)).select("category", "term", "cnt")


def _nb(spark, sf):
    train, test = I.split_tokens(spark, sf)
    model = nb.fit(train)
    return test, nb.predict(test, model), nb.class_names(model)


def nb_log_scores(spark, sf):
    _, predictions, classes = _nb(spark, sf)
    return nb.long_scores(predictions, classes).select("doc_id", "category", F.round("score", 4).alias("score"))


def nb_predict_proba(spark, sf):
    _, predictions, classes = _nb(spark, sf)
    return nb.long_scores(predictions, classes).select("doc_id", "category", I.r6(F.col("probability"), "probability"))


def nb_predict(spark, sf):
    return _nb(spark, sf)[1].select("doc_id", "predicted")


def predict_argmax(spark, sf):
    test, predictions, _ = _nb(spark, sf)
    return predictions.join(test.select("doc_id", "category"), "doc_id").select(
        "doc_id", "category", "predicted", F.round(F.array_max("scores"), 4).alias("score")
    )


def nb_fit_counts(spark, sf):
    train, _ = I.split_tokens(spark, sf)
    ready = materialize(counts.term_counts(train), "counts")
    model = nb.fit_counts(train.select("doc_id", "category"), ready, alpha=0.5)
    return model.words.select("term", F.explode("by_class").alias("c")).select(
        F.col("c.category").alias("category"), "term", F.col("c.cnt").alias("cnt"), I.r6(F.col("c.log_prob"), "log_prob")
    )


# --- TF-IDF ---------------------------------------------------------------------------------


def tfidf_fit(spark, sf):
    train, _ = I.split_tokens(spark, sf)
    model = tfidf.fit(train, 1, 2, 2, 8000)
    return model.vocab.select("term", "df", "idx", I.r6(F.col("idf"), "idf"))


def max_features_cap(spark, sf):
    train, _ = I.split_tokens(spark, sf)
    return tfidf.fit(train, 1, 1, 2, 500).vocab.select("term", "df", "idx")


def tfidf_transform(spark, sf):
    train, test = I.split_tokens(spark, sf)
    model = tfidf.fit(train, 1, 2, 2, 8000)
    return tfidf.transform(test, model).select("doc_id", "term", "idx", I.r6(F.col("value"), "value"))


def load_model(spark, sf):
    """Save models of all six kinds, check them against their manifests, load them and sum up what came back."""
    train, test = I.split_tokens(spark, sf)
    path = scratch_path(spark, "saved-models")
    fitted = tfidf.fit(train, 1, 2, 2, 8000)
    linear = I.hash_model(fitted.vocab)
    models.save_naive_bayes(nb.fit(train), f"{path}/naive_bayes")
    models.save_tfidf(fitted, f"{path}/tfidf")
    models.save_language_model(lm.train(train.unionByName(test), 2), f"{path}/language_model")
    models.save_vectors(I.word_vectors(spark, sf, train.unionByName(test)), f"{path}/vectors")
    models.save_idf(*counts.idf_table(train.unionByName(test)), f"{path}/idf")
    models.save_linear_bundle({"one": replace(linear, weights=linear.weights.drop("term"))}, "one", f"{path}/linear")
    for kind in ("naive_bayes", "tfidf", "language_model", "vectors", "idf", "linear"):
        models.check_model(spark, f"{path}/{kind}")
    loaded = {
        "naive_bayes": (models.load_naive_bayes(spark, f"{path}/naive_bayes").words, F.aggregate("by_class", F.lit(0).cast("bigint"), lambda s, c: s + c["cnt"])),
        "tfidf": (models.load_tfidf(spark, f"{path}/tfidf").vocab, F.col("df")),
        "language_model": (models.load_language_model(spark, f"{path}/language_model").ngrams, F.col("cnt")),
        "vectors": (models.load_vectors(spark, f"{path}/vectors"), F.size("vec")),
        "idf": (models.load_idf(spark, f"{path}/idf")[0], F.col("df")),
        "linear": (models.load_linear(spark, f"{path}/linear").weights, F.col("idx")),
    }
    rows = [t.agg(F.lit(k).alias("kind"), F.count("*").alias("n_rows"), F.sum(x).cast("bigint").alias("total")) for k, (t, x) in loaded.items()]
    return reduce(DataFrame.unionByName, rows)


QUERIES = {
    f.__name__: f
    for f in (
        stratified_split, bow_fit, bow_transform, vocab_lookup, vocab_index, w2v_vocab, oov_tokens, vocab_union,
        active_terms, document_frequency, idf, idf_lookup, lm_train, lm_vocab_size, lm_probability,
        lm_log_likelihood, lm_sequence_probability, lm_perplexity, predict_next_words, predict_next_words_mle,
        nb_priors, nb_word_likelihood, class_word_grid, nb_log_scores, nb_predict_proba, nb_predict, predict_argmax,
        nb_fit_counts, tfidf_fit, max_features_cap, tfidf_transform, load_model,
    )
}

_BIGRAM_TFIDF = S.tfidf(1, 2, 2, 8000)
_TRAIN_TF = "train_tf AS MATERIALIZED (SELECT tf.* FROM tf JOIN split USING (doc_id) WHERE split = 'train')"
_TEST_TF = "test_tf AS MATERIALIZED (SELECT tf.* FROM tf JOIN split USING (doc_id) WHERE split = 'test')"
_N_TRAIN = "(SELECT count(*) FROM split WHERE split = 'train')"
_LL = (
    *S.LM,
    S.bigrams("bench", "held"),
    "p AS (SELECT h.doc_id, (coalesce(cnt, 0) + 1.0::DOUBLE) / (coalesce(total, 0) + (SELECT count(*) FROM words)) AS p, coalesce(cnt, 0) AS c "
    "FROM held h LEFT JOIN lm USING (context, word) LEFT JOIN ctx USING (context))",
)
_NEXT = (
    *S.LM,
    S.bigrams("bench", "held"),
    "asked AS (SELECT context FROM ctx UNION SELECT context FROM held)",
    "seen AS (SELECT context, word, cnt FROM lm QUALIFY row_number() OVER (PARTITION BY context ORDER BY cnt DESC, word) <= 3)",
    "few AS (SELECT a.context FROM asked a LEFT JOIN seen s USING (context) GROUP BY 1 HAVING count(s.word) < 3)",
    "fill AS (SELECT few.context, fw.word, 0 AS cnt FROM few CROSS JOIN (SELECT word FROM words ORDER BY word LIMIT 6) fw "
    "LEFT JOIN seen s ON s.context = few.context AND s.word = fw.word WHERE s.word IS NULL)",
)

SQL = {
    "stratified_split": S.query("split", "SELECT doc_id, category, split FROM split"),
    "bow_fit": S.query("vocab", "SELECT term, idx FROM vocab"),
    "bow_transform": S.query(
        "tf split", "SELECT doc_id, term, idx, cnt FROM test_tf JOIN v USING (term)", _TEST_TF, _TRAIN_TF,
        "v AS MATERIALIZED (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM (SELECT DISTINCT term FROM train_tf))",
    ),
    "vocab_lookup": S.query(
        "tf", "SELECT doc_id, idx, cnt FROM tf JOIN v USING (term)",
        "v AS (SELECT term, row_number() OVER (ORDER BY sum(cnt) DESC, term) - 1 AS idx FROM tf GROUP BY term HAVING sum(cnt) >= 5)",
    ),
    "vocab_index": S.query("tf", "SELECT term, sum(cnt)::BIGINT AS cnt, row_number() OVER (ORDER BY sum(cnt) DESC, term) - 1 AS idx FROM tf GROUP BY term"),
    "w2v_vocab": S.query(
        "tf", "SELECT term, sum(cnt)::BIGINT AS cnt, row_number() OVER (ORDER BY sum(cnt) DESC, term) - 1 AS idx FROM tf GROUP BY term HAVING sum(cnt) >= 5"
    ),
    "oov_tokens": S.query(
        "tf bench", "SELECT doc_id, term, count(*) AS cnt FROM b WHERE term NOT IN (SELECT term FROM tf) GROUP BY ALL",
        "b AS (SELECT doc_id, unnest(tokens) AS term FROM bench)",
    ),
    "vocab_union": S.query(
        "tf bench turns", "SELECT term FROM tf UNION SELECT unnest(tokens) FROM bench UNION SELECT unnest(tokens) FROM turns"
    ),
    "active_terms": S.query("tok split", "SELECT doc_id, term FROM feats JOIN split USING (doc_id) WHERE split = 'test'", *_BIGRAM_TFIDF),
    "document_frequency": S.query("tf", "SELECT term, count(*) AS df FROM tf GROUP BY 1"),
    "idf": S.query(
        "tf split",
        f"SELECT term, count(*) AS df, {S.r6(f'ln(({_N_TRAIN} + 1.0::DOUBLE) / (count(*) + 1)) + 1')} AS idf, "
        f"{S.r6(f'ln({_N_TRAIN}::DOUBLE / count(*))')} AS plain, {S.r6(f'ln({_N_TRAIN} + 1.0::DOUBLE)')} AS default_plain FROM train_tf GROUP BY term",
        _TRAIN_TF,
    ),
    "idf_lookup": S.query(
        "tf split",
        f"SELECT doc_id, term, {S.r6(f'coalesce(idf, ln({_N_TRAIN} + 1.0::DOUBLE) + 1)')} AS idf FROM test_tf LEFT JOIN i USING (term)",
        _TRAIN_TF, _TEST_TF,
        f"i AS MATERIALIZED (SELECT term, ln(({_N_TRAIN} + 1.0::DOUBLE) / (count(*) + 1)) + 1 AS idf FROM train_tf GROUP BY term)",
    ),
    "lm_train": S.query(
        "tok",
        " UNION ALL ".join(f"SELECT {n}::INTEGER AS n, context, word, count(*) AS cnt FROM g{n} GROUP BY ALL" for n in (2, 3, 4, 5)),
        *[S.bigrams("tok", f"g{n}", n) for n in (2, 3, 4, 5)],
    ),
    "lm_vocab_size": S.query("tok", "SELECT (SELECT count(*) FROM words) AS vocab_size, (SELECT sum(cnt)::BIGINT FROM lm) AS total_tokens", *S.LM),
    "lm_probability": S.query(
        "tok bench",
        "SELECT DISTINCT context, word, round((coalesce(cnt, 0) + 1.0::DOUBLE) / (coalesce(total, 0) + (SELECT count(*) FROM words)), 9) AS laplace, "
        "round(coalesce(cnt / total::DOUBLE, 0), 9) AS mle FROM held LEFT JOIN lm USING (context, word) LEFT JOIN ctx USING (context)",
        *S.LM, S.bigrams("bench", "held"),
    ),
    "lm_log_likelihood": S.query(
        "tok bench", f"SELECT b.doc_id, {S.r6('coalesce(sum(ln(p)), 0)')} AS laplace, coalesce(bool_or(c = 0), false) AS mle_impossible FROM bench b LEFT JOIN p USING (doc_id) GROUP BY 1", *_LL
    ),
    "lm_sequence_probability": S.query(
        "tok turns",
        "SELECT doc_id, CASE WHEN q < 1e-300 THEN 0 ELSE floor(log10(q)) END::INTEGER AS power, "
        "CASE WHEN q < 1e-300 THEN 0 ELSE round(q / pow(10.0::DOUBLE, floor(log10(q))), 5) END::DOUBLE AS digits FROM "
        "(SELECT b.doc_id, exp(coalesce(sum(ln(p)), 0)) AS q FROM turns b LEFT JOIN p USING (doc_id) GROUP BY 1)",
        *S.LM, S.bigrams("turns", "held"), _LL[-1],
    ),
    "lm_perplexity": S.query(
        "tok bench", "SELECT doc_id, count(*) AS n_predictions, round(exp(-sum(ln(p)) / count(*)), 3) AS perplexity FROM p GROUP BY 1", *_LL
    ),
    "predict_next_words": S.query(
        "tok bench",
        "SELECT context, (row_number() OVER (PARTITION BY context ORDER BY cnt DESC, word))::INTEGER AS rank, word, "
        "round((cnt + 1.0::DOUBLE) / (coalesce(total, 0) + (SELECT count(*) FROM words)), 9) AS p FROM "
        "(SELECT * FROM seen UNION ALL SELECT * FROM fill) LEFT JOIN ctx USING (context) QUALIFY rank <= 3",
        *_NEXT,
    ),
    "predict_next_words_mle": S.query(
        "tok",
        "SELECT context, (row_number() OVER (PARTITION BY context ORDER BY cnt DESC, word))::INTEGER AS rank, word, "
        "round(cnt / total::DOUBLE, 9) AS p FROM lm JOIN ctx USING (context) QUALIFY rank <= 3",
        *S.LM,
    ),
    "nb_priors": S.query("tf split", f"SELECT category, n_docs, {S.r6('prior')} AS prior, {S.r6('ln(prior)')} AS log_prior FROM priors", *S.NB[:2]),
    "nb_word_likelihood": S.query("tf split", f"SELECT category, term, cnt, {S.r6('log_prob')} AS log_prob FROM nb", *S.NB[:6]),
    "class_word_grid": S.query("tf split", "SELECT category, term, cnt FROM nb", *S.NB[:6]),
    "nb_log_scores": S.query("tf split", "SELECT doc_id, category, round(score, 4) AS score FROM scores", *S.NB),
    "nb_predict_proba": S.query("tf split", f"SELECT doc_id, category, {S.r6('probability')} AS probability FROM post", *S.NB),
    "nb_predict": S.query("tf split", "SELECT doc_id, predicted FROM best", *S.NB),
    "predict_argmax": S.query(
        "tf split",
        "SELECT doc_id, split.category, predicted, round(score, 4) AS score FROM best JOIN split USING (doc_id) JOIN "
        "(SELECT doc_id, max(score) AS score FROM scores GROUP BY 1) USING (doc_id)", *S.NB
    ),
    "nb_fit_counts": S.query(
        "tf split",
        f"SELECT category, term, cw.cnt::BIGINT AS cnt, {S.r6('ln(cw.cnt + 0.5::DOUBLE) - ln(total + 0.5::DOUBLE * (SELECT count(*) FROM voc))')} AS log_prob FROM cw JOIN tot USING (category)",
        *S.NB[:5],
    ),
    "tfidf_fit": S.query("tok split", f"SELECT term, df, idx, {S.r6('idf')} AS idf FROM fitted", *_BIGRAM_TFIDF),
    "max_features_cap": S.query("tok split", "SELECT term, df, idx FROM fitted", *S.tfidf(1, 1, 2, 500)),
    "tfidf_transform": S.query(
        "tok split", f"SELECT doc_id, term, idx, {S.r6('value')} AS value FROM feats JOIN split USING (doc_id) WHERE split = 'test'", *_BIGRAM_TFIDF
    ),
    "load_model": S.query(
        "tok tf split vectors",
        "SELECT 'naive_bayes' AS kind, count(DISTINCT term) AS n_rows, sum(cnt)::BIGINT AS total FROM tf JOIN split USING (doc_id) WHERE split = 'train' "
        "UNION ALL SELECT 'tfidf', count(*), sum(df)::BIGINT FROM fitted UNION ALL SELECT 'language_model', count(*), sum(cnt)::BIGINT FROM lm "
        "UNION ALL SELECT 'vectors', count(*), sum(len(vec))::BIGINT FROM vectors UNION ALL SELECT 'idf', count(DISTINCT term), count(*) FROM tf "
        f"UNION ALL SELECT 'linear', {len(I.LANGS)} * count(*), {len(I.LANGS)} * sum(idx)::BIGINT FROM fitted",
        *[x for x in _BIGRAM_TFIDF if not x.startswith("feats")], S.bigrams("tok", "windows"),
        "lm AS (SELECT context, word, count(*) AS cnt FROM windows GROUP BY ALL)",
    ),
}
