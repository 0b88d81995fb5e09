"""Queries for linear models, metrics and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import inputs as I
from corpusloom.catalog import sql as S
from corpusloom.operators import counts, evaluate, linear, tfidf
from corpusloom.plans import jobs
from corpusloom.plans.lineage import materialize, scratch_path
from corpusloom.sources import reports

FULL = jobs.Settings()


def _embedding_data(spark, sf):
    given = I.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("string").alias("category"), "embedding"
    )
    features = given.select("doc_id", F.posexplode("embedding").alias("idx", "value")).select(
        "doc_id", F.col("idx").cast("bigint").alias("idx"), F.col("value").cast("double").alias("value")
    )
    return given.select("doc_id", "category"), features


def _hash_scored(spark, sf):
    train, test = I.split_tokens(spark, sf)
    fitted = tfidf.fit(train, 1, 2, 2, 8000)
    model = I.hash_model(fitted.vocab)
    features = tfidf.transform(test, fitted).drop("term")
    return test, fitted, model, linear.predict(test, features, model)


def _pairs(spark, sf, salt="a"):
    p = I.noisy_predictions(spark, sf, salt)
    return p.select("doc_id", F.col("category").alias("actual"), "predicted")


# --- linear models ------------------------------------------------------------------------


def lr_gd_step(spark, sf):
    labels, features = _embedding_data(spark, sf)
    names = sorted(r["category"] for r in labels.select("category").distinct().collect())
    each = F.explode(F.array(*[F.lit(c) for c in names])).alias("category")
    weights = spark.range(I.DIM).select(each, F.col("id").alias("idx"), F.lit(0.0).alias("weight"))
    bias = spark.createDataFrame([(c, 0.0) for c in names], "category string, bias double")
    w, b = linear.gradient_step(labels, features, weights, bias)
    return w.join(b, "category").select("category", "idx", F.round("weight", 8).alias("weight"), F.round("bias", 8).alias("bias"))


def binary_lr_fit(spark, sf):
    labels = I.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("category"))
    docs = materialize(I.tokens(spark, sf).join(labels.select("doc_id"), "doc_id", "left_semi"), "tokens")
    fitted = tfidf.fit(docs, 1, 1, FULL.min_df, FULL.max_unigrams)
    features = tfidf.transform(docs, fitted).drop("term")
    model = linear.fit(labels, features, fitted.vocab.count(), ["1"], n_iterations=FULL.n_iterations)
    return model.losses.select("category", "iteration", F.round("loss", 4).alias("loss"))


def ovr_fit(spark, sf):
    labels, features = _embedding_data(spark, sf)
    names = sorted(r["category"] for r in labels.select("category").distinct().collect())
    model = linear.fit(labels, features, I.DIM, names, n_iterations=FULL.n_iterations)
    return model.weights.select("category", "idx", F.round("weight", 6).alias("weight"))


def ovr_predict_proba(spark, sf):
    scored = _hash_scored(spark, sf)[3]
    entries = F.arrays_zip(F.array(*[F.lit(c) for c in I.LANGS]).alias("category"), F.col("probabilities").alias("p"))
    return scored.select("doc_id", F.explode(entries).alias("e")).select("doc_id", F.col("e.category").alias("category"), I.r6(F.col("e.p"), "probability"))


def ovr_predict(spark, sf):
    return _hash_scored(spark, sf)[3].select("doc_id", "predicted")


def top_features(spark, sf):
    train, _ = I.split_tokens(spark, sf)
    fitted = tfidf.fit(train, 1, 2, 2, 8000)
    return linear.top_features(I.hash_model(fitted.vocab).weights.drop("term"), fitted.vocab, 25)


def explain_instance(spark, sf):
    test, fitted, model, _ = _hash_scored(spark, sf)
    weights = model.weights.select("term", "category", "weight")
    top = tfidf.explain(test, fitted, weights, 5)
    return top.select("doc_id", "category", "rank", "term", I.r6(F.col("tfidf"), "tfidf"), I.r6(F.col("contribution"), "contribution"))


def error_analysis(spark, sf):
    test, fitted, model, scored = _hash_scored(spark, sf)
    scored = materialize(scored, "scored")
    weights = model.weights.select("term", "category", "weight")
    raw = I.table(spark, sf, "documents").select(
        "doc_id", F.col("lang").alias("category"), F.lit(None).cast("string").alias("title"), "text"
    ).join(test.select("doc_id"), "doc_id", "left_semi")
    report = evaluate.error_analysis(raw, scored, model.classes, tfidf.explain(test, fitted, weights, 5))
    return report.select("rank", "n_errors", "doc_id", "actual", "predicted", "title", "preview", "confidence", "predicted_terms", "actual_terms")


# --- metrics --------------------------------------------------------------------------------


def truth_vs_pred(spark, sf):
    p = I.noisy_predictions(spark, sf)
    return evaluate.truth_vs_pred(p.select("doc_id", "category"), p.select("doc_id", "predicted"))


def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_pairs(spark, sf), I.LANGS)


def per_class_metrics(spark, sf):
    return evaluate.per_class_metrics(_pairs(spark, sf), I.LANGS)


def summary_metrics(spark, sf):
    return evaluate.summary_metrics(_pairs(spark, sf), I.LANGS)


def accuracy_score(spark, sf):
    return evaluate.accuracy(_pairs(spark, sf)).select(I.r6(F.col("accuracy"), "accuracy"))


def consensus_vote(spark, sf):
    votes = None
    for i, salt in enumerate("abc"):
        one = I.noisy_predictions(spark, sf, salt).select("doc_id", F.lit(i).alias("model_ord"), "predicted")
        votes = one if votes is None else votes.unionByName(one)
    return evaluate.consensus_vote(votes)


def reason_lookup(spark, sf):
    rules = [("en", "fr", "French words in English text."), ("de", "en", "English terms in German text.")]
    wrong = _pairs(spark, sf).where(F.col("actual") != F.col("predicted"))
    return evaluate.with_reason(wrong, rules).select("doc_id", "reason")


def error_rank(spark, sf):
    return evaluate.ranked_errors(_pairs(spark, sf)).select("rank", "doc_id", "actual", "predicted", "n_errors")


def _comparison(spark, sf):
    return evaluate.model_comparison(
        [(f"pipeline_{s}", f"model {s}", "noisy", evaluate.summary_metrics(_pairs(spark, sf, s), I.LANGS)) for s in "abc"]
    )


def model_comparison(spark, sf):
    return _comparison(spark, sf)


def write_reports(spark, sf):
    path = scratch_path(spark, "report")
    reports.write_comparison(_comparison(spark, sf), path)
    back = spark.read.csv(path, header=True)
    return back.select(*[F.col(v).alias(k) for k, v in reports.COMPARISON_HEADER.items()])


QUERIES = {
    f.__name__: f
    for f in (
        lr_gd_step, binary_lr_fit, ovr_fit, ovr_predict_proba, ovr_predict, top_features, explain_instance,
        error_analysis, truth_vs_pred, confusion_matrix, per_class_metrics, summary_metrics, accuracy_score,
        consensus_vote, reason_lookup, error_rank, model_comparison, write_reports,
    )
}

_FEATURES = S.tfidf(1, 2, 2, 8000)
_NOISY = S.noisy("a")
_STEP = """WITH x AS (SELECT vec_id, label::VARCHAR AS category, unnest(generate_series(0, 63)) AS idx, unnest(embedding)::DOUBLE AS v FROM embeddings),
    c AS (SELECT DISTINCT label::VARCHAR AS category FROM embeddings),
    m AS (SELECT count(*)::DOUBLE AS m FROM embeddings),
    b AS (SELECT c.category, -0.5 * avg(0.5 - (e.label::VARCHAR = c.category)::INTEGER) AS bias FROM embeddings e CROSS JOIN c GROUP BY 1)
    SELECT b.category, idx, (round(-0.5 * sum((0.5 - (x.category = b.category)::INTEGER) * v) / (SELECT m FROM m), 8) + 0.0) AS weight,
    round(bias, 8) AS bias FROM x CROSS JOIN b GROUP BY ALL"""
_EXPLAIN = (
    "contrib AS (SELECT doc_id, w.category, term, value AS tfidf, weight, value * weight AS contribution "
    "FROM feats JOIN wts w USING (term) JOIN split s USING (doc_id) WHERE split = 'test')",
    "ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, category ORDER BY contribution DESC, term) AS rank FROM contrib QUALIFY rank <= 5)",
)
_COMPARE = (
    "SELECT {i}::INTEGER AS ord, 'PIPELINE_{u}' AS pipeline_id, 'model {s}' AS model, 'noisy' AS representation, printf('%.4f', accuracy) AS accuracy, "
    "printf('%.4f', macro_precision) AS macro_precision, printf('%.4f', macro_recall) AS macro_recall, "
    "printf('%.4f', macro_f1) AS macro_f1, printf('%.4f', weighted_f1) AS weighted_f1 FROM ({q})"
)


def _summary(salt: str) -> str:
    return S.query("", "SELECT * FROM summary", S.noisy(salt), *S.METRICS)


_ALL = " UNION ALL ".join(_COMPARE.format(i=i, u=s.upper(), s=s, q=_summary(s)) for i, s in enumerate("abc", 1))

SQL = {
    "lr_gd_step": _STEP,
    "ovr_predict_proba": S.query("tok split", f"SELECT doc_id, category, {S.r6('probability')} AS probability FROM ovr", *_FEATURES, *S.HASH_SCORES),
    "ovr_predict": S.query("tok split", "SELECT doc_id, predicted FROM pick", *_FEATURES, *S.HASH_SCORES),
    "top_features": S.query(
        "tok split",
        "SELECT category, row_number() OVER (PARTITION BY category ORDER BY weight DESC, term)::INTEGER AS rank, term, round(weight, 4) AS weight FROM wts QUALIFY rank <= 25",
        *_FEATURES, *S.HASH_SCORES[:2],
    ),
    "explain_instance": S.query(
        "tok split",
        f"SELECT doc_id, category, rank::INTEGER AS rank, term, {S.r6('tfidf')} AS tfidf, {S.r6('contribution')} AS contribution FROM ranked",
        *_FEATURES, *S.HASH_SCORES[:2], *_EXPLAIN,
    ),
    "error_analysis": S.query(
        "tok split",
        "SELECT e.rank::INTEGER AS rank, n_errors, e.doc_id, actual, e.predicted, 'No Title' AS title, "
        f"array_to_string(regexp_split_to_array({S.strip('text')}, '[{S.T.SPACES}]+')[1:50], ' ') || '...' AS preview, "
        f"{S.r6('(SELECT max(probability) FROM ovr WHERE ovr.doc_id = e.doc_id)')} AS confidence, "
        "coalesce(p.terms, '') AS predicted_terms, coalesce(a.terms, '') AS actual_terms FROM e JOIN documents USING (doc_id) "
        "LEFT JOIN t p ON p.doc_id = e.doc_id AND p.category = e.predicted LEFT JOIN t a ON a.doc_id = e.doc_id AND a.category = e.actual",
        *_FEATURES, *S.HASH_SCORES, *_EXPLAIN,
        "wrong AS (SELECT pick.doc_id, split.category AS actual, predicted FROM pick JOIN split USING (doc_id) WHERE split.category <> predicted)",
        "e AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS rank, count(*) OVER () AS n_errors FROM wrong QUALIFY rank <= 20)",
        "t AS (SELECT doc_id, category, string_agg(term || ' (w=' || printf('%.2f', weight) || ')', ', ' ORDER BY rank) AS terms FROM ranked WHERE rank <= 4 GROUP BY ALL)",
    ),
    "truth_vs_pred": S.query("", "SELECT doc_id, actual, predicted FROM pairs", _NOISY),
    "confusion_matrix": S.query(
        "",
        "SELECT a.category AS actual, p.category AS predicted, count(pairs.doc_id) AS n FROM langs a CROSS JOIN langs p "
        "LEFT JOIN pairs ON pairs.actual = a.category AND pairs.predicted = p.category GROUP BY ALL",
        _NOISY, S.METRICS[0],
    ),
    "per_class_metrics": S.query(
        "", "SELECT category, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, support FROM f1s", _NOISY, *S.METRICS
    ),
    "summary_metrics": _summary("a"),
    "accuracy_score": S.query("", f"SELECT {S.r6('avg((actual = predicted)::INTEGER)')} AS accuracy FROM pairs", _NOISY),
    "consensus_vote": S.query(
        "",
        "SELECT doc_id, predicted AS label, count(*) AS agree, 3::BIGINT AS n_models FROM v GROUP BY doc_id, predicted "
        "QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(ord)) = 1",
        *[S.noisy(s, f"n{s}") for s in "abc"],
        "v AS (SELECT doc_id, predicted, 0 AS ord FROM na UNION ALL SELECT doc_id, predicted, 1 FROM nb UNION ALL SELECT doc_id, predicted, 2 FROM nc)",
    ),
    "reason_lookup": S.query(
        "",
        "SELECT doc_id, CASE WHEN actual = 'en' AND predicted = 'fr' THEN 'French words in English text.' WHEN actual = 'de' AND predicted = 'en' "
        "THEN 'English terms in German text.' ELSE 'Cross-domain terminology: text contains strong positive indicators for ' || predicted || "
        "' which statistically outnumbered unique features for ' || actual || '.' END AS reason FROM pairs WHERE actual <> predicted",
        _NOISY,
    ),
    "error_rank": S.query(
        "",
        "SELECT row_number() OVER (ORDER BY doc_id)::INTEGER AS rank, doc_id, actual, predicted, count(*) OVER () AS n_errors FROM pairs "
        "WHERE actual <> predicted QUALIFY rank <= 20",
        _NOISY,
    ),
    "model_comparison": _ALL,
    "write_reports": f"SELECT * EXCLUDE (ord) FROM ({_ALL})",
}
