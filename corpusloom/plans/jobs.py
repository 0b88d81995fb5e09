"""End-to-end jobs: train every model, evaluate all of them, score new texts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import cluster, counts, evaluate, language_model, linear, naive_bayes, tfidf, vectors
from corpusloom.operators.linear import OneVsRest
from corpusloom.operators.preprocess import TextConfig, input_status, preprocess
from corpusloom.operators.split import stratified_split
from corpusloom.plans.lineage import bounded_rows, materialize
from corpusloom.sources import models as store
from corpusloom.sources import reports
from corpusloom.sources.vectors import random_vectors

PRIMARY = "tfidf_unigram_bigram"

# Pipeline id, model key, model name and representation, in report order.
PIPELINES = (
    ("pipeline_a", "naive_bayes", "Naive Bayes", "Count / BoW"),
    ("pipeline_b", "w2v_mean", "Logistic Regression", "Word2Vec Mean"),
    ("pipeline_c", "w2v_tfidf", "Logistic Regression", "Word2Vec TF-IDF"),
    ("pipeline_d", "glove_mean", "Logistic Regression", "GloVe Mean"),
    ("pipeline_e", "glove_tfidf", "Logistic Regression", "GloVe TF-IDF"),
    ("pipeline_f", "tfidf_unigram", "Logistic Regression", "TF-IDF Unigram"),
    ("pipeline_g", PRIMARY, "Logistic Regression", "TF-IDF Unigram + Bigram"),
)


@dataclass(frozen=True)
class Settings:
    """Hyper-parameters of a full run."""

    test_size: float = 0.2
    seed: int = 42
    dim: int = 100
    window: int = 2
    min_count: int = 5
    w2v_epochs: int = 5
    learning_rate: float = 0.5
    n_iterations: int = 800
    l2: float = 1e-4
    min_df: int = 2
    max_unigrams: int = 5000
    max_bigrams: int = 8000
    orders: tuple[int, ...] = (2, 3, 4, 5)
    text: TextConfig = TextConfig()


@dataclass(frozen=True)
class Features:
    """Fitted representations, all learned from the training split."""

    w2v: DataFrame
    glove: DataFrame
    idf: DataFrame
    default_idf: float
    unigram: tfidf.Tfidf
    bigram: tfidf.Tfidf
    dim: int

    def vectors_of(self, docs: DataFrame, key: str) -> DataFrame:
        """Pooled document vectors for one of the embedding pipelines."""
        table = self.w2v if key.startswith("w2v") else self.glove
        if key.endswith("_mean"):
            return vectors.pool_mean(docs, table, self.dim)
        return vectors.pool_tfidf(docs, table, self.idf, self.dim, self.default_idf)

    def of(self, docs: DataFrame, key: str) -> DataFrame:
        """Feature rows (doc_id, idx, value) for one pipeline."""
        if key == "tfidf_unigram":
            return tfidf.transform(docs, self.unigram).drop("term")
        if key == PRIMARY:
            return tfidf.transform(docs, self.bigram).drop("term")
        return vectors.as_features(self.vectors_of(docs, key))

    def size(self, key: str) -> int:
        """Number of features of one pipeline."""
        if key == "tfidf_unigram":
            return self.unigram.vocab.count()
        return self.bigram.vocab.count() if key == PRIMARY else self.dim


@dataclass(frozen=True)
class Trained:
    """Everything a scorer needs."""

    settings: Settings
    classes: list[str]
    naive_bayes: naive_bayes.NaiveBayes
    features: Features
    linear: dict[str, OneVsRest]
    language_models: dict[int, language_model.LanguageModel]


def prepare(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Tokenise once, store, and split; returns training and test tokens."""
    stored = materialize(preprocess(docs.select("doc_id", "category", "text"), settings.text), "tokens")
    both = stratified_split(stored, settings.test_size, settings.seed)
    return both.where("split = 'train'").drop("split"), both.where("split = 'test'").drop("split")


def job_nb(docs: DataFrame, settings: Settings = Settings(), path: str | None = None) -> DataFrame:
    """Train naive Bayes and report sizes and accuracies as (metric, value)."""
    train, test = prepare(docs, settings)
    model = naive_bayes.fit(train).stored()
    if path is not None:
        store.save_naive_bayes(model, path)

    def score(part: DataFrame, name: str) -> DataFrame:
        pairs = evaluate.truth_vs_pred(part, naive_bayes.predict(part, model))
        both = pairs.agg(
            F.avg((F.col("actual") == F.col("predicted")).cast("double")).alias("a"), F.count("*").alias("n")
        )
        figures = F.array(
            F.struct(F.lit(f"{name}_accuracy").alias("metric"), F.col("a").alias("value")),
            F.struct(F.lit(f"{name}_docs").alias("metric"), F.col("n").cast("double").alias("value")),
        )
        return both.select(F.explode(figures).alias("f")).select("f.*")

    size = model.words.agg(F.count("*").cast("double").alias("value")).select(F.lit("vocab_size").alias("metric"), "value")
    return reduce(DataFrame.unionByName, [score(train, "train"), score(test, "test"), size])


def job_w2v(docs: DataFrame, settings: Settings = Settings(), path: str | None = None) -> DataFrame:
    """Train skip-gram vectors on the training split, store them and return them."""
    train, _ = prepare(docs, settings)
    return _train_vectors(train, settings, path)


def _train_vectors(train: DataFrame, s: Settings, path: str | None = None) -> DataFrame:
    found = vectors.skipgram_fit(train, s.dim, s.window, s.min_count, s.w2v_epochs, seed=s.seed)
    if path is not None:
        store.save_vectors(found, path)
        return store.load_vectors(train.sparkSession, path)
    return materialize(found, "w2v")


def fit_features(train: DataFrame, s: Settings, glove: DataFrame | None = None) -> Features:
    """Fit every representation on the training tokens.

    Without pretrained ``glove(word, vec)`` vectors, reproducible random ones stand in.
    """
    if glove is None:
        vocab = counts.vocab_union(train)
        glove = materialize(random_vectors(vocab, s.dim, s.seed), "random-vectors")
    idf, meta = counts.idf_table(train)
    return Features(
        w2v=_train_vectors(train, s),
        glove=glove,
        idf=materialize(idf, "idf"),
        default_idf=meta.first()["default_idf"],
        unigram=tfidf.fit(train, 1, 1, s.min_df, s.max_unigrams),
        bigram=tfidf.fit(train, 1, 2, s.min_df, s.max_bigrams),
        dim=s.dim,
    )


def job_lr_all(
    train: DataFrame, features: Features, classes: list[str], s: Settings = Settings()
) -> dict[str, OneVsRest]:
    """One one-vs-rest model per feature pipeline, all trained in one descent."""
    problems = {key: linear.Problem(features.of(train, key), features.size(key)) for _, key, _, _ in PIPELINES[1:]}
    labels = train.select("doc_id", "category")
    return linear.fit_many(labels, problems, classes, s.learning_rate, s.n_iterations, s.l2, s.seed)


def lr_accuracies(parts: dict[str, DataFrame], features: Features, models: dict[str, OneVsRest]) -> DataFrame:
    """Accuracy per pipeline on each named part, e.g. train and test."""
    rows = [
        evaluate.accuracy(evaluate.truth_vs_pred(part, linear.predict(part, features.of(part, key), model))).select(
            F.lit(key).alias("pipeline"), F.lit(name).alias("part"), "accuracy"
        )
        for key, model in models.items()
        for name, part in parts.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def train_models(
    train: DataFrame, s: Settings = Settings(), glove: DataFrame | None = None, path: str | None = None
) -> Trained:
    """Language models, naive Bayes, representations and six linear models."""
    classes = [r["category"] for r in bounded_rows(train.select("category").distinct(), 1_000, "classes")]
    classes.sort()
    lms = language_model.train_orders(train, list(s.orders)) if s.orders else {}
    nb = naive_bayes.fit(train).stored()
    features = fit_features(train, s, glove)
    models = job_lr_all(train, features, classes, s)
    if path is not None:
        store.save_naive_bayes(nb, f"{path}/naive_bayes")
        store.save_tfidf(features.unigram, f"{path}/tfidf_unigram")
        store.save_tfidf(features.bigram, f"{path}/tfidf_unigram_bigram")
        store.save_vectors(features.w2v, f"{path}/w2v")
        store.save_vectors(features.glove, f"{path}/glove")
        meta = train.sparkSession.createDataFrame([(features.default_idf,)], "default_idf double")
        store.save_idf(features.idf, meta, f"{path}/idf")
        store.save_linear_bundle(models, PRIMARY, f"{path}/linear")
        for n, lm in lms.items():
            store.save_language_model(lm, f"{path}/lm{n}")
    return Trained(s, classes, nb, features, models, lms)


def predict_with(trained: Trained, docs: DataFrame, key: str) -> DataFrame:
    """Predictions of one pipeline on tokenised documents."""
    if key == "naive_bayes":
        return naive_bayes.predict(docs, trained.naive_bayes)
    return linear.predict(docs, trained.features.of(docs, key), trained.linear[key])


@dataclass(frozen=True)
class Evaluation:
    """Reports of one evaluation run."""

    comparison: DataFrame
    per_class: DataFrame
    confusion: DataFrame
    errors: DataFrame
    clustering: DataFrame


def job_evaluate(trained: Trained, test: DataFrame, corpus: DataFrame, path: str | None = None,
                 n_clusters: int = 5, n_init: int = 10) -> Evaluation:
    """Metrics of all seven pipelines on the test split, error analysis and clustering.

    ``corpus(doc_id, category, title, text)`` supplies the raw texts for the report.
    """
    classes, summaries, per_class, confusion, primary = trained.classes, [], [], [], None
    for pid, key, name, representation in PIPELINES:
        predictions = materialize(predict_with(trained, test, key), f"pred-{key}")
        pairs = evaluate.truth_vs_pred(test, predictions)
        summaries.append((pid, name, representation, evaluate.summary_metrics(pairs, classes)))
        per_class.append(evaluate.per_class_metrics(pairs, classes).withColumn("pipeline", F.lit(pid)))
        confusion.append(evaluate.confusion_matrix(pairs, classes).withColumn("pipeline", F.lit(pid)))
        if key == PRIMARY:
            primary = predictions
    model = trained.linear[PRIMARY]
    weights = model.weights.join(trained.features.bigram.vocab.select("idx", "term"), "idx").select(
        "term", "category", "weight"
    )
    wrong = evaluate.ranked_errors(evaluate.truth_vs_pred(test, primary)).select("doc_id")
    reported = test.join(F.broadcast(wrong), "doc_id", "left_semi")  # the rows of the report
    explained = tfidf.explain(reported, trained.features.bigram, weights)
    raw = corpus if "title" in corpus.columns else corpus.withColumn("title", F.lit(None).cast("string"))
    raw = raw.join(test.select("doc_id"), "doc_id", "left_semi")
    out = Evaluation(
        comparison=materialize(evaluate.model_comparison(summaries), "comparison"),
        per_class=materialize(reduce(DataFrame.unionByName, per_class), "per-class"),
        confusion=materialize(reduce(DataFrame.unionByName, confusion), "confusion"),
        errors=materialize(evaluate.error_analysis(raw, primary, classes, explained), "errors"),
        clustering=clustering(trained, test, n_clusters, n_init),
    )
    if path is not None:
        reports.write_comparison(out.comparison, f"{path}/model_comparison")
        reports.write_json(out.per_class, f"{path}/per_class")
        reports.write_json(out.confusion, f"{path}/confusion")
        reports.write_json(out.clustering, f"{path}/clustering")
        reports.write_error_text(out.errors, f"{path}/error_analysis")
        top = linear.top_features(model.weights, trained.features.bigram.vocab)
        reports.write_json(reports.top_features_document(top), f"{path}/top_features")
    return out


def clustering(
    trained: Trained, test: DataFrame, k: int = 5, n_init: int = 10, silhouette: str = "squared"
) -> DataFrame:
    """K-means on the TF-IDF weighted skip-gram vectors: one row of figures.

    ``silhouette`` names the measure: ``squared`` distances in linear time, or ``euclidean``, which
    compares all pairs of points. The row says which one it holds.
    """
    if silhouette not in ("squared", "euclidean"):
        raise ValueError(f"unknown silhouette {silhouette!r}")
    points = trained.features.vectors_of(test, "w2v_tfidf").select(F.col("doc_id").alias("id"), "vec")
    points = materialize(points, "points")
    labels, centers, inertia = cluster.kmeans_fit(points, k, trained.settings.seed, n_init)
    _, ratios, _ = cluster.pca_2d(points, centers)
    placed = points.join(labels, "id")
    if silhouette == "euclidean":
        mean = cluster.silhouette(placed)
    else:
        mean = placed.sparkSession.createDataFrame([(float(cluster.silhouette_squared(placed)),)], "silhouette double")
    return mean.select(
        F.lit(k).alias("k"),
        F.lit(silhouette).alias("silhouette_measure"),
        F.round("silhouette", 4).alias("silhouette_score"),
        F.round(F.lit(float(inertia)), 2).alias("inertia"),
        F.round(F.lit(float(ratios[0])), 4).alias("pca_ratio_1"),
        F.round(F.lit(float(ratios[1])), 4).alias("pca_ratio_2"),
    )


def job_train_all(
    docs: DataFrame, settings: Settings = Settings(), glove: DataFrame | None = None,
    models_path: str | None = None, reports_path: str | None = None, n_init: int = 10,
) -> tuple[Trained, Evaluation]:
    """The full sequence: split, train all models, store them, evaluate and report."""
    train, test = prepare(docs, settings)
    trained = train_models(train, settings, glove, models_path)
    return trained, job_evaluate(trained, test, docs, reports_path, n_init=n_init)


def load_trained(spark: SparkSession, path: str, settings: Settings = Settings()) -> Trained:
    """Restore what ``train_models`` stored under ``path``."""
    idf, default_idf = store.load_idf(spark, f"{path}/idf")
    nb = store.load_naive_bayes(spark, f"{path}/naive_bayes")
    features = Features(
        store.load_vectors(spark, f"{path}/w2v"),
        store.load_vectors(spark, f"{path}/glove"),
        idf,
        default_idf,
        store.load_tfidf(spark, f"{path}/tfidf_unigram"),
        store.load_tfidf(spark, f"{path}/tfidf_unigram_bigram"),
        settings.dim,
    )
    models = {key: store.load_linear(spark, f"{path}/linear", key) for _, key, _, _ in PIPELINES[1:]}
    lms = {n: store.load_language_model(spark, f"{path}/lm{n}") for n in settings.orders}
    return Trained(settings, models[PRIMARY].classes, nb, features, models, lms)


@dataclass(frozen=True)
class Scored:
    """Scores of new texts: long probabilities, votes and input status."""

    probabilities: DataFrame
    consensus: DataFrame
    status: DataFrame


def job_score(trained: Trained, texts: DataFrame, numbers_as_served: bool = False) -> Scored:
    """All seven models on ``texts(doc_id, text)``.

    Tokens follow the configuration the models were trained with;
    ``numbers_as_served`` keeps digits instead.
    """
    config = trained.settings.text
    if numbers_as_served:
        config = TextConfig(**{**config.__dict__, "preserve_numbers": True})
    docs = materialize(preprocess(texts.select("doc_id", "text"), config), "score-tokens")
    parts = []
    for i, (_, key, _, _) in enumerate(PIPELINES):
        p = predict_with(trained, docs, key)
        parts.append(p.select("doc_id", F.lit(i).alias("model_ord"), F.lit(key).alias("model"), "predicted", "probabilities"))
    stacked = materialize(reduce(DataFrame.unionByName, parts), "score-predictions")
    each = F.arrays_zip(F.array(*[F.lit(c) for c in trained.classes]).alias("category"), F.col("probabilities").alias("probability"))
    long = stacked.select("doc_id", "model_ord", "model", "predicted", F.explode(each).alias("e")).select(
        "doc_id", "model_ord", "model", "predicted", F.col("e.category").alias("category"), F.col("e.probability").alias("probability")
    )
    known = [t.select(F.col("word").alias("term")) for t in (trained.features.w2v, trained.features.glove)]
    return Scored(long, evaluate.consensus_vote(stacked), input_status(texts, known, config=config))
