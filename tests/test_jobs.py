import pytest
from pyspark.sql import functions as F

from corpusloom.plans import jobs
from corpusloom.streaming import counting, scoring
from corpusloom.operators import language_model as lm
from corpusloom.sources import corpus

SETTINGS = jobs.Settings(dim=8, w2v_epochs=1, n_iterations=3, min_count=1, orders=(2,), max_unigrams=200, max_bigrams=300)
WORDS = {"sport": "football match goal team cup", "tech": "software code computer chip data"}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, c, f"{WORDS[c]} item {WORDS[c].split()[i % 5]}") for i, c in enumerate(["sport", "tech"] * 20)]
    return spark.createDataFrame(rows, "doc_id bigint, category string, text string").withColumn("title", F.lit("T"))


@pytest.fixture(scope="module")
def run(docs, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    return out, jobs.job_train_all(docs, SETTINGS, models_path=f"{out}/m", reports_path=f"{out}/r", n_init=1)


def test_naive_bayes_job(docs):
    got = {r["metric"]: r["value"] for r in jobs.job_nb(docs, SETTINGS).collect()}
    assert got["test_accuracy"] == 1.0 and got["train_docs"] == 32 and got["test_docs"] == 8


def test_full_run(spark, run):
    out, (trained, evaluation) = run
    rows = evaluation.comparison.orderBy("ord").collect()
    assert [r["pipeline_id"] for r in rows] == [f"PIPELINE_{x}" for x in "ABCDEFG"]
    assert rows[0]["accuracy"] == "1.0000"
    csv = spark.read.csv(f"{out}/r/model_comparison", header=True)
    assert csv.columns[0] == "Pipeline ID" and csv.count() == 7
    assert evaluation.clustering.first()["k"] == 5
    assert spark.read.json(f"{out}/r/top_features").count() == 2


def test_restored_models_score_alike(spark, run, docs):
    out, (trained, _) = run
    back = jobs.load_trained(spark, f"{out}/m", SETTINGS)
    texts = docs.select("doc_id", "text").limit(3).unionByName(spark.createDataFrame([(99, "zork")], "doc_id bigint, text string"))
    a, b = jobs.job_score(trained, texts), jobs.job_score(back, texts)
    key = lambda s: sorted(tuple(r) for r in s.probabilities.select("doc_id", "model", "category", F.round("probability", 9)).collect())
    assert key(a) == key(b) and len(key(a)) == 4 * 7 * 2
    assert a.consensus.count() == 4 and a.consensus.where("n_models <> 7").count() == 0
    assert {r["doc_id"]: r["status"] for r in a.status.collect()}[99] == "oov"


def test_scoring_a_stream(spark, run, docs, tmp_path):
    _, (trained, _) = run
    docs.select("doc_id", "text").limit(6).repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id bigint, text string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    scoring.score_stream(trained, stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).select("doc_id").distinct().count() == 6


def test_counting_a_stream(spark, tokens, tmp_path):
    docs = tokens([(1, "a", "x y z"), (2, "a", "x y"), (3, "a", "z")])
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counting.count_stream(stream, 2, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    streamed = counting.streamed_model(spark, str(tmp_path / "out"), 2)
    assert sorted(streamed.ngrams.collect()) == sorted(lm.train(docs, 2).ngrams.collect())


def test_synthetic_corpus_trains(spark):
    sizes = spark.createDataFrame([("sport", 10), ("tech", 10)], "category string, n bigint")
    train, test = jobs.prepare(corpus.synth_corpus(sizes), SETTINGS)
    assert train.count() == 16 and test.count() == 4
