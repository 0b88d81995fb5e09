import pytest

from corpusloom.catalog import job_queries, linear_queries, vector_queries
from corpusloom.operators import cluster, linear, vectors
from corpusloom.plans import jobs

SF = "/root/testdata/sf0.001"


class Seen(Exception):
    """Ends a query at its trainer, with the settings it came with."""


def caught(monkeypatch, module, name, query, spark):
    def stop(*args, **kwargs):
        raise Seen(args, kwargs)

    monkeypatch.setattr(module, name, stop)
    with pytest.raises(Seen) as e:
        query(spark, SF)
    return e.value.args


def test_trainers_run_at_full_settings(spark, monkeypatch):
    assert job_queries.SETTINGS == jobs.Settings()
    for query in (linear_queries.ovr_fit, linear_queries.binary_lr_fit):
        assert caught(monkeypatch, linear, "fit", query, spark)[1]["n_iterations"] == 800
    assert caught(monkeypatch, linear_queries.tfidf, "fit", linear_queries.binary_lr_fit, spark)[0][1:] == (1, 1, 2, 5000)
    assert caught(monkeypatch, vectors, "skipgram_fit", vector_queries.skipgram_fit, spark)[0][1:] == (100, 2, 5, 5)
    assert caught(monkeypatch, cluster, "kmeans_fit", vector_queries.kmeans_fit, spark)[1]["n_init"] == 10


def test_jobs_take_the_default_starts(spark, monkeypatch):
    monkeypatch.setattr(job_queries, "_trained", lambda *_: (None,) * 4)
    for name in ("job_evaluate", "job_train_all"):
        assert "n_init" not in caught(monkeypatch, jobs, name, getattr(job_queries, name), spark)[1]


def test_skipgram_query_returns_all_components(spark):
    rows = vector_queries.skipgram_fit(spark, SF)
    assert rows.columns == ["word", "dim", "value"]
    assert {r["n"] for r in rows.groupBy("word").count().withColumnRenamed("count", "n").select("n").distinct().collect()} == {100}
