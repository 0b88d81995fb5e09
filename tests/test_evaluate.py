import pytest

from corpusloom.operators import evaluate

CLASSES = ["a", "b", "c"]


@pytest.fixture
def pairs(spark):
    rows = [(1, "a", "a"), (2, "a", "b"), (3, "b", "b"), (4, "b", "b"), (5, "z", "a"), (6, "a", "z")]
    return spark.createDataFrame(rows, "doc_id bigint, actual string, predicted string")


def test_matrix_skips_unknown_labels(pairs):
    got = {(r["actual"], r["predicted"]): r["n"] for r in evaluate.confusion_matrix(pairs, CLASSES).collect()}
    assert len(got) == 9 and got["a", "a"] == 1 and got["a", "b"] == 1 and got["b", "b"] == 2 and sum(got.values()) == 4
    wide = {r["actual"]: (r["a"], r["b"], r["c"]) for r in evaluate.confusion_wide(pairs, CLASSES).collect()}
    assert wide["a"] == (1, 1, 0)


def test_per_class(pairs):
    got = {r["category"]: r for r in evaluate.per_class_metrics(pairs, CLASSES).collect()}
    assert (got["a"]["precision"], got["a"]["recall"], got["a"]["support"]) == (1.0, 0.5, 2)
    assert got["b"]["precision"] == 0.6667 and got["b"]["f1"] == 0.8
    assert (got["c"]["precision"], got["c"]["recall"], got["c"]["f1"]) == (0, 0, 0)


def test_summary_counts_unknown_labels_as_wrong(pairs):
    got = evaluate.summary_metrics(pairs, CLASSES).first()
    assert got["accuracy"] == 0.5
    # an exact decimal tie, 0.73335: JVM and Python round it to different neighbours
    assert got["weighted_f1"] == pytest.approx((0.6667 * 2 + 0.8 * 2) / 4, abs=5.1e-5)


def test_published_matrix(spark):
    # a five-class matrix with trace 433 of 445
    n = {("a", "a"): 433, ("a", "b"): 12}
    rows = [(a, p) for (a, p), k in n.items() for _ in range(k)]
    got = evaluate.summary_metrics(spark.createDataFrame(rows, "actual string, predicted string"), CLASSES).first()
    assert got["accuracy"] == 0.973


def test_empty_input(spark):
    empty = spark.createDataFrame([], "actual string, predicted string")
    got = evaluate.summary_metrics(empty, CLASSES).first()
    assert got["accuracy"] == 0 and got["macro_f1"] == 0


def test_votes(spark):
    rows = [(1, 0, "x"), (1, 1, "y"), (1, 2, "y"), (2, 0, "z"), (2, 1, "a")]
    got = {r["doc_id"]: (r["label"], r["agree"], r["n_models"]) for r in
           evaluate.consensus_vote(spark.createDataFrame(rows, "doc_id bigint, model_ord int, predicted string")).collect()}
    assert got == {1: ("y", 2, 3), 2: ("z", 1, 2)}


def test_probability_table(spark):
    rows = [(1, "a", "m1", 0.25), (1, "a", "m2", 0.5), (1, "b", "m1", 0.75)]
    frame = spark.createDataFrame(rows, "doc_id bigint, category string, model string, probability double")
    got = {r["category"]: (r["m1"], r["m2"]) for r in evaluate.probability_table(frame, ["m1", "m2"]).collect()}
    assert got == {"a": ("25.00%", "50.00%"), "b": ("75.00%", "0.00%")}


def test_reasons(spark):
    frame = spark.createDataFrame([("tech", "politics"), ("x", "y")], "actual string, predicted string")
    got = {r["actual"]: r["reason"] for r in evaluate.with_reason(frame).collect()}
    assert "cyber-security" in got["tech"] and "indicators for y" in got["x"]


def test_errors_are_numbered(pairs):
    got = evaluate.ranked_errors(pairs, 2).orderBy("rank").collect()
    assert [(r["rank"], r["doc_id"], r["n_errors"]) for r in got] == [(1, 2, 3), (2, 5, 3)]
