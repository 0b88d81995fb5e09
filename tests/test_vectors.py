import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.catalog import inputs, vector_queries
from corpusloom.functions import vector as V
from corpusloom.operators import cluster, counts, evaluate, linear, vectors

FRUIT = [("apple", [2.0, 4.0]), ("banana", [4.0, 6.0]), ("cherry", [6.0, 8.0])]


@pytest.fixture
def fruit(spark):
    return spark.createDataFrame(FRUIT, "word string, vec array<double>")


def value(spark, rows, kind, expression):
    return spark.createDataFrame([rows], kind).select(expression.alias("y")).first()["y"]


def test_sigmoid(spark):
    f = lambda z: value(spark, (float(z),), "z double", V.sigmoid(F.col("z")))
    assert f(0) == 0.5 and f(1000) == pytest.approx(1) and 0 <= f(-1000) < 1e-100


def test_logsumexp(spark):
    f = lambda xs: value(spark, (xs,), "x array<double>", V.logsumexp(F.col("x")))
    assert f([-1000.0, -1002.0]) == pytest.approx(-1000 + math.log(1 + math.exp(-2)))
    assert f([500.0, 502.0]) == pytest.approx(502 + math.log(1 + math.exp(-2)))
    assert f([-math.inf, -math.inf]) == -math.inf


def test_cosine(spark):
    f = lambda a, b: value(spark, (a, b), "a array<double>, b array<double>", V.cosine_similarity(F.col("a"), F.col("b")))
    assert f([1.0, 2.0], [1.0, 2.0]) == pytest.approx(1) and f([1.0, 0.0], [0.0, 1.0]) == 0
    assert f([1.0, 0.0], [-1.0, 0.0]) == pytest.approx(-1) and f([0.0, 0.0], [1.0, 1.0]) == 0


def test_normalize_and_argmax(spark):
    f = lambda xs: value(spark, (xs,), "x array<double>", V.normalize_sum(F.col("x")))
    assert f([1.0, 3.0]) == [0.25, 0.75] and f([0.0, 0.0]) == [0.0, 0.0]
    assert value(spark, ([1.0, 2.0, 2.0],), "x array<double>", V.first_max(["a", "b", "c"], F.col("x"))) == "b"


def test_mean_pooling(tokens, fruit):
    docs = tokens([(1, "x", "apple banana"), (2, "x", ""), (3, "x", "zzz"), (4, "x", "apple zzz"), (5, "x", "apple apple cherry")])
    got = {r["doc_id"]: (r["vec"], r["n_valid"]) for r in vectors.pool_mean(docs, fruit, 2).collect()}
    assert got == {1: ([3, 5], 2), 2: ([0, 0], 0), 3: ([0, 0], 0), 4: ([2, 4], 1), 5: ([10 / 3, 16 / 3], 3)}


def test_weighted_pooling(spark, tokens, fruit):
    idf = spark.createDataFrame([("apple", 3.0), ("banana", 1.0), ("cherry", 0.0)], "term string, idf double")
    docs = tokens([(1, "x", "apple banana banana"), (2, "x", "banana unknown"), (3, "x", "cherry")])
    got = {r["doc_id"]: r["vec"] for r in vectors.pool_tfidf(docs, fruit, idf, 2).collect()}
    assert got[1] == pytest.approx([2.8, 4.8]) and got[2] == [4, 6] and got[3] == [0, 0]


def test_pooling_default_idf(spark, tokens, fruit):
    idf = spark.createDataFrame([("apple", 1.0)], "term string, idf double")
    got = vectors.pool_tfidf(tokens([(1, "x", "apple banana")]), fruit, idf, 2, default_idf=3.0).first()
    assert got["vec"] == pytest.approx([3.5, 5.5])


def test_lookup(spark, fruit):
    words = spark.createDataFrame([("Apple",), ("zzz",)], "word string")
    assert {r["word"]: r["vec"] for r in vectors.get_embedding(words, fruit, True).collect()} == {"Apple": [2, 4], "zzz": None}
    assert {r["vec"] for r in vectors.get_embedding(words, fruit).collect()} == {None}
    with pytest.raises(TypeError):
        vectors.get_embedding(words, words)


def test_neighbours(spark):
    table = spark.createDataFrame(
        [("q", [1.0, 0.0]), ("a", [1.0, 1.0]), ("b", [2.0, 2.0]), ("c", [-1.0, 0.0]), ("z", [0.0, 0.0])], "word string, vec array<double>")
    got = [(r["word"], round(r["similarity"], 4)) for r in vectors.nearest_neighbors(table, "q", 4).collect()]
    assert got == [("a", 0.7071), ("b", 0.7071), ("z", 0.0), ("c", -1.0)]
    assert vectors.nearest_neighbors(table, "unknown").count() == 0 and vectors.nearest_neighbors(table, "z").count() == 0


def test_pairs_skip_unknown_tokens(spark, tokens):
    vocab = spark.createDataFrame([(w,) for w in "abcd"], "term string")
    got = vectors.skipgram_pairs(tokens([(1, "x", "a zz b c zz zz d"), (2, "x", "a")]), vocab, 2)
    assert got.count() == 10 and got.where("center = 'a' and context = 'b'").count() == 1


def test_pairs_are_made_of_rows_and_join_repeated_ids(spark, tokens):
    vocab = spark.createDataFrame([(w,) for w in "abcd"], "term string")
    got = vectors.skipgram_pairs(tokens([(1, "x", "a b a zz c"), (1, "x", "d b"), (None, "x", "a c"), (3, "x", "zz")]), vocab, 3)
    want = Counter()
    for i, words in ((1, "adbbac"), (None, "ac")):  # words at the same place of a repeated id come in their order
        want.update((i, words[x], words[y]) for x in range(len(words)) for y in range(len(words)) if x != y and abs(x - y) <= 3)
    assert Counter(map(tuple, got.collect())) == want
    assert "collect_list" not in got._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        vectors.skipgram_pairs(tokens([(1, "x", "a b")]), vocab, 0)


def test_skipgram_fit(spark, tokens):
    docs = tokens([(i, "x", "football team won match " * 3) for i in range(20)])
    got = vectors.skipgram_fit(docs, dim=8, min_count=2, epochs=1)
    assert {r["word"] for r in got.collect()} == {"football", "team", "won", "match"} and len(got.first()["vec"]) == 8
    with pytest.raises(ValueError):
        vectors.skipgram_fit(tokens([(1, "x", "")]), dim=2)


# --- linear models ---------------------------------------------------------------------------


def long_form(spark, x, y):
    labels = spark.createDataFrame([(i, c) for i, c in enumerate(y)], "doc_id bigint, category string")
    rows = [(i, j, float(x[i, j])) for i in range(len(x)) for j in range(x.shape[1])]
    return labels, spark.createDataFrame(rows, "doc_id bigint, idx bigint, value double")


def reference_fit(x, y, classes, steps, lr=0.5, l2=1e-4, seed=42):
    """Plain full-batch descent, to check the distributed one."""
    w = linear.initial_weights(x.shape[1], len(classes), seed)
    b = np.zeros(len(classes))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w.T + b)))
        e = p - (np.array(y)[:, None] == np.array(classes)[None, :])
        w = w - lr * (e.T @ x / len(x) + l2 * w)
        b = b - lr * e.mean(axis=0)
    return w, b


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.RandomState(3)
    classes = ["a", "b", "c"]
    x = np.vstack([rng.randn(20, 5) + 4 * np.eye(5)[i] for i in range(3)])
    return x, [c for c in classes for _ in range(20)], classes


@pytest.mark.parametrize("solver", ["gd", "gd_tasks", "gd_steps"])
def test_gradient_descent_equals_plain_descent(spark, blobs, solver):
    x, y, classes = blobs
    labels, features = long_form(spark, x, y)
    model = linear.fit(labels, features, 5, classes, n_iterations=6, solver=solver)
    want, bias = reference_fit(x, y, classes, 6)
    got = {(r["category"], r["idx"]): r["weight"] for r in model.weights.collect()}
    for c, name in enumerate(classes):
        assert [got[name, j] for j in range(5)] == pytest.approx(list(want[c]))
    assert sorted(r["bias"] for r in model.bias.collect()) == pytest.approx(sorted(bias))


def test_fit_separates_and_loss_falls(spark, blobs):
    x, y, classes = blobs
    labels, features = long_form(spark, x, y)
    model = linear.fit(labels, features, 5, classes, n_iterations=100)
    losses = {(r["category"], r["iteration"]): r["loss"] for r in model.losses.collect()}
    assert all(losses[c, 100] < losses[c, 1] for c in classes)
    scored = linear.predict(labels, features, model)
    assert evaluate.accuracy(evaluate.truth_vs_pred(labels, scored)).first()["accuracy"] > 0.9
    assert all(sum(r["probabilities"]) == pytest.approx(1) for r in scored.collect())


def test_lbfgs_solver(spark, blobs):
    x, y, classes = blobs
    labels, features = long_form(spark, x, y)
    model = linear.fit(labels, features, 5, classes, n_iterations=30, solver="lbfgs")
    scored = linear.predict(labels, features, model)
    assert evaluate.accuracy(evaluate.truth_vs_pred(labels, scored)).first()["accuracy"] > 0.9


def test_both_descents_give_the_same_model(spark, blobs):
    x, y, classes = blobs
    labels, features = long_form(spark, x, y)
    one = linear.fit(labels, features, 5, classes, n_iterations=2)
    other = linear.fit(labels, features, 5, classes, n_iterations=2, solver="gd_tables")
    for table, keys, column in (("weights", ("category", "idx"), "weight"), ("bias", ("category",), "bias"),
                                ("losses", ("category", "iteration"), "loss")):
        a, b = ({tuple(r[k] for k in keys): r[column] for r in getattr(m, table).collect()} for m in (one, other))
        assert len(a) and a == pytest.approx(b)


@pytest.mark.parametrize("entries", [4_000_000, 1])
def test_models_trained_together_equal_models_trained_alone(spark, blobs, monkeypatch, entries):
    monkeypatch.setattr(linear, "MAX_TASK_ENTRIES", entries)
    x, y, classes = blobs
    y = [*y[:-1], "unknown"]
    sparse = np.where(np.abs(x) > 1.5, x, 0)[:, :3]
    sparse[4] = 0
    labels, dense = long_form(spark, x, y)
    features = long_form(spark, sparse, y)[1].where("value <> 0")
    problems = {"dense": linear.Problem(dense, 5), "sparse": linear.Problem(features, 4), "none": linear.Problem(features.limit(0), 2)}
    models = linear.fit_many(labels, problems, classes, n_iterations=101 if entries > 1 else 3)
    steps = 101 if entries > 1 else 3
    for name, data in (("dense", x), ("sparse", np.hstack([sparse, np.zeros((60, 1))])), ("none", np.zeros((60, 2)))):
        want, bias = reference_fit(data, y, classes, steps)
        got = {(r["category"], r["idx"]): r["weight"] for r in models[name].weights.collect()}
        assert len(got) == want.size
        assert [got[c, j] for c in classes for j in range(data.shape[1])] == pytest.approx(list(want.ravel()), abs=1e-9)
        assert {r["category"]: r["bias"] for r in models[name].bias.collect()} == pytest.approx(dict(zip(classes, bias)), abs=1e-9)
        seen = sorted((r["category"], r["iteration"]) for r in models[name].losses.collect())
        assert seen == [(c, i) for c in classes for i in ([1, 100] if entries > 1 else [1])]


def test_nothing_to_train_on(spark, blobs):
    labels, features = long_form(spark, *blobs[:2])
    with pytest.raises(ValueError, match="empty"):
        linear.fit(labels.limit(0), features, 5, blobs[2])


def test_too_many_weights_for_one_step_are_refused(spark, blobs, monkeypatch):
    x, y, classes = blobs
    monkeypatch.setattr(linear, "MAX_TASK_ENTRIES", 1)
    monkeypatch.setattr(linear, "MAX_DRIVER_WEIGHTS", 1)
    with pytest.raises(ValueError, match="gd_tables"):
        linear.fit(*long_form(spark, x, y), 5, classes, n_iterations=1)


def test_start_weights():
    w = linear.initial_weights(20_000, 3, 42)
    assert w.std() == pytest.approx(0.01, rel=0.02) and abs(w.mean()) < 1e-4
    assert abs(np.corrcoef(w)[0, 1]) < 0.03 and (w == linear.initial_weights(20_000, 3, 42)).all()
    assert (w[:, :7] == linear.initial_weights(7, 3, 42)).all() and (w != linear.initial_weights(20_000, 3, 7)).all()


def test_zero_vectors_score_by_bias(spark):
    labels = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    features = spark.createDataFrame([(1, 0, 1.0)], "doc_id bigint, idx bigint, value double")
    model = linear.OneVsRest(
        ["a", "b"],
        spark.createDataFrame([("a", 0, 5.0), ("b", 0, -5.0)], "category string, idx bigint, weight double"),
        spark.createDataFrame([("a", -1.0), ("b", 1.0)], "category string, bias double"),
    )
    got = {r["doc_id"]: r["predicted"] for r in linear.predict(labels, features, model).collect()}
    assert got == {1: "a", 2: "b"}


# --- clustering ------------------------------------------------------------------------------


def brute_silhouette(x, labels):
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = (labels == labels[i]) & (np.arange(len(x)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a = far[i][own].mean()
        b = min(far[i][labels == c].mean() for c in set(labels) - {labels[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


@pytest.mark.parametrize("per_block", [7, 4096])
def test_silhouette_equals_brute_force(spark, per_block):
    rng = np.random.RandomState(1)
    x = rng.randn(40, 3)
    labels = np.array([0] * 20 + [1] * 19 + [2])
    points = spark.createDataFrame([(i, int(labels[i]), x[i].tolist()) for i in range(40)], "id bigint, cluster int, vec array<double>")
    got = cluster.silhouette(points, per_block).first()["silhouette"]
    assert got == pytest.approx(brute_silhouette(x, labels))


def test_silhouette_sums_measure_each_distance_once_and_copies_are_at_zero(monkeypatch):
    rng = np.random.RandomState(4)
    x = rng.randn(90, 5) + 100
    x[30:50] = x[29]
    blocks = [pd.DataFrame({"id": range(i, i + 45), "cluster": [j % 3 for j in range(i, i + 45)], "vec": list(x[i : i + 45])}) for i in (0, 45)]
    measured, distances = [], cluster._distances
    monkeypatch.setattr(cluster, "_distances", lambda a, b: measured.append(len(a) * len(b)) or distances(a, b))
    monkeypatch.setattr(cluster, "TILE", (7, 11))
    ours, theirs = map(cluster._by_cluster, blocks)
    got = pd.concat([cluster._distance_sums(ours, theirs), cluster._distance_sums(ours, None), cluster._distance_sums(theirs, None)])
    assert sum(measured) == 3 * 45 * 45
    got = got.groupby(["id", "cluster"])["total"].sum()
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for i in range(90):
        for c in range(3):
            assert got[i, c] == pytest.approx(far[i, c::3].sum(), rel=1e-9)
    assert (cluster._distances(x[30:40], x[40:50]) == 0).all()


def test_kmeans_and_pca(spark):
    rng = np.random.RandomState(2)
    x = np.vstack([rng.randn(30, 4) * 0.1, rng.randn(30, 4) * 0.1 + [10, 0, 0, 0]])
    points = spark.createDataFrame([(i, x[i].tolist()) for i in range(60)], "id bigint, vec array<double>")
    labels, centers, inertia = cluster.kmeans_fit(points, k=2, n_init=2)
    assert sorted(r["count"] for r in labels.groupBy("cluster").count().collect()) == [30, 30] and inertia < 10
    xy, ratios, placed = cluster.pca_2d(points, centers)
    assert ratios[0] > 0.95 and len(placed) == 2
    assert abs(xy.agg(F.avg("x")).first()[0]) < 1e-9
    both = points.join(labels, "id")
    assert cluster.silhouette_squared(both) > cluster.silhouette(both).first()[0] > 0.9


def test_pooling_rejects_other_lengths(spark):
    docs = spark.createDataFrame([(1, ["a"])], "doc_id bigint, tokens array<string>")
    table = spark.createDataFrame([("a", [1.0, 2.0, 3.0])], "word string, vec array<double>")
    for dim in (2, 5):
        with pytest.raises(Exception, match="3 components"):
            vectors.pool_mean(docs, table, dim).collect()


def test_kmeans_labels_are_nearest_and_inertia_is_their_sum(spark):
    rng = np.random.RandomState(5)
    means = 6 * rng.randn(4, 7)
    x = np.vstack([m + rng.randn(30, 7) for m in means] + [means[0] + 40])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(500, x[3].tolist())]
    points = spark.createDataFrame(rows, "id bigint, vec array<double>")
    labels, centers, inertia = cluster.kmeans_fit(points.repartition(3), k=5, n_init=6)
    c, own = np.array(centers), {r["id"]: r["cluster"] for r in labels.collect()}
    far = ((np.vstack([x, x[3]])[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert [own[i] for i, _ in rows] == far.argmin(axis=1).tolist()
    assert inertia == pytest.approx(far.min(axis=1).sum())
    assert len(set(own.values())) == 5 and [own[i] for i in own].count(own[120]) == 1  # the far point is a cluster
    again = cluster.kmeans_fit(points.repartition(1), k=5, n_init=6)
    assert np.allclose(again[1], centers) and again[2] == pytest.approx(inertia)
    for j in range(5):  # a centre is the mean of its points, within the tolerance
        assert np.linalg.norm(np.vstack([x, x[3]])[[own[i] == j for i, _ in rows]].mean(axis=0) - c[j]) < 0.2


def test_kmeans_on_few_points(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "id bigint, vec array<double>")
    labels, centers, inertia = cluster.kmeans_fit(same, k=3, n_init=2)
    assert len(centers) == 3 and inertia == 0 and {r["cluster"] for r in labels.collect()} == {0}
    with pytest.raises(ValueError, match="no points"):
        cluster.kmeans_fit(same.limit(0), k=2, n_init=1)
    mixed = same.unionByName(spark.createDataFrame([(9, [1.0])], same.schema))
    with pytest.raises(ValueError, match="several lengths"):
        cluster.kmeans_fit(mixed, k=2, n_init=1)


def test_neighbours_of_many_words(spark):
    rng = np.random.RandomState(9)
    x = rng.randn(60, 5)
    x[7], x[8], x[30] = 0, x[9], 2 * x[9]  # a zero vector, and vectors of one direction
    table = spark.createDataFrame([(f"w{i:02d}", v.tolist()) for i, v in enumerate(x)], "word string, vec array<double>").repartition(4)
    asked = spark.createDataFrame([(f"w{i:02d}",) for i in range(50)] + [("w03",), ("none",)], "word string")
    got = {}
    for r in vectors.nearest_of(asked, table, 4, block_bytes=8 * 5 * 11).orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append((r["word"], round(r["similarity"], 9)))
    unit = x / np.where(np.linalg.norm(x, axis=1) > 0, np.linalg.norm(x, axis=1), 1)[:, None]
    for i in range(50):
        near = sorted((-round(float(unit[i] @ unit[j]), 9) + 0.0, f"w{j:02d}") for j in range(60) if j != i)[:4]
        want = [(w, -s) for s, w in near] if i != 7 else None
        assert got.get(f"w{i:02d}") == want
    assert len(got) == 49
    single = vectors.nearest_neighbors(table, "w11", 4).collect()
    assert [r["word"] for r in single] == [w for w, _ in got["w11"]]
    assert vectors.nearest_of(asked.limit(0), table).count() == 0


@pytest.mark.parametrize(("shape", "subspace"), [((80, 12), 256), ((30, 3), 256), ((6, 40), 256), ((9, 1), 256), ((60, 20), 9)])
def test_principal_coordinates_equal_a_dense_decomposition(spark, monkeypatch, shape, subspace):
    monkeypatch.setattr(cluster, "SUBSPACE", subspace)
    rng = np.random.RandomState(sum(shape))
    x = rng.randn(*shape) * np.linspace(3, 1, shape[1]) + 5
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vec array<double>").repartition(3)
    coordinates, ratios, placed = cluster.pca_2d(points, [x.mean(axis=0).tolist(), x[0].tolist()])
    got = np.array([[r["x"], r["y"]] for r in coordinates.orderBy("id").collect()])
    u, s, v = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    k = min(2, shape[1])
    assert np.abs(got[:, :k]) == pytest.approx(np.abs(u[:, :k] * s[:k]), abs=1e-5)
    assert ratios[:k] == pytest.approx((s**2 / (s**2).sum())[:k].tolist())
    assert got.mean(axis=0) == pytest.approx(0, abs=1e-9) and abs(got[:, 0] @ got[:, 1]) < 1e-4
    assert np.array(placed[0]) == pytest.approx(0, abs=1e-9) and placed[1] == pytest.approx(got[0].tolist())


def test_rows_of_a_descent_are_stored_as_blocks(spark, blobs, monkeypatch):
    x, y, classes = blobs
    monkeypatch.setattr(linear, "BLOCK_ENTRIES", 40)
    labels, dense = long_form(spark, x, y)
    sparse = dense.where("idx < 2 or doc_id % 2 = 0")
    packed = linear.pack(labels, [linear.Problem(dense, 5), linear.Problem(sparse, 5)], classes).coalesce(1)
    blocks = linear.pack_blocks(packed, [5, 5]).collect()
    assert sum(len(b["y"]) // 4 for b in blocks) == 2 * len(x)
    assert all(b["dense"] and not b["row"] for b in blocks if b["model"] == 0)
    w, b = np.arange(15.0).reshape(3, 5), np.zeros(3)
    for model, keep in ((0, np.ones(x.shape, bool)), (1, (np.arange(5) < 2) | (np.arange(60) % 2 == 0)[:, None])):
        rows = [linear.Rows.restored(r["dense"], r["y"], r["row"], r["idx"], r["value"], 5) for r in blocks if r["model"] == model]
        p = 1 / (1 + np.exp(-np.clip((x * keep) @ w.T, -250, 250)))
        target = np.array([[c == k for k in classes] for c in y])
        want = (p - target).T @ (x * keep)
        assert sum(r.gradient(w, b, range(3), False)[0] for r in rows) == pytest.approx(want)


@pytest.mark.parametrize("share", [0.0, 0.2, 2.0])
def test_descent_tasks_sum_runs_and_whole_columns(monkeypatch, share):
    monkeypatch.setattr(linear, "COMMON", share)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(30, 9)) * (rng.random((30, 9)) < np.linspace(0.02, 0.9, 9))
    x[[0, 7, 29]], x[:, 4] = 0, 0  # documents and a feature without values
    idx = [np.flatnonzero(r).tolist() for r in x]
    idx[3], values = idx[3] + idx[3][:1], [r[r != 0].tolist() for r in x]
    values[3] = values[3] + [0.5] * len(idx[3][-1:])  # a feature twice in a document
    if idx[3]:
        x[3, idx[3][-1]] += 0.5
    y = rng.integers(0, 3, 30).astype(np.int32)
    batch = pa.RecordBatch.from_arrays([pa.array(y), pa.array(idx, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))], names=["y", "idx", "value"])
    w, b = rng.normal(size=(3, 9)), rng.normal(size=3)
    plain = linear.Rows([batch], 9).gradient(w, b, range(3), True)
    rows = linear.Rows([batch], 9).with_columns()
    p = 1 / (1 + np.exp(-(x @ w.T + b)))
    target = y[:, None] == np.arange(3)
    for got, old, want in zip(rows.gradient(w, b, range(3), True), plain, ((p - target).T @ x, (p - target).sum(axis=0), -np.log(np.where(target, p, 1 - p)).sum(axis=0))):
        assert got == pytest.approx(want) and got == pytest.approx(old)
    assert not hasattr(rows, "row")


def test_skipgram_parts_grow_with_the_corpus(spark, tokens, monkeypatch):
    parts = []
    real = vectors.Word2Vec
    monkeypatch.setattr(vectors, "Word2Vec", lambda **o: parts.append(o["numPartitions"]) or real(**o))
    monkeypatch.setattr(vectors, "PART_TOKENS", 3)
    vectors.skipgram_fit(tokens([(i, "a", "a b c d") for i in range(3)]), dim=2, min_count=1, epochs=1, partitions=2)
    assert parts == [4]


def test_pooling_by_blocks_equals_pooling_at_once(spark, tokens, monkeypatch):
    docs = tokens([(1, "a", "a b b q"), (2, "a", ""), (3, "a", "q r"), (4, "a", "c d e f g a"), (4, "a", "b")])
    given = [(w, [float(i), -1.0, 0.5 * i]) for i, w in enumerate("abcdefg")] + [("a", [2.0, 2.0, 2.0]), (None, [1.0, 1.0, 1.0]), ("r", None)]
    table = spark.createDataFrame(given, "word string, vec array<double>")
    idf = spark.createDataFrame([("a", 2.0), ("b", 0.5)], "term string, idf double")

    def pooled():
        both = vectors.pool_mean(docs, table, 3), vectors.pool_tfidf(docs, table, idf, 3)
        assert "SortMergeJoin" not in "".join(x._jdf.queryExecution().toString() for x in both)
        return [sorted((r["doc_id"], r["n_valid"], *(round(v, 9) for v in r["vec"])) for r in x.collect()) for x in both]

    once = pooled()
    monkeypatch.setattr(vectors, "POOL_BYTES", 200)
    assert pooled() == once


def test_a_vector_subset_looks_up_no_other_vectors(spark, tmp_path, monkeypatch):
    docs = [(1, "en", "Harbor lantern, zebra!"), (2, "de", "lantern violin"), (3, "en", None)]
    spark.createDataFrame(docs, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    held = [(7, "violin harbor"), (8, "nowhere"), (9, "violin")]
    spark.createDataFrame(held, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = [(i, [float(i), 10.0 + i]) for i in range(3)]
    spark.createDataFrame(given, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    stored = []
    for module in (inputs, vector_queries):
        plain = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name="table", plain=plain: stored.append(name) or plain(df, name))
    found = vector_queries.vector_subset(spark, str(tmp_path))
    # harbor, lantern, violin, zebra take the vectors 0, 1, 2, 0.
    assert {tuple(r) for r in found.collect()} == {("harbor", 0, 0.0), ("harbor", 1, 10.0), ("violin", 0, 2.0), ("violin", 1, 12.0)}
    assert "vectors" not in stored
