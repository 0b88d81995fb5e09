"""Null and repeated ids in the training-data operators."""

from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import cover_tree, multi_index, ngram_join, substring


def numbered(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


@pytest.fixture(scope="module")
def nameless(spark):
    near = numbered("a", 60).split()
    near[30] = "other"
    rows = [
        (None, numbered("a", 60)), (None, " ".join(near)), (None, numbered("a", 60)),
        (None, numbered("b", 60)), (3, numbered("b", 60).upper()),
        (5, numbered("c", 60)), (5, numbered("c", 60)), (5, numbered("b", 60)), (6, numbered("c", 60)),
        (None, ""), (7, None), (7, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_join_of_rows_without_an_id(nameless):
    got = Counter(tuple(r) for r in ngram_join.near_duplicates(nameless).collect())
    assert got == Counter({(None, 56, None): 3, (None, 56, 3): 1, (3, 56, 3): 1, (5, 56, 5): 2, (5, 56, 3): 1, (6, 56, 5): 1, (None, 0, None): 1, (7, 0, 7): 2})


def test_one_row_of_each_class_stays(nameless):
    kept = ngram_join.keep_one(nameless)
    got = Counter((r.doc_id, (r.text or "")[:2].lower()) for r in kept.collect())
    assert got == Counter({(None, "a0"): 1, (3, "b0"): 1, (5, "c0"): 1, (None, ""): 1, (7, ""): 2})


def test_links_between_sets_without_an_id(spark):
    base = numbered("x", 60).split()
    one, two = list(base), list(base)
    one[30], two[10] = "p", "q"
    docs = spark.createDataFrame([(None, " ".join(w)) for w in (base, one, two)] + [(1, numbered("y", 60))], "doc_id long, text string")
    assert ngram_join.keep_one(docs).count() == 2


def test_passages_shared_with_rows_without_an_id(spark):
    passage = numbered("p", 50)
    rows = [(None, f"{numbered('u', 5)} {passage}"), (None, f"{numbered('v', 7)} {passage}"), (2, f"{passage} {numbered('z', 9)}")]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.n_words, r.n_removed) for r in got) == [(55, 50), (57, 50), (59, 50)]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(60, 8)).astype(float)
    rows = [(i, v[i].tolist()) for i in range(60)]
    rows += [(0, v[7].tolist()), (0, v[7].tolist()), (3, (v[3] + 0.01).tolist()), (3, v[3].tolist()), (90, v[3].tolist())]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


def test_neighbours_of_repeated_ids(vectors):
    rows, df = vectors
    once = sorted({(i, tuple(v)) for i, v in rows})
    got = multi_index.neighbours(df, df.where("vec_id in (0, 3, 8)"), k=5)
    for q in (0, 3, 8):
        far = sorted((float(np.linalg.norm(np.subtract(a, b))), j) for i, a in once if i == q for j, b in once if j != q)
        found = [(r.rank, r.vec_id, round(r.score, 9)) for r in got.where(f"query_id = {q}").orderBy("rank").collect()]
        assert found == [(n + 1, j, round(d, 9)) for n, (d, j) in enumerate(far[:5])]


def test_links_of_repeated_ids(vectors):
    rows, df = vectors
    once = sorted({(i, tuple(v)) for i, v in rows})
    unit = np.array([v for _, v in once])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.9 - 1e-12
    reach = np.linalg.matrix_power(near.astype(float), 64) > 0
    want = {(i, v): (int(near[n].sum()) - 1, min(once[m][0] for m in np.flatnonzero(reach[n]))) for n, (i, v) in enumerate(once)}
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in cover_tree.near_duplicates(df).collect())
    assert got == Counter((i, *want[i, tuple(v)]) for i, v in rows)
