"""What reaches Python at once."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import common, ngram_join, postings


@pytest.fixture
def unset(spark):
    """A session without a setting for the bytes of a batch."""
    was = spark.conf.get(common.BATCH_SETTING, None)
    spark.conf.unset(common.BATCH_SETTING)
    yield spark
    spark.conf.unset(common.BATCH_SETTING)
    if was is not None:
        spark.conf.set(common.BATCH_SETTING, was)


def sizes(df):
    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [b.nbytes]})

    return df.mapInArrow(size, "n long, bytes long").collect()


def test_long_texts_reach_python_in_small_batches(unset):
    docs = unset.range(0, 120, 1, 1).selectExpr("id as doc_id", "repeat(cast(id % 10 as string), 200000) as text")
    lengths = common.map_rows(docs, lambda rows: ((i, len(t)) for i, t in rows), "doc_id long, n long")
    assert sorted(tuple(r) for r in lengths.collect()) == [(i, 200_000) for i in range(120)]
    found = sizes(docs)
    assert sum(r.n for r in found) == 120 and max(r.bytes for r in found) < 5 << 20


def test_a_set_size_of_batches_stays(unset):
    unset.conf.set(common.BATCH_SETTING, "1m")
    docs = unset.range(0, 20, 1, 1).selectExpr("id as doc_id", "repeat('a', 200000) as text")
    assert common.map_rows(docs, lambda rows: ((len(t),) for _, t in rows), "n long").count() == 20
    assert unset.conf.get(common.BATCH_SETTING) == "1m"


def python_at_once(df):
    """The most Python workers a task of the plan needs at the same time."""
    most, above = 0, []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [x for x in above if x[0] < depth]
        above.append((depth, "Exchange" in line, "EvalPython" in line or "MapInArrow" in line))
        here = 0
        for _, exchange, python in above:
            here = 0 if exchange else here + python
            most = max(most, here)
    return most


def test_keep_one_needs_one_python_worker_a_core(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (1, "x y z"), (1, "x y z"), (1, "other"), (2, "x y z"), (None, None), (3, "")]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert python_at_once(kept) == 1
    found = sorted(((r.doc_id or 0, r.text or "") for r in kept.collect()))
    assert found == [(0, ""), (0, "a b c d e f"), (1, "other"), (1, "x y z"), (3, "")]


def test_workers_of_the_join_do_without_pandas():
    code = "import sys, corpusloom.llm.ngram_join; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(ngram_join.__file__).parents[2]).returncode == 0


def test_a_block_is_not_held_twice():
    parts = [(np.array([3, 1], np.uint64), np.array([7, 8]), np.array([1, 1], np.uint32)), (np.array([1], np.uint64), np.array([5]), np.array([1], np.uint32))]
    keys, owners, marks = postings.gathered(parts)
    assert not parts and keys.tolist() == [1, 1, 3] and owners.tolist() == [5, 8, 7] and marks.tolist() == [1, 1, 1]
