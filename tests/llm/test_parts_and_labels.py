"""Pairs of parts of the cover trees."""

import numpy as np
import pytest

from corpusloom.llm import cover_tree
from corpusloom.plans.lineage import BoundExceeded


def test_pairs_of_parts_form_in_tasks(spark, monkeypatch):
    angles = np.deg2rad([0.0, 40.0, 90.0])
    centres = {2: np.c_[np.cos(angles), np.sin(angles)]}
    tops = [(2, c, s, 0.1 * (c + 1)) for c in range(3) for s in range(2)] + [(5, 0, 0, 2.0)]
    parts = spark.createDataFrame(tops, "size int, cell long, share long, far double")
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, rows, *a, f=type(spark).createDataFrame, **k: f(self, rows, *a, **k) if len(rows) <= 9 else pytest.fail("pairs on the driver"))
    got = cover_tree.part_pairs(parts, centres, 0.2, 7).collect()
    of = {}
    for r in got:
        of.setdefault(r.pair, []).append((r.side, r["size"], r.cell, r.share))
    found = sorted(tuple(x[1:] for x in sorted(v)) for v in of.values())
    want = []
    for n, p in enumerate(tops):
        for q in tops[n:]:
            gap = np.linalg.norm(centres[2][p[1]] - centres[2][q[1]]) if p[0] == 2 else 0.0
            if p[0] == q[0] and gap - p[3] - q[3] <= 0.2 + cover_tree.SLACK:
                want.append((p[:3],) if p == q else (p[:3], q[:3]))
    assert found == sorted(want)
    with pytest.raises(BoundExceeded):
        cover_tree.part_pairs(parts, centres, 0.2, 6)
