"""Embedding near-duplicates by dual traversal of cover trees.

Vectors are scaled to unit length, where a cosine threshold is a distance. Equal vectors are one point
with a weight. Points are dealt to the nearest of a bounded number of centres, large cells in several
parts; the parts are the top of the trees. Pairs of parts too far apart for their covering radii are
pruned. Each part's cover tree, nested levels with halving radii, is built once and stored. For each pair that is left,
a task traverses both trees together: node pairs too far apart for their covering radii are pruned, those that
are close throughout are taken as a whole, the rest are opened. Points that are left
face to face near the threshold are compared by their exact cosine in double precision.

Tasks return sums of links by point and the edges of a spanning forest, never all pairs. Vectors
without any structure leave all pairs of parts to compare; then the work is quadratic, in blocks.
Vectors that are null, zero or hold null or non-finite components link with nothing, nor do vectors of
different lengths. Rows that repeat an id are copies of it: they count as one vector if equal. Empty
tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import components
from corpusloom.llm.multi_index import usable
from corpusloom.plans.lineage import BoundExceeded, materialize

#: Points of a part on average, and the most centres.
PART, CENTRES = 6_000, 64
#: Points below which a node isn't divided further, nodes of either side measured at once, centres measured at once.
LEAF, ROWS, CENTRES_AT_ONCE = 24, 512, 64
#: Distances this close to a bound are left to the exact comparison, and products in single precision this close to theirs.
SLACK, ROUGH = 1e-7, 1e-4


class CoverTree:
    """Nested levels of centres with halving radii over unit vectors; a node knows its points and children."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.members: list[np.ndarray] = []
        self.children: list[np.ndarray] = []
        if len(x):
            self.grow(0, np.arange(len(x)), apart(x, x[:1])[:, 0])
        self.over(x)

    def over(self, x: np.ndarray) -> CoverTree:
        """The tree with its points, which it is stored without."""
        self.x = x
        self.at = x[self.centre]
        self.rough = self.at.astype(np.float32)
        self.reach = np.array(self.radius)
        self.leaf = np.array([len(k) == 0 for k in self.children], bool)
        return self

    def __getstate__(self) -> tuple:
        lists = [(np.cumsum([len(k) for k in x])[:-1], np.concatenate(x) if x else np.empty(0, np.int64)) for x in (self.members, self.children)]
        return np.array(self.centre), np.array(self.radius), [(ends.astype(np.int32), x.astype(np.int32)) for ends, x in lists]

    def __setstate__(self, state: tuple) -> None:
        centre, radius, lists = state
        self.centre, self.radius = centre.tolist(), radius.tolist()
        self.members, self.children = (np.split(x, ends) if len(centre) else [] for ends, x in lists)

    def grow(self, centre: int, members: np.ndarray, far: np.ndarray) -> int:
        """Add the node of ``members`` around a centre; ``far`` are their distances from it."""
        node = len(self.centre)
        self.centre.append(centre)
        self.radius.append(float(far.max()))
        self.members.append(members)
        self.children.append(np.empty(0, np.int64))
        if len(members) > LEAF and self.radius[node] > SLACK:
            half, inside = self.radius[node] / 2, far <= self.radius[node] / 2
            kids = [self.grow(centre, members[inside], far[inside])]
            left = members[~inside]
            while len(left):
                # The next centres' distances are measured together; those that an earlier one covers aren't centres.
                d = apart(self.x[left[:CENTRES_AT_ONCE]], self.x[left])
                close, taken = d <= half, np.zeros(len(left), bool)
                for i, row in enumerate(close):
                    if not taken[i]:
                        row[i] = True
                        inside = np.flatnonzero(row > taken)
                        taken[inside] = True
                        kids.append(self.grow(int(left[i]), left[inside], d[i, inside]))
                left = left[~taken]
            # Nodes of like radius stand together, so that one bound serves many.
            self.children[node] = np.array(sorted(kids, key=lambda k: -self.radius[k]))
        return node


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one."""
    return v / np.sqrt((v**2).sum(1))[:, None]


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def near_nodes(s: CoverTree, p: np.ndarray, t: CoverTree, b: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of nodes ``p[i]``, ``b[j]`` whose points may be within ``eps``, judged by centres and radii.

    Products in single precision discard what the largest radii rule out; what is left is measured in double precision.
    """
    most = eps + SLACK + float(s.reach[p].max()) + float(t.reach[b].max())
    maybe = s.rough[p] @ t.rough[b].T >= np.float32(1 - most * most / 2 - ROUGH) if most < 2 else np.ones((len(p), len(b)), bool)
    i, j = np.divmod(np.flatnonzero(maybe), len(b))
    if 32 * len(i) > maybe.size:
        d = apart(s.at[p], t.at[b])[i, j]
    else:
        d = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", s.at[p[i]], t.at[b[j]]), 0))
    if s is t:
        d[p[i] == b[j]] = 0.0
    near = d - (s.reach[p[i]] + t.reach[b[j]]) <= eps + SLACK
    return i[near], j[near], d[near]


def traverse(s: CoverTree, t: CoverTree, eps: float) -> Iterator[tuple[bool, int, int]]:
    """Node pairs of two trees, or of one with itself, that remain: (wholly within ``eps``, node of s, node of t).

    Pairs that aren't wholly within are leaves. A node paired with itself stands for the pairs inside it.
    """
    same = s is t
    todo = [(np.zeros(1, np.int64), np.zeros(1, np.int64), same)] if len(s.x) and len(t.x) else []
    while todo:
        a, b, triangle = todo.pop()
        tiles = [(x, y) for x in range(0, len(a), ROWS) for y in range(0, len(b), ROWS) if not triangle or x <= y]
        for x, y in tiles:
            p, q = a[x : x + ROWS], b[y : y + ROWS]
            i, j, d = near_nodes(s, p, t, q, eps)
            if triangle:
                once = x + i <= y + j
                i, j, d = i[once], j[once], d[once]
            u, v = p[i], q[j]
            whole = d + s.reach[u] + t.reach[v] <= eps - SLACK
            ends = whole | (s.leaf[u] & t.leaf[v])
            yield from zip(whole[ends].tolist(), u[ends].tolist(), v[ends].tolist())
            u, v = u[~ends], v[~ends]
            if same:
                todo += [(s.children[k], s.children[k], True) for k in u[u == v].tolist()]
                u, v = u[u != v], v[u != v]
            # All that a node is opened for meets its children together.
            theirs = s.leaf[u] | (~t.leaf[v] & (t.reach[v] > s.reach[u]))
            todo += [(s.children[k], v[~theirs & (u == k)], False) for k in np.unique(u[~theirs]).tolist()]
            todo += [(u[theirs & (v == k)], t.children[k], False) for k in np.unique(v[theirs]).tolist()]


def link(ours: dict, theirs: dict | None, cosine: float) -> tuple[list, list]:
    """Links of points within one part, or between two: sums (point, n) and forest edges (a, b).

    A part is a dict of ``ids``, ``weight``, the given vectors ``v`` and their ``tree``.
    """
    sides = [ours] if theirs is None else [ours, theirs]
    norms = [np.sqrt((x["v"] ** 2).sum(1)) for x in sides]
    trees = [x["tree"] for x in sides]
    counts = [np.zeros(len(x["v"]), np.int64) for x in sides]
    first, last = 0, len(sides) - 1
    root: dict[int, int] = {}
    edges: list[tuple[int, int]] = []

    def find(i: int) -> int:
        while root.setdefault(i, i) != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(i: int, j: int) -> None:
        p, q = find(i), find(j)
        if p != q:
            root[max(p, q)] = min(p, q)
            edges.append((i, j))

    x, y = sides[first], sides[last]
    for whole, a, b in traverse(trees[first], trees[last], float(np.sqrt(max(0.0, 2 - 2 * cosine)))):
        p, q = trees[first].members[a], trees[last].members[b]
        own = theirs is None and a == b
        if whole:
            counts[first][p] += y["weight"][q].sum() - (x["weight"][p] if own else 0)
            if not own:
                counts[last][q] += x["weight"][p].sum()
            centre = int(x["ids"][p[0]])
            for i in [*x["ids"][p[1:]].tolist(), *y["ids"][q].tolist()]:
                join(centre, i)
            continue
        close = (x["v"][p] @ y["v"][q].T) / (norms[first][p][:, None] * norms[last][q][None, :])
        for i, j in np.argwhere(np.abs(close - cosine) < 1e-12):
            close[i, j] = float(np.dot(x["v"][p[i]], y["v"][q[j]]) / (norms[first][p[i]] * norms[last][q[j]]))
        near = close >= cosine
        if own:
            np.fill_diagonal(near, False)
        if near.any():
            counts[first][p] += near @ y["weight"][q]
            if not own:
                counts[last][q] += near.T @ x["weight"][p]
            for i, j in np.argwhere(near):
                join(int(x["ids"][p[i]]), int(y["ids"][q[j]]))
    sums = [(int(i), int(n)) for x, c in zip(sides, counts) for i, n in zip(x["ids"], c) if n]
    return sums, edges


def parted(points: DataFrame) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """``points`` with the part of each: (size, nearest centre, share of a large cell), stored; and the centres by size.

    Centres are a bounded sample, sent to the tasks.
    """
    n = points.count()
    k = int(min(CENTRES, max(1, n // PART)))
    rows = points.orderBy(F.xxhash64("point", F.lit(11)), "point").limit(k).select("v").collect()
    centres: dict[int, np.ndarray] = {}
    for size in {len(r.v) for r in rows}:
        c = np.array([r.v for r in rows if len(r.v) == size], float)
        centres[size] = c / np.linalg.norm(c, axis=1)[:, None]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cells, far = np.zeros(len(b), np.int64), np.full(len(b), 2.0)
            for size, index in b.groupby(b["v"].map(len)).indices.items():
                if size in centres:
                    v = np.array(b["v"].iloc[index].tolist(), float)
                    d = apart(v / np.linalg.norm(v, axis=1)[:, None], centres[size])
                    cells[index], far[index] = d.argmin(1), d.min(1)
            yield b.assign(cell=cells, far=far)

    given = points.select("point", "weight", "v")
    cells = given.mapInPandas(run, "point long, weight long, v array<double>, cell long, far double").withColumn("size", F.size("v"))
    cells = materialize(cells, "cells")
    shares = cells.groupBy("size", "cell").agg(F.ceil(F.count("*") / PART).alias("shares"))
    share = F.pmod(F.xxhash64("point"), F.col("shares"))
    return materialize(cells.join(shares, ["size", "cell"]).withColumn("share", share).drop("shares"), "parts"), centres


def part_pairs(parts: DataFrame, centres: dict[int, np.ndarray], eps: float, max_parts: int) -> DataFrame:
    """(size, cell, share, pair, side) of the parts that may hold vectors at ``eps``; a part with itself has one row.

    The pairs are formed in tasks, each from some parts and all of them, which are at most ``max_parts``.
    """
    spark = parts.sparkSession
    tops = materialize(parts.groupBy("size", "cell", "share").agg(F.max("far").alias("far")), "tops")
    n = tops.count()
    if n > max_parts:
        raise BoundExceeded(f"parts: more than {max_parts} rows")
    gaps = [(size, i, j, float(d)) for size, c in centres.items() for i, row in enumerate(apart(c, c)) for j, d in enumerate(row)]
    gaps = spark.createDataFrame(gaps, "size int, cell long, cell2 long, gap double")
    ours = tops.repartition(max(1, min(n, 200)), "cell", "share").join(F.broadcast(gaps), ["size", "cell"], "left")
    theirs = tops.select(F.col("size").alias("size2"), F.col("cell").alias("to"), F.col("share").alias("share2"), F.col("far").alias("far2"))
    same_kind = (F.col("size") == F.col("size2")) & (F.coalesce("cell2", "to") == F.col("to"))
    once = (F.col("cell") < F.col("to")) | ((F.col("cell") == F.col("to")) & (F.col("share") <= F.col("share2")))
    reach = F.coalesce("gap", F.lit(0.0)) - F.col("far") - F.col("far2") <= eps + SLACK
    met = ours.join(F.broadcast(theirs), same_kind & once & reach)
    met = materialize(met.select("size", "cell", "share", "to", "share2", F.monotonically_increasing_id().alias("pair")), "pairs")
    first = met.select("size", "cell", "share", "pair", F.lit(0).alias("side"))
    other = met.where("cell != to or share != share2").select("size", F.col("to").alias("cell"), F.col("share2").alias("share"), "pair", F.lit(1).alias("side"))
    return first.union(other)


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, max_parts: int = 100_000) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors(vec_id, embedding)``."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", F.when(usable(v), v).alias("v"))
    used = rows.where(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    points = used.groupBy("v").agg(F.min("vec_id").alias("least"), F.count_distinct("vec_id").alias("weight"))
    # Ids may repeat, so points are named by their vectors.
    points = materialize(points.withColumn("point", F.xxhash64("v", "least")), "points")
    parts, centres = parted(points)
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    place = {c: parts.schema[c].dataType for c in ("size", "cell", "share")}

    def grown(part: pd.DataFrame) -> pd.DataFrame:
        v = np.array(part["v"].tolist(), float)
        side = {"ids": part["point"].to_numpy(), "weight": part["weight"].to_numpy(), "v": v, "tree": CoverTree(unit(v))}
        return part[[*place]].head(1).assign(part=pickle.dumps(side))

    # A part's tree is built once, whatever the number of its pairs.
    kinds = ", ".join(f"{c} {k.simpleString()}" for c, k in place.items())
    trees = materialize(parts.groupBy(*place).applyInPandas(grown, f"{kinds}, part binary"), "trees")
    met = trees.join(part_pairs(parts, centres, eps, max_parts), [*place]).select("pair", "side", "part")

    def run(pair: pd.DataFrame) -> pd.DataFrame:
        sides = [pickle.loads(x) for x in pair.sort_values("side")["part"]]
        for x in sides:
            x["tree"].over(unit(x["v"]))
        sums, edges = link(sides[0], sides[1] if len(sides) > 1 else None, cosine)
        out = pd.DataFrame([(i, None, n) for i, n in sums] + [(a, b, None) for a, b in edges], columns=["a", "b", "n"], dtype=object)
        return out.astype({"a": "Int64", "b": "Int64", "n": "Int64"})

    found = materialize(met.groupBy("pair").applyInPandas(run, "a long, b long, n long"), "links")
    links = found.where("b is null").groupBy(F.col("a").alias("point")).agg(F.sum("n").alias("n"))
    label = components(found.where("b is not null").select("a", "b"))
    named = points.join(links, "point", "left").join(label, F.col("point") == F.col("node"), "left")
    # A point's own copies are linked, too.
    named = named.select("v", "least", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "point").alias("component"))
    lowest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "component").select("v", "n_links", "component_id")
    linked = used.join(named, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("v").isNull() | F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
