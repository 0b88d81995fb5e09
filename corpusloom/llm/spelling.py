"""Spelling variants by dynamic programming over a sorted vocabulary.

Two words are near if one inserted, deleted or replaced code point turns one into the other. The
vocabulary is sorted; a word is compared with it by the rows of the edit matrix, of which only the
band of three cells around the diagonal can stay at one edit. Adjacent words share the rows of their
longest common prefix, so a row is computed once for each run of words with a common prefix, and a
run whose row has no cell of at most one edit is skipped as a whole. All words of a block take these
steps together, one code point deeper at a time.

The longer word of a near pair has either an equal first half in both words, or the edit lies in that
half and the rest is equal. So the scan starts behind the exact first half, and runs twice: over the
sorted words and over the sorted reversed words; the common prefix of a pair says which run reports
it. The sorted list is cut into shards of consecutive words. A word meets its own shard, and the
others that hold its first half, unless what all words of a shard share already exceeds one edit.

A word's form is its near word with the largest count (ties: smallest in code-point order) if that is
at least ten times its own; the root follows forms to the last. Counts grow tenfold with each
step, so a chain has at most eighteen. Only counts and best partners leave a task, never pairs.

Null and empty texts have no words. Repeated rows count again; a null id is an empty string in the
hash. Empty tables and tables without a word give no rows. Further columns are ignored. A word of any
length is compared whole.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows
from corpusloom.plans.lineage import bounded_rows, materialize

RUN = re.compile("[a-zÀ-ÿ]+")
#: Distinct words that a task counts before it hands its partial counts on.
FLUSH = 300_000
#: Words of a shard of the sorted list, on average.
SHARD_WORDS = 20_000
#: Shards whose first and last words the driver may hold.
MAX_SHARDS = 500_000
#: Words that scan a shard together.
BLOCK = 4_096
#: A form is at least so many times as frequent as its variant.
FREQUENT = 10
FAR = np.int8(2)


def without_one(run: str, h: int) -> str:
    """A run without the code point that its hash names."""
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def word_counts(docs: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """(word, n) of all words of ``docs(doc_id, text)`` that are long and frequent enough."""

    def count(rows: Iterable[tuple]) -> Iterator[tuple]:
        total: Counter[str] = Counter()
        for doc_id, text in rows:
            if not text:
                continue
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            # bytes.lower() changes A-Z only
            for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
                h = zlib.crc32(run.encode(), start)
                word = run if h % 31 else without_one(run, h)
                if len(word) >= least_length:
                    total[word] += n
            if len(total) >= FLUSH:
                yield from total.items()
                total.clear()
        yield from total.items()

    partial = map_rows(docs.select("doc_id", "text"), count, "word string, n long", batch=20_000)
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class SortedWords:
    """A sorted list of distinct Latin-1 words with the common prefixes of neighbours."""

    def __init__(self, words: list[bytes]) -> None:
        self.words = words
        self.length = np.array([len(w) for w in words], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.codes = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        self.lcp = self._common()
        self._runs: dict[int, np.ndarray] = {}

    def _common(self) -> np.ndarray:
        """Length of each word's common prefix with the word before it; -1 for the first."""
        lcp = np.zeros(len(self.words), np.int64)
        open_ = np.arange(1, len(self.words))
        d = 0
        while len(open_):
            open_ = open_[(self.length[open_] > d) & (self.length[open_ - 1] > d)]
            open_ = open_[self.codes[self.start[open_] + d] == self.codes[self.start[open_ - 1] + d]]
            d += 1
            lcp[open_] = d
        if len(lcp):
            lcp[0] = -1
        return lcp

    def runs(self, depth: int) -> np.ndarray:
        """Where the runs of words begin that share ``depth + 1`` code points."""
        if depth not in self._runs:
            self._runs[depth] = np.flatnonzero((self.length > depth) & (self.lcp <= depth))
        return self._runs[depth]

    def with_prefix(self, word: bytes, n: int) -> tuple[int, int]:
        """The words that share the first ``n`` code points of ``word``."""
        prefix = word[:n]
        low = bisect_left(self.words, prefix)
        return low, bisect_right(self.words, prefix, low, key=lambda w: w[:n])

    def near(self, queries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, word number) at one edit or none, with equal first half of the query."""
        length = np.array([len(q) for q in queries], np.int64)
        start = np.concatenate([[0], np.cumsum(length)])[:-1]
        codes = np.frombuffer(b"".join(queries) + b"\0", np.uint8)
        half = length // 2
        ranges = np.array([self.with_prefix(q, n) for q, n in zip(queries, half.tolist())], np.int64).reshape(-1, 2)
        found_q, found_w = [], []

        def code(q: np.ndarray, j: int) -> np.ndarray:
            """Code point ``j`` of the queries; beyond their ends one that no word has."""
            inside = (j >= 0) & (j < length[q])
            return np.where(inside, codes[np.where(inside, start[q] + j, 0)], 0)

        none = np.empty(0, np.int64)
        q, low, high, band = none, none, none, np.empty((3, 0), np.int8)
        depth = int(half.min(initial=0))
        while len(q) or depth <= half.max(initial=-1):
            new = np.flatnonzero((half == depth) & (ranges[:, 0] < ranges[:, 1]))
            if len(new):
                q = np.concatenate([q, new])
                low, high = np.concatenate([low, ranges[new, 0]]), np.concatenate([high, ranges[new, 1]])
                band = np.concatenate([band, np.tile(np.array([[1], [0], [1]], np.int8), (1, len(new)))], axis=1)
            # The word that ends here is the first of its run.
            over = length[q] - depth
            ends = np.flatnonzero((self.length[low] == depth) & (np.abs(over) <= 1))
            ends = ends[band[over[ends] + 1, ends] <= 1]
            found_q.append(q[ends])
            found_w.append(low[ends])
            # One code point deeper: each run falls into runs with one more common code point.
            begins = self.runs(depth)
            first, last = np.searchsorted(begins, low), np.searchsorted(begins, high)
            many = last - first
            parent = np.repeat(np.arange(len(q)), many)
            child = np.arange(len(parent)) - np.repeat(np.cumsum(many) - many, many) + first[parent]
            following = np.append(begins, len(self.words))[child + 1]
            low_, high_ = begins[child], np.where(child + 1 < last[parent], following, high[parent])
            c, own, before = self.codes[self.start[low_] + depth], q[parent], band[:, parent]
            n0 = np.minimum(before[0] + (c != code(own, depth - 1)), before[1] + 1)
            n1 = np.minimum(np.minimum(before[1] + (c != code(own, depth)), before[2] + 1), n0 + 1)
            n2 = np.minimum(before[2] + (c != code(own, depth + 1)), n1 + 1)
            rows = np.minimum(np.stack([n0, n1, n2]), FAR).astype(np.int8)
            left = length[own] - depth  # cells beyond the query's end don't count
            rows[1][left < 1] = FAR
            rows[2][left < 2] = FAR
            rows[0][left < 0] = FAR
            kept = rows.min(axis=0) <= 1
            q, low, high, band = own[kept], low_[kept], high_[kept], rows[:, kept]
            depth += 1
        return np.concatenate([none, *found_q]), np.concatenate([none, *found_w])


def within_one(shared: bytes, word: bytes, exact: int) -> bool:
    """Whether ``shared`` is at most one edit from a beginning of ``word``, with ``exact`` code points equal."""
    n = min(len(shared), len(word))
    i = exact
    while i < n and shared[i] == word[i]:
        i += 1
    rest = shared[i:]
    return not rest or any(word[j : j + len(r)] == r[: max(0, len(word) - j)] for j, r in ((i + 1, rest[1:]), (i + 1, rest), (i, rest[1:])))


def _near_one_way(vocabulary: DataFrame, backwards: bool) -> DataFrame:
    """(word, n_near, form, form_n) of the pairs that the forward or the backward list reports."""
    spark = vocabulary.sparkSession
    key = F.reverse("word") if backwards else F.col("word")
    size = vocabulary.count()
    shards = max(1, -(-size // SHARD_WORDS))
    placed = vocabulary.select(key.alias("key"), "n").repartitionByRange(shards, "key").sortWithinPartitions("key")
    placed = materialize(placed.withColumn("shard", F.spark_partition_id()), "sorted-words")
    ends = placed.groupBy("shard").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    bounds = [(r["shard"], r["low"].encode("latin-1"), r["high"].encode("latin-1")) for r in bounded_rows(ends.orderBy("low"), MAX_SHARDS, "shards of the sorted vocabulary")]
    shared = []
    for _, low, high in bounds:
        n = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        shared.append(low[:n])
    table = spark.sparkContext.broadcast((bounds, shared))

    def elsewhere(rows: Iterable[tuple]) -> Iterator[tuple]:
        bounds, shared = table.value
        highs = [b[2] for b in bounds]
        for key, n, own in rows:
            word = key.encode("latin-1")
            half = len(word) // 2
            prefix = word[:half]
            i = bisect_left(highs, prefix)
            while i < len(bounds) and bounds[i][1][:half] <= prefix:
                if bounds[i][0] != own and within_one(shared[i], word, half):
                    yield key, n, bounds[i][0], 1
                i += 1

    visits = map_rows(placed, elsewhere, "key string, n long, shard int, kind int")
    both = placed.withColumn("kind", F.lit(0)).select("key", "n", "shard", "kind").unionByName(visits)
    both = both.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "key")

    def scan(rows: Iterable[tuple]) -> Iterator[tuple]:
        words: list[bytes] = []
        counts: list[int] = []
        block: list[tuple[bytes, int]] = []
        here, tree = None, None

        def partners() -> Iterator[tuple]:
            queries = [b for b, _ in block]
            best: dict[int, list] = {}
            for i, j in zip(*(x.tolist() for x in tree.near(queries))):
                a, b = queries[i], words[j]
                half = max(len(a), len(b)) // 2
                if a == b or (a[len(a) - half :] == b[len(b) - half :] if backwards else a[:half] != b[:half]):
                    continue
                found = (-counts[j], b[::-1] if backwards else b)
                mine = best.get(i)
                if mine is None:
                    best[i] = [1, found]
                else:
                    mine[0] += 1
                    mine[1] = min(mine[1], found)
            for i, (many, (n, form)) in best.items():
                word = queries[i][::-1] if backwards else queries[i]
                yield word.decode("latin-1"), many, form.decode("latin-1"), -n
            block.clear()

        def own() -> Iterator[tuple]:
            nonlocal tree
            if tree is None:
                tree = SortedWords(words)
                for i in range(0, len(words), BLOCK):
                    block.extend(zip(words[i : i + BLOCK], counts[i : i + BLOCK]))
                    yield from partners()

        for key, n, shard, kind in rows:
            if shard != here:
                if here is not None:
                    yield from own()
                    if block:
                        yield from partners()
                here, tree, words, counts = shard, None, [], []
            if kind == 0:
                words.append(key.encode("latin-1"))
                counts.append(n)
            else:
                yield from own()
                block.append((key.encode("latin-1"), n))
                if len(block) >= BLOCK:
                    yield from partners()
        if here is not None:
            yield from own()
            if block:
                yield from partners()

    found = materialize(map_rows(both, scan, "word string, n_near long, form string, form_n long"), "near-words")
    table.destroy()
    return found


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of all words of ``vocabulary(word, n)`` that have a near word.

    ``best`` is the near word with the largest count, the smallest of equals. Words are distinct and of
    code points up to U+00FF.
    """
    parts = _near_one_way(vocabulary, False).unionByName(_near_one_way(vocabulary, True))
    return parts.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("top")
    ).select("word", "n_near", F.col("top.form").alias("best"), (-F.col("top.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: the last form of each word's chain.

    Each round replaces a root by its own root so far, so the steps taken double.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        after = materialize(after, "roots")
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs(doc_id, text)``."""
    vocabulary = materialize(word_counts(docs), "vocabulary")
    near = vocabulary.join(near_words(vocabulary), "word", "left")
    enough = F.col("best_n") >= FREQUENT * F.col("n")
    near = materialize(
        near.select(
            "word",
            F.when(enough, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best_n")).alias("form_n"),
        ),
        "near",
    )
    last = roots(near.where("form is not null").select("word", "form"))
    return near.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
