"""Toxicity by maximum-scoring segments of token log-odds.

Each token gets the log-odds ratio of its use in toxic and other labelled documents, under a
Dirichlet prior made of the pooled counts (informative prior, variance by the usual
approximation). Its use is the number of documents that hold it, so that one document that
repeats a word has no more say than another. A word without a significant ratio of its own
takes that of its first five or four letters, which cover inflected and compound forms; words
without any count as neutral. A linear-time scan finds
all maximal scoring segments of a text. Their scores follow an extreme-value law in harmless
texts; its parameters turn each score into a normalised one, comparable over text lengths. The
document's evidence is the sum over its significant segments; a logistic curve fitted on the
labelled rows maps it to 0..1.

Labels come from a bounded sample of ``max_labels`` rows (smallest hashes of the id) and the
table of weights holds at most ``max_tokens`` tokens, the most significant ones; scoring covers
every whole text. A null or empty text has no segment and gets the score of no evidence. A
document labelled both ways counts as toxic; null labels are ignored; without labels of both
kinds every score is 0. Repeated rows are scored alike; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import gram_hashes, map_rows, mixed, words
from corpusloom.plans.lineage import bounded_rows, materialize

TOKEN = re.compile(r"[^\W_]+")
EULER = 0.5772156649015329
#: Lengths of the beginnings of words that back off for unknown words, longest first.
STEMS = (5, 4)
#: Distinct tokens that a task counts before it hands its partial counts on.
FLUSH = 200_000


@dataclass
class ToxicityModel:
    """Token scores, the score of any other token, extreme-value parameters and the final curve."""

    scores: dict[str, float]
    neutral: float
    decay: float
    log_k: float
    curve: tuple[float, float]

    def segments(self, text: str) -> list[tuple[float, int, int, float]]:
        """Significant segments: (raw score, first character, end, normalised score)."""
        hits, n = token_scores(self.scores, self.neutral, text)
        base = self.log_k + math.log(max(n, 1))
        found = [(s, a, b, self.decay * s - base) for s, a, b in maximal_segments(hits)]
        return [x for x in found if x[3] > 0]

    def score(self, evidence: float) -> float:
        a, b = self.curve
        x = a + b * evidence
        return 0.0 if x < -500 else 1 / (1 + math.exp(-x)) if x < 500 else 1.0


def token_scores(scores: dict[str, float], neutral: float, text: str) -> tuple[list[tuple[float, int, int]], int]:
    """Scored stretches of a text, runs of neutral tokens merged, as (score, start, end); and its number of tokens."""
    out: list[tuple[float, int, int]] = []
    n, quiet = 0, 0
    low = text.lower()
    if len(low) != len(text):  # a few letters get longer; positions must hold
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for m in TOKEN.finditer(low):
        n += 1
        word = m[0]
        s = scores.get(word)
        for k in STEMS:
            if s is None and len(word) > k:
                s = scores.get(f"{word[:k]}-")
        if s is None:
            quiet += 1
            continue
        if quiet:
            out.append((neutral * quiet, m.start(), m.start()))
            quiet = 0
        out.append((s, m.start(), m.end()))
    return out, n


def maximal_segments(scored: Iterable[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments, in linear time.

    Candidates are kept with the cumulative scores left of them and at their end. A new
    positive score joins back as far as an earlier candidate starts lower and ends lower.
    """
    total = 0.0
    left: list[float] = []
    right: list[float] = []
    spans: list[tuple[int, int]] = []
    lower: list[int] = []  # nearest candidate to the left that starts from a smaller cumulative score
    for s, a, b in scored:
        if s <= 0:
            total += s
            continue
        l, r, start = total, total + s, a
        total = r
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= l:
                j = lower[j]
            if j < 0 or right[j] >= r:
                left.append(l)
                right.append(r)
                spans.append((start, b))
                lower.append(j)
                break
            l, start = left[j], spans[j][0]
            del left[j:], right[j:], spans[j:], lower[j:]
    return [(r - l, a, b) for l, r, (a, b) in zip(left, right, spans)]


def count_tokens(labelled: DataFrame) -> DataFrame:
    """(token, toxic, clean): documents that hold a token or stem, of (text, toxic) rows, summed in each task before the shuffle."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in rows:
            held = set(TOKEN.findall((text or "").lower()))
            seen[toxic].update(held)
            for k in STEMS:
                seen[toxic].update({f"{w[:k]}-" for w in held if len(w) > k})
            if len(seen[0]) + len(seen[1]) > FLUSH:
                yield from flushed(seen)
        yield from flushed(seen)

    def flushed(seen):
        for toxic, counts in enumerate(seen):
            for token, n in counts.items():
                yield (token, n, 0) if toxic else (token, 0, n)
            counts.clear()

    parts = map_rows(labelled.select("text", "toxic"), run, "token string, toxic long, clean long", batch=20_000)
    return parts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_odds(counts: DataFrame, prior: float, least: int, z: float, max_tokens: int) -> dict[str, float]:
    """Significant log-odds ratios by token, under a Dirichlet prior of total weight ``prior``."""
    both = F.col("toxic") + F.col("clean")
    t, c = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not t or not c:
        return {}
    a = F.lit(0.5) + F.lit(prior) * both / (t + c)
    up, down = F.col("toxic") + a, F.col("clean") + a
    delta = F.log(up / (t + prior - up)) - F.log(down / (c + prior - down))
    sigma = F.sqrt(1 / up + 1 / down)
    rated = counts.where(both >= least).select("token", delta.alias("d"), (delta / sigma).alias("z"))
    best = rated.where(F.abs("z") >= z).orderBy(F.abs("z").desc(), "token").limit(max_tokens)
    return {r.token: r.d for r in best.collect()}


def apart(labelled: DataFrame) -> DataFrame:
    """One of each set of (doc_id, text, toxic) rows of a label whose texts share their smallest five-word hash.

    Copies of a document, near ones too, mostly share it; they would make all of its words
    look like marks of its label.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, toxic, text in rows:
            hashes = np.fromiter(map(zlib.crc32, words(text)), np.uint64)
            grams = gram_hashes(mixed(hashes), min(5, max(1, len(hashes))))
            yield doc_id, toxic, int(grams.min().astype(np.int64)) if len(grams) else 0

    least = map_rows(labelled.select("doc_id", "toxic", "text"), run, "doc_id long, toxic int, least long")
    return least.groupBy("least", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: F.Column,
    max_labels: int = 100_000,
    max_tokens: int = 20_000,
    prior: float = 1000.0,
    least: int = 5,
    z: float = 3.0,
    drift: float = 1.0,
) -> ToxicityModel:
    """Learn from ``labels(doc_id, toxic)`` of the rows for which ``learn`` (on ``doc_id``) holds.

    ``drift`` is taken off every token's score, so that harmless text scores below zero.
    """
    marks = labels.where(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.where(F.col("toxic").isin(0, 1)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    marks = materialize(marks, "labels")  # at most max_labels rows
    one = apart(docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id"))
    marks = materialize(marks.join(one, "doc_id"), "labels")
    labelled = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    counts = materialize(count_tokens(labelled), "tokens")
    odds = log_odds(counts, prior, least, z, max_tokens)
    scores = {w: d - drift for w, d in odds.items()}
    model = ToxicityModel(scores, -drift, 1.0, 0.0, (-800.0, 0.0))
    if not any(s > 0 for s in scores.values()):
        return model
    model.decay = decay_rate(counts, scores, -drift)

    def best(rows: Iterable[tuple]) -> Iterator[tuple]:
        for toxic, text in rows:
            hits, n = token_scores(scores, -drift, text or "")
            top = max((s for s, _, _ in maximal_segments(hits)), default=0.0)
            yield toxic, model.decay * top - math.log(max(n, 1)), n

    rated = map_rows(labelled.select("toxic", "text"), best, "toxic int, top double, n long")
    rated = materialize(rated, "rated")
    # The mean of an extreme-value law lies Euler's constant above its location.
    mean = rated.where("toxic = 0 and n > 0").agg(F.avg("top")).first()[0]
    model.log_k = (mean if mean is not None else 0.0) - EULER
    evidence = map_rows(labelled.select("toxic", "text"), lambda rows: ((y, evidence_of(model, x)) for y, x in rows), "toxic int, x double")
    table = evidence.groupBy("toxic", F.round("x", 1).alias("x")).count()
    model.curve = logistic(bounded_rows(table, 2 * max_labels, "evidence"))
    return model


def decay_rate(counts: DataFrame, scores: dict[str, float], neutral: float) -> float:
    """The positive root of the score distribution's exponential sum over harmless text."""
    of = counts.sparkSession.createDataFrame(list(scores.items()), "token string, s double")
    rows = counts.join(F.broadcast(of), "token").where("clean > 0").groupBy(F.round("s", 3).alias("s")).agg(F.sum("clean").alias("n")).collect()
    total = counts.agg(F.sum("clean")).first()[0]
    s = np.array([r.s for r in rows] + [neutral])
    p = np.array([r.n for r in rows] + [0.0]) / total
    p[-1] = 1 - p[:-1].sum()
    if not (s[p > 0] > 0).any() or s @ p >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while (p * np.exp(np.minimum(high * s, 600))).sum() < 1:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * s, 600))).sum() < 1 else (low, mid)
    return (low + high) / 2


def evidence_of(model: ToxicityModel, text: str | None) -> float:
    """Sum of the normalised scores of the significant segments, at most 50."""
    return min(50.0, sum(x[3] for x in model.segments(text or "")))


def logistic(rows: list) -> tuple[float, float]:
    """Intercept and slope by Newton's method over (toxic, x, count) rows, lightly regularised."""
    y, x, n = (np.array([float(r[i]) for r in rows]) for i in range(3))
    design, beta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (n * (y - p)) - 1e-3 * beta
        hess = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, segments) of every row; a segment is (start, end, score) in characters."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            found = model.segments(text or "")
            evidence = min(50.0, sum(x[3] for x in found))
            yield doc_id, model.score(evidence), [{"start": a, "end": b, "score": e} for _, a, b, e in found]

    schema = "doc_id long, score double, segments array<struct<start:int,end:int,score:double>>"
    return map_rows(docs.select("doc_id", "text"), run, schema)


def with_verdict(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with all its columns and the document's ``toxicity`` score."""
    names = docs.columns
    score = "toxicity"
    while score in names:
        score = f"_{score}"

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        at = names.index("text")
        for row in rows:
            yield *row, model.score(evidence_of(model, row[at]))

    return map_rows(docs, run, docs.select("*", F.lit(0.0).alias(score)).schema), score
