"""Hierarchical language identification: family first, then one-versus-one linear SVMs inside it.

A text becomes hashed counts of byte pairs and triples of its lower-cased letters (square roots,
unit length), read from the whole text. Linear support vector machines, trained with Spark's
``LinearSVC``, decide between each two families and, inside a family, between each two of its
languages; votes decide, margins break ties. The fit uses a bounded sample of labelled rows
(``per_lang`` documents of each language, those with the smallest hash of the id); prediction
covers every row.

A text that is null or has no letter is ``und`` with score 0. Languages without a family of the
table are a family of their own. Rows with a null language are not learned from; with one learned
language all texts get it; without any, all are ``und``. Repeated rows are scored alike; further
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows
from corpusloom.plans.lineage import bounded_rows, materialize

DIM = 4096
UNKNOWN = "und"
#: Common languages by family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af",
    "romance": "es fr it pt ro ca gl",
    "slavic": "ru uk be pl cs sk bg sr hr sl",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "indic": "hi ur bn mr pa ne",
    "semitic": "ar he am",
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}
#: Bytes of ASCII characters that aren't letters become blanks; bytes of other characters stay.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
HAS_LETTER = re.compile(r"[^\W\d_]")
PAIR, TRIPLE = np.uint32(2654435761), np.uint32(2246822519)


def features(text: str, dim: int = DIM) -> np.ndarray:
    """Unit vector of hashed letter pairs and triples."""
    raw = b" " + b" ".join(text.lower().encode().translate(LETTERS).split()) + b" "
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    two = b[:-1] | b[1:] << np.uint32(8)
    three = two[:-1] | b[2:] << np.uint32(16)
    shift = np.uint32(32 - dim.bit_length() + 1)
    at = np.concatenate([two * PAIR >> shift, (three * TRIPLE + PAIR) >> shift])
    x = np.sqrt(np.bincount(at, minlength=dim))
    return x / max(np.linalg.norm(x), 1e-12)


@dataclass
class LanguageModel:
    """Languages by family, and a separating hyperplane (weights, intercept) for each pair of names."""

    families: dict[str, list[str]]
    planes: dict[tuple[str, str], tuple[np.ndarray, float]]

    def choose(self, names: list[str], x: np.ndarray) -> tuple[str, float]:
        """The name with most pairwise votes, ties by summed margin, and a confidence."""
        if len(names) == 1:
            return names[0], 1.0
        score = {n: [0, 0.0, np.inf] for n in names}
        for a, b in combinations(names, 2):
            w, c = self.planes[a, b]
            margin = float(w @ x + c)
            for n, m in ((a, margin), (b, -margin)):
                score[n][0] += m > 0
                score[n][1] += m
                score[n][2] = min(score[n][2], m)
        best = max(names, key=lambda n: (*score[n][:2], n))
        return best, float(1 / (1 + np.exp(-2 * score[best][2])))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not HAS_LETTER.search(text):
            return UNKNOWN, 0.0
        x = features(text)
        family, sure = self.choose(sorted(self.families), x)
        lang, also = self.choose(self.families[family], x)
        return lang, sure * also


def training_sample(docs: DataFrame, learn: F.Column, per_lang: int, max_langs: int) -> DataFrame:
    """(lang, text) of at most ``per_lang`` documents of each language; only ids and languages are ranked."""
    keys = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    keys = keys.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_lang)
    langs = bounded_rows(keys.select("lang").distinct(), max_langs, "languages")
    # At most per_lang * max_langs ids.
    chosen = F.broadcast(keys.select("doc_id", "lang"))
    return docs.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"]).where(F.lit(bool(langs))).select("lang", "text")


def fit(docs: DataFrame, learn: F.Column, per_lang: int = 1000, max_langs: int = 100, max_iter: int = 25, reg: float = 1e-4) -> LanguageModel:
    """Train on rows of ``docs(doc_id, text, lang)`` for which ``learn`` holds."""

    def vectors(rows: Iterable[tuple]) -> Iterator[tuple]:
        for lang, text in rows:
            if HAS_LETTER.search(text):
                yield lang, features(text).tolist()

    sample = training_sample(docs, learn, per_lang, max_langs)
    stored = materialize(map_rows(sample, vectors, "lang string, x array<double>", batch=200), "langid")
    stored = stored.select("lang", array_to_vector("x").alias("features"))
    langs = sorted(r[0] for r in bounded_rows(stored.select("lang").distinct(), max_langs, "languages"))
    families: dict[str, list[str]] = {}
    for lang in langs:
        families.setdefault(FAMILY_OF.get(lang, f"~{lang}"), []).append(lang)
    planes = {}

    def separate(a: str, b: str, ours: list[str], theirs: list[str]) -> None:
        rows = stored.where(F.col("lang").isin(ours + theirs)).withColumn("label", F.col("lang").isin(ours).cast("double"))
        model = LinearSVC(maxIter=max_iter, regParam=reg, standardization=False, aggregationDepth=2).fit(rows)
        planes[a, b] = model.coefficients.toArray(), model.intercept

    for a, b in combinations(sorted(families), 2):
        separate(a, b, families[a], families[b])
    for members in families.values():
        for a, b in combinations(members, 2):
            separate(a, b, [a], [b])
    return LanguageModel(families, planes)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield doc_id, *model.predict(text)

    return map_rows(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")
