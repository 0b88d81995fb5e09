"""Substring removal, n-gram join, personal data and mixing against brute force on small rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import fm_index, mixing, ngram_join, pii, substring

RNG = random.Random(3)
VOCAB = [f"w{i}" for i in range(60)]


def sentence(n):
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    passage, base = sentence(50), sentence(80)
    changed = base.split()
    changed[40] = "new"
    texts = [
        f"{sentence(20)} {passage} {sentence(9)}",
        f"{sentence(5)}\t{passage}",
        base,
        base.upper(),
        " ".join(changed),
        base,
        "la " * 100,
        None,
        "",
        "one two",
        "ONE two",
        sentence(3000),
    ]
    rows = [(i, t, "en", "s1", i, "x", 1.0) for i, t in enumerate(texts)]
    rows.append(rows[2])
    schema = "doc_id long, text string, lang string, source string, n_chars long, tokens string, component_id double"
    return spark.createDataFrame(rows, schema)


def brute_removed(texts, width):
    every = {}
    for t in texts:
        w = (t or "").encode().split()
        for i in range(len(w) - width + 1):
            every[tuple(w[i : i + width])] = every.get(tuple(w[i : i + width]), 0) + 1
    out = []
    for t in texts:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if every[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_substring_removal(docs):
    rows = docs.collect()
    want = sorted((r.doc_id, *w) for r, w in zip(rows, brute_removed([r.text for r in rows], 35)))
    got = substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == want
    assert sum(w[2] for w in want) > 300
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_frequent_anchors_change_nothing(docs, monkeypatch):
    monkeypatch.setattr(substring, "MANY", 1)
    monkeypatch.setattr(substring, "SHARE", 1e-3)
    rows = docs.collect()
    got = {r.doc_id: r.n_removed for r in substring.remove_repeats(docs).collect()}
    assert got == {r.doc_id: w[1] for r, w in zip(rows, brute_removed([r.text for r in rows], 35))}


def test_fm_index_counts_windows():
    rng = np.random.default_rng(1)
    seqs = [rng.integers(1, 4, n) for n in (40, 5, 31, 64, 1)]
    weights = [1, 2, 1, 1, 3]
    spans = fm_index.repeated_windows(seqs, weights, 4, 5)
    flat = [tuple(s[i : i + 5]) for s, w in zip(seqs, weights) for _ in range(w) for i in range(len(s) - 4)]
    for s, found in zip(seqs, spans):
        covered = [any(a <= i < b for a, b in found) for i in range(len(s))]
        want = [any(flat.count(tuple(s[j : j + 5])) > 1 for j in range(max(0, i - 4), min(i, len(s) - 5) + 1)) for i in range(len(s))]
        assert covered == want


def classes(rows):
    def shingles(t):
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    sets = [(r.doc_id, shingles(r.text)) for r in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, a in sets:
        for e, b in sets:
            if d < e and a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = sorted((find(d), find(e)))
                root[q] = p
    return sorted({(d, len(s), find(d)) for d, s in sets})


def test_ngram_join(docs):
    got = ngram_join.near_duplicates(docs).collect()
    assert sorted(set(map(tuple, got))) == classes(docs.collect())
    assert len(got) == docs.count()
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _, c in classes(docs.collect()) if d == c}
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("few", "row_block", "flush"), [(4, 2000, 4_000_000), (0, 3, 20), (0, 7, 1)])
def test_ngram_join_in_blocks(spark, monkeypatch, few, row_block, flush):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "ROW_BLOCK", row_block)
    monkeypatch.setattr(ngram_join, "PAIR_FLUSH", flush)
    monkeypatch.setattr(ngram_join, "CELL_ENTRIES", 50)
    monkeypatch.setattr(ngram_join, "PIVOT_ROWS", 3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(40):  # near copies, some of which don't link with the original
        w = list(base)
        for _ in range(i % 5):
            w[RNG.randrange(120)] = f"n{RNG.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    for i in range(40, 70):  # a passage in many short texts that don't link
        rows.append((i, " ".join([f"p{j}" for j in range(30)] + [f"x{i}_{j}" for j in range(4 + i % 9)])))
    for i in range(70, 90):  # a chain: neighbours link, the ends don't
        rows.append((i, " ".join(f"c{j}" for j in range(4 * (i - 70), 4 * (i - 70) + 100))))
    for i in range(90, 100):  # beginnings of one text, of many lengths
        rows.append((i, " ".join(f"l{j}" for j in range(12 * (i - 88)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = classes(docs.collect())
    assert sorted(map(tuple, ngram_join.near_duplicates(docs).collect())) == want
    assert len({c for d, _, c in want if d < 40}) > 1 and len({c for d, _, c in want if 70 <= d < 90}) == 1


def test_keep_one_with_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(2, text, 1, "a"), (1, text, 2, "b"), (1, text + " more", 3, "c"), (None, "else", 4, "d"), (None, None, 5, "e"), (7, "", 6, "f")]
    names = "_id id of row own set text_ component size"
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, mark string")
    docs = docs.select("doc_id", "text", "n", *[F.col("mark").alias(c) for c in names.split()])
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["n"] for r in kept.collect()} in ({2, 4, 5, 6}, {3, 4, 5, 6})


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def luhn(d):
        s = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return sum(x - 9 * (x > 9) for x in s) % 10 == 0

    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) < 256 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(out)]


def test_definite_spans(spark):
    pieces = ["a@b.c", "+x@d.e", "1.2.3.4", "256.1.1.1", "001.2.3.4.5.6.7.8", "4111 1111-1111 1111", "4111111111111112", "+1 (234) 555-0199", "+1 2", "é", " ", "  ", "-", ".", "@", "7", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"", "555-123-4567"]
    texts = ["".join(RNG.choice(pieces) for _ in range(RNG.randrange(1, 12))) for _ in range(300)]
    texts += [None, "", "9" * 30_000, "a" * 30_000 + "@", "1 " * 20_000, "+" + "1" * 12]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.find_spans(docs).collect()}
    for i, t in enumerate(texts):
        base = [(s.start, s.end, s.kind) for s in got[i].base]
        assert base == plain_spans(t), t
        assert {tuple(s) for s in got[i].base} <= {tuple(s) for s in got[i].spans}
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert not any("a@b.c" in (r.text or "") for r in clean.collect())
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_mixing_budgets(spark):
    leaves = spark.createDataFrame(
        [("d", "en", "a", 100), ("d", "en", "b", 1000), ("d", "de", "c", 10), ("e", "en", "a", 5000)],
        "_domain string, _lang string, _source string, tokens long",
    )
    config = mixing.MixConfig(lang_weights={"en": 3.0}, total=1000, max_epochs=1)
    got = {(r[0], r[1], r[2]): r.budget for r in mixing.leaf_budgets(leaves, config).collect()}
    # de is short of 125 and takes 10; its siblings get the rest, of which a can use 100.
    assert got == {("d", "de", "c"): 10, ("d", "en", "a"): 100, ("d", "en", "b"): 390, ("e", "en", "a"): 500}


def test_mixing_rows(docs):
    out = mixing.mix(docs, mixing.MixConfig(share=1.5), size="size")
    assert set(docs.columns) < set(out.columns)
    rows = out.collect()
    total = sum(len((r.text or "").split()) for r in docs.collect())
    assert total < sum(r.size for r in rows) <= 1.5 * total
    assert mixing.mix(docs.limit(0)).count() == 0


def test_many_matches_in_one_text(spark):
    n = 100_000
    text = " ".join(f"é a{i}@x.org" for i in range(n))
    docs = spark.createDataFrame([(1, text), (2, "b@c.de and +49 (30) 1234-5678"), (3, None), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find_spans(docs).collect()}
    assert [(s["start"], s["end"]) for s in got[1]["base"]] == [m.span() for m in re.finditer(r"a[0-9]+@x\.org", text)]
    assert [(s["kind"], s["start"], s["end"]) for s in got[2]["base"]] == [("email", 0, 6), ("phone", 11, 29)]
    assert got[3]["base"] == got[4]["base"] == []
    out = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert out[1] == " ".join(["é <EMAIL>"] * n) and out[2] == "<EMAIL> and <PHONE>" and out[3] is None and out[4] == ""


def test_columns_with_clashing_names_stay(spark):
    names = ["_base", "_more", "_spans", "spans", "row", "tokens", "epoch", "domain", "_n", "_full", "_lang", "_id", "start"]
    docs = spark.createDataFrame([(i, f"m{i}@x.org word{i}", "en", f"src{i}") for i in range(8)], "doc_id long, text string, lang string, source string")
    docs = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in names])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert r["text"] == f"<EMAIL> word{r['doc_id']}" and all(r[c] == f"{c}{r['doc_id']}" for c in names)
    mixed = mixing.mix(docs, mixing.MixConfig(domain=F.lit("d")), "e2", "t2", "d2")
    assert mixed.columns == [*docs.columns, "t2", "d2", "e2"]
    for r in mixed.collect():
        assert all(r[c] == f"{c}{r['doc_id']}" for c in names) and r["t2"] == 2 and r["d2"] == "d"
    assert sorted(mixing.mix(docs, mixing.MixConfig(domain=F.lit("d"))).columns) == sorted(docs.columns)
