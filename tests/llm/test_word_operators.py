"""Spelling variants, language-model scoring and collocations against plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import causal_lm, collocations, spelling

TEXT = "doc_id bigint, text string, lang string, n long, word string, key string"


def frame(spark, rows):
    """(doc_id, text, lang) rows, with further columns that carry names used inside the operators."""
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], TEXT)


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- spelling -----------------------------------------------------------------------------


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abÿ", min_size=1, max_size=6), min_size=1, max_size=40))
def test_sorted_scan_finds_all_pairs_behind_the_first_half(words):
    words = sorted(w.encode("latin-1") for w in words)
    scan = spelling.SortedWords(words)
    found = set(zip(*(x.tolist() for x in scan.near(words))))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            half = max(len(a), len(b)) // 2
            if one_edit(a, b) and a[:half] == b[:half]:
                assert (i, j) in found
    assert all(words[i] == words[j] or one_edit(words[i], words[j]) for i, j in found)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=6), st.text("ab", max_size=8), st.integers(0, 3))
def test_a_shard_is_only_skipped_without_a_near_word(shared, word, exact):
    shared, word = shared.encode(), word.encode()
    exact = min(exact, len(shared), len(word))
    if shared[:exact] == word[:exact] and not spelling.within_one(shared, word, exact):
        ends = [b"", b"a", b"b", *[word[i:] for i in range(len(word))]]
        assert not any(one_edit(shared + e, word) and (shared + e)[: len(word) // 2] == word[: len(word) // 2] and len(word) // 2 >= exact for e in ends)


def plain_variants(rows, least=7):
    n = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[a-zÀ-ÿ]+", fold(text)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    v = {w: c for w, c in n.items() if len(w) >= least and c >= 2}
    near = {w: [x for x in v if one_edit(w, x)] for w in v}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-v[x], x), default=None)
        if best and v[best] >= 10 * v[w]:
            form[w] = best
    out = {}
    for w in v:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, v[w], len(near[w]), v.get(form.get(w)))
    return out


@pytest.mark.parametrize("shard", [spelling.SHARD_WORDS, 3])
def test_variants_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(spelling, "SHARD_WORDS", shard)
    rng = np.random.default_rng(5)
    base = ["internet", "internal", "international", "académie", "übermaß", "spelling", "aaaaaaaa", "aaaaaaaaa"]
    rows = [(7, None, "en"), (None, "", None), (None, "International internat ional×", "en")]
    for i in range(60):
        words = []
        for w in rng.choice(base, 30, p=[0.6, 0.1, 0.1, 0.04, 0.04, 0.04, 0.04, 0.04]):
            if rng.random() < 0.15:
                k = int(rng.integers(len(w)))
                w = [w[:k] + w[k + 1 :], w[:k] + "e" + w[k:], w[:k] + "x" + w[k + 1 :]][int(rng.integers(3))]
            words.append(w.title() if rng.random() < 0.3 else w)
        rows.append((int(rng.integers(20)), " ".join(words) + " " + "b" * 300, "en"))
    rows += rows[5:8]
    got = {r["word"]: tuple(r)[1:] for r in spelling.spelling_variants(frame(spark, rows)).collect()}
    assert got == plain_variants(rows)
    assert any(g[0] for g in got.values())


def test_roots_follow_whole_chains_and_empty_tables_give_no_rows(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(18)]
    got = dict(map(tuple, spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert set(got.values()) == {"w18"}
    assert spelling.spelling_variants(frame(spark, [])).collect() == []
    assert spelling.spelling_variants(frame(spark, [(1, "kurz und klein", "de")])).collect() == []


# --- language model -----------------------------------------------------------------------


def small_model(n_ids=400):
    counts = np.random.default_rng(1).integers(0, 50, n_ids)
    symbols = causal_lm.symbols_of(counts, groups=4, members=4, tails=3)
    return counts, symbols, causal_lm.Attention(symbols, width=6, context=3, scored=4)


def test_probabilities_of_all_ids_sum_to_one():
    counts, symbols, model = small_model()
    hidden = np.random.default_rng(2).normal(size=(1, 6)).astype(np.float32)
    logs = model.log_probability(np.repeat(hidden, len(counts), axis=0), symbols.of) + symbols.share
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)
    assert symbols.of[-1] == 0 and len(set(symbols.of)) == 4 * 4 + 3


def test_gradient_equals_differences():
    _, symbols, model = small_model()
    for k in model.w:
        model.w[k] = model.w[k].astype(np.float64)
    rng = np.random.default_rng(3)
    seen = rng.integers(0, model.pad, (5, 7))
    seen[0, :2] = model.pad
    target, real = rng.integers(0, model.pad, (5, 4)), rng.random((5, 4)) < 0.8
    loss, g = model.gradient(seen, target, real)
    for k, v in model.w.items():
        for _ in range(4):
            at = tuple(int(rng.integers(n)) for n in v.shape)
            kept, step = v[at], 1e-5
            v[at] = kept + step
            up = model.gradient(seen, target, real)[0]
            v[at] = kept - step
            down = model.gradient(seen, target, real)[0]
            v[at] = kept
            assert g[k][at] == pytest.approx((up - down) / (2 * step), abs=2e-4), k
    logs = model.log_probability(model.hidden(seen)[0][real], target[real])
    assert -logs.mean() == pytest.approx(loss, rel=1e-4)


def plain_score(ids, symbols, model):
    """One window after the other, one id after the other."""
    end = len(symbols.of) - 1
    whole = [end, *ids, end]
    s = symbols.of[whole]
    total = 0.0
    for p in range(len(whole) - 1):
        start = p // model.scored * model.scored - model.context
        places = range(max(0, start), p + 1)
        w = {k: v.astype(np.float64) for k, v in model.w.items()}
        d = model.width
        a = np.array([w["asks"][s[p], d:] @ w["gives"][s[j], :d] + w["distance"][p - j] for j in places])
        a = np.exp(a - a.max())
        h = w["asks"][s[p], :d] + sum(x * w["gives"][s[j], d:] for x, j in zip(a / a.sum(), places))
        z = h @ w["group"] + w["group_bias"]
        t, own = s[p + 1], model.inner * model.members
        g = t // model.members if t < own else model.inner + t - own
        total += z[g] - np.log(np.exp(z).sum()) + symbols.share[whole[p + 1]]
        if t < own:
            z = h @ w["member"][g] + w["member_bias"][g]
            total += z[t - g * model.members] - np.log(np.exp(z).sum())
    return total / np.log(10)


def test_windows_score_each_id_once_with_its_context():
    _, symbols, model = small_model()
    rng = np.random.default_rng(4)
    many = rng.integers(1, 4, 30)
    ids = rng.integers(0, 399, many.sum()).astype("<u2")
    words = np.split(ids, np.cumsum(many)[:-1])
    docs = [rng.integers(0, 30, n).astype("<u4") for n in (0, 1, 9, 40, 2)]
    row = (ids.tobytes(), many.astype("<u4").tobytes(), [len(d) for d in docs], np.concatenate(docs).tobytes())
    got = causal_lm.Windows(row, symbols, model.context, model.scored).scores(model)
    want = [plain_score([i for w in d for i in words[w]], symbols, model) for d in docs]
    assert got == pytest.approx(want, rel=1e-5)


def test_scores_of_texts(spark, monkeypatch):
    monkeypatch.setattr(causal_lm, "BLOCK_BYTES", 2000)
    rng = np.random.default_rng(6)
    names = ["the", "Of", "and", "räder", "stone", "river.", "light", "dark", "x y", "<|endoftext|>"]
    rows = [(None, "the\x0bOf a\x85b", None), (3, None, "en"), (4, "", "en"), (4, "  \t\n", "de"), (11, "word " * 3000, "en")]
    rows += [(i, " ".join(rng.choice(names, int(rng.integers(1, 60)))), "en") for i in range(100, 160)]
    rows += rows[-3:]
    docs = frame(spark, rows)
    training = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 != 0
    got = causal_lm.score_texts(docs, training).collect()
    c = Counter()
    for doc_id, text, _ in rows:
        if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10:
            c.update([*fold(text).encode().split(), "end"])
    n, v = sum(c.values()), len(c)
    want = []
    for doc_id, text, _ in rows:
        words = [*fold(text).encode().split(), "end"]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        want.append((-1 if doc_id is None else doc_id, len(words), sum(c[w] > 0 for w in words), n, round(base, 6)))
    assert sorted((-1 if r[0] is None else r[0], r[1], r[2], r[3], round(r[4], 6)) for r in got) == sorted(want)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    seen = [r for r in got if r["doc_id"] and r["doc_id"] >= 100]
    assert sum(r["score"] for r in seen) > 1.2 * sum(r["base_score"] for r in seen)  # learns at all
    assert causal_lm.score_texts(docs.limit(0), F.lit(True)).collect() == []
    none = causal_lm.score_texts(docs.where("doc_id = 4"), F.lit(False)).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in none] == [(0, 0)] * 2


# --- collocations -------------------------------------------------------------------------


def plain_collocations(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", fold(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = defaultdict(list)
    longer = {(lang, p): a for (lang, p), a in f.items() if a >= least and len(p) > 1}
    for (lang, p), a in longer.items():
        cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        inside = (b for (m, q), b in longer.items() if m == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
        if not any(100 * b >= 80 * a for b in inside):
            found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, i, p.decode(), -a, left, right, n[lang], -score)
        for lang, xs in found.items() for i, (score, a, p, left, right) in enumerate(sorted(xs)[:top], 1)
    )


def collocation_rows():
    rng = np.random.default_rng(8)
    words = ["of", "the", "New", "york", "City", "É", "straße", "a\x01b", "-", "x" * 40]
    rows = [(1, None, "en"), (2, "", None), (3, " \t ,.\n", "fr"), (None, "the the the the the", None)]
    for i in range(40):
        text = ""
        for _ in range(60):
            text += str(rng.choice(words)) if rng.random() < 0.6 else "new york city of"
            text += str(rng.choice([" ", "  ", "\t", ", ", ".\n", "!"], p=[0.7, 0.1, 0.05, 0.05, 0.05, 0.05]))
        rows.append((i, text, ["en", "en", "de", None][i % 4]))
    return rows + rows[7:9]


@pytest.mark.parametrize("block", [1 << 20, 150])
def test_collocations_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    rows = collocation_rows()
    got = sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), least=12, top=25).collect())
    assert got == plain_collocations(rows, 12, 25)
    assert any(len(r[2].split(" ")) == 4 for r in got) and {r[0] for r in got} == {"en", "de", "und"}


@pytest.mark.parametrize("weak", [False, True])
def test_phrases_of_blocks_are_exact_whatever_collides(monkeypatch, weak):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 150)
    if weak:
        real = collocations.Block.runs

        def runs(self, n, where=None):
            i, keys = real(self, n, where)
            return i, keys % np.uint64(7) << np.uint64(61)

        monkeypatch.setattr(collocations.Block, "runs", runs)
    rows = collocation_rows()
    got, want = Counter(), Counter()
    every = collocations.Bits(np.full(1 << 10, 255, np.uint8))
    for b in collocations.blocks([(r[2], r[1]) for r in rows], collocations.Hasher()):
        for phrase, n, m in collocations.block_phrases(b, every):
            assert len(phrase.split(b" ")) == n
            got[b.lang, phrase.decode()] += m
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", fold(text)):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    want["und" if lang is None else lang, " ".join(words[i : i + k])] += 1
    assert got == want


def test_collocations_of_nothing(spark):
    assert collocations.collocations(frame(spark, [])).collect() == []
    assert collocations.collocations(frame(spark, [(1, None, None)])).collect() == []


def test_word_numbers_tell_words_with_equal_fingerprints_apart():
    block = collocations.Block(b"ab cd ab\nef cd", "en", 0, collocations.Hasher())
    block.words = np.zeros(5, np.uint64)
    assert block.word_numbers().tolist() == [0, 1, 0, 2, 1]


def test_scores_pass_64_bits(spark, monkeypatch):
    big = 10**13
    rows = [("en", "a b", 2, big), ("en", "a", 1, 3 * big), ("en", "b", 1, big + 7), ("en", None, 0, 9 * big)]
    table = spark.createDataFrame(rows, "lang string, phrase string, k int, f long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda docs, least: table)
    [row] = collocations.collocations(table).collect()
    assert row["score"] == 2000000 * big // (4 * big + 7)


@pytest.mark.parametrize("size", [0, 10, 1 << 20, 3 << 20, 5 << 20, 1 << 40])
@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_rounds_of_training_take_every_batch(n, size):
    rounds = causal_lm.ROUNDS
    taken = [b for nth in range(rounds) for b in causal_lm.batches_of(n, nth, rounds, size)]
    assert set(taken) == set(range(n))
    if size > 4 << 20:
        assert len(taken) == n


@pytest.mark.parametrize("size", [0, 3 << 20, 5 << 20, 1 << 40])
def test_every_batch_is_learned_from_in_as_many_passes_whatever_the_size(size):
    rounds = causal_lm.ROUNDS
    taken = Counter(b for nth in range(causal_lm.turns_of(rounds, size)) for b in causal_lm.batches_of(7, nth, rounds, size))
    assert set(taken) == set(range(7)) and min(taken.values()) >= rounds
    if size > 2 << 20:
        assert set(taken.values()) == {rounds}


def test_training_makes_all_its_passes_over_a_large_input(spark, monkeypatch):
    docs = frame(spark, [(i, f"stone river light {i} " * 1000, "en") for i in range(12)])
    blocks = causal_lm.text_blocks(docs, F.lit(True), 1, "byte_bpe_50k")
    symbols = causal_lm.symbols_of(causal_lm.id_counts(blocks, 50_257))
    loaded, plain = [], causal_lm.Attention.load
    monkeypatch.setattr(causal_lm.Attention, "load", lambda self, row: loaded.append(1) or plain(self, row))
    causal_lm.train(blocks, symbols, 1 << 40)
    assert len(loaded) == 2 * causal_lm.ROUNDS  # a round of a half each


def test_a_training_step_makes_two_softmaxes_however_many_groups(monkeypatch):
    rng = np.random.default_rng(5)
    symbols = causal_lm.symbols_of(rng.integers(1, 50, 400), groups=16, members=8, tails=3)
    model = causal_lm.Attention(symbols, width=6, context=3, scored=4)
    seen, target = rng.integers(0, 131, (40, 7)), rng.integers(0, 131, (40, 4))
    plain, rows = causal_lm.log_softmax, []
    monkeypatch.setattr(causal_lm, "log_softmax", lambda logits: rows.append(len(logits)) or plain(logits))
    loss, g = model.gradient(seen, target, np.ones((40, 4), bool))
    assert rows == [160, int((target < 128).sum())]
    logs = model.log_probability(model.hidden(seen)[0].reshape(-1, 6), target.ravel())
    assert np.isclose(loss, -logs.mean(), rtol=1e-4)
    # Within a group the gradient of the biases adds up to nothing; a group without targets has none.
    assert np.abs(g["member_bias"].sum(axis=1)).max() < 1e-5
    none = np.setdiff1d(np.arange(16), target[target < 128] // 8)
    assert not g["member"][none].any()
