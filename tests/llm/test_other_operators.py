"""Packing, chat formatting, toxicity, language, neighbours and vector links on small rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import chat, cover_tree, langid, multi_index, packing, toxicity

RNG = random.Random(5)


def one_by_one(lengths, capacity):
    """Best-fit decreasing, one piece at a time."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in bins if r >= n]
        if fit:
            bins.remove(min(fit))
            bins.append(min(fit) - n)
        else:
            bins.append(capacity - n)
    return sorted(bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_best_fit_matches_single_steps(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    used: dict[int, list] = {}
    for r in packing.best_fit(counts, 30):
        for i in range(r.count):
            used.setdefault(r.bin + i // r.each, []).append((r.offset + i % r.each * r.length, r.length))
    assert sorted(30 - sum(n for _, n in b) for b in used.values()) == one_by_one(lengths, 30)
    for b in used.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60) | st.text("aé ñ<|endofx>\n\t'sÄ!9 ", max_size=60))
def test_fast_ids_are_the_tokenizers(text):
    slow, _ = packing.tokenizers_of("byte_bpe_50k")
    assert packing.encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_packing(spark):
    texts = ["hello world", None, "", "word " * 5000, "<|endoftext|>", "hello world"]
    rows = [(i, t, 9) for i, t in enumerate(texts)] + [(0, "hello world", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    got = packing.best_fit_packing(docs).collect()
    by_bin: dict[int, list] = {}
    for r in got:
        by_bin.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in by_bin.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048
    long = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 3)
    assert [n for _, _, n in long][1:] == [2048, 2048] and long[1][1] == long[0][2]
    assert [r.ids_crc32 for r in got if r.doc_id == 1] == [zlib.crc32(b"\0\0\0\0")]
    assert packing.best_fit_packing(docs.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool", "[:]"]), st.lists(st.sampled_from(["</s>", "[INST]", "[/", "INST]", "<", "␛", "0.", "x", "<<SYS>>", "[TURN]", "[:]"])).map("".join))))
def test_chat_round_trip(turns):
    codec = chat.Codec(chat.ChatTemplate())
    formatted = "".join(s for role, text in turns for s, _ in codec.segments(role, text))
    assert codec.read(formatted) == turns


def test_chat_digest(spark):
    rows = [(1, 1, "assistant", "yes </s>"), (1, 0, "user", None), (2, 0, "assistant", "a"), (None, 0, "user", "q"), (3, 0, None, "z"), (3, 0, None, "z")]
    given_rows = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    got = {r.conv_id: r for r in chat.chat_digest(chat.format_turns(given_rows)).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nyes </s>\n").hexdigest()
    assert (got[1].loss_chars, got[1].valid, got[2].valid, got[3].n_turns, got[None].n_turns) == (8, True, False, 2, 1)
    assert got[1].loss_sha256 == hashlib.sha256(b"yes </s>").hexdigest()
    whole = {r.conv_id: r.formatted for r in chat.format_conversations(given_rows).collect()}
    assert len(whole[1]) == got[1].formatted_chars
    assert chat.chat_digest(chat.format_turns(given_rows.limit(0))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=25))
def test_maximal_segments(scores):
    def brute(lo, hi):
        best = max(((sum(scores[i:j]), i - j, -i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=None)
        if not best or best[0] <= 0:
            return []
        # The shortest best segment, leftmost.
        s, _, _, i, j = max(((sum(scores[i:j]), i - j, -i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)))
        return [*brute(lo, i), (s, i, j), *brute(j, hi)]

    found = toxicity.maximal_segments([(float(s), i, i + 1) for i, s in enumerate(scores)])
    assert sum(s for s, _, _ in found) == sum(s for s, _, _ in brute(0, len(scores)))


def test_toxicity(spark):
    words = [f"calm{chr(97 + i % 26)}{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(300):
        w = [RNG.choice(words) for _ in range(40)]
        if i % 5 == 1:
            w[10:10] = ["nasty", "vile"]
        rows.append((i, " ".join(w), 0.5))
        labels.append((i, int(i % 5 == 1)))
    rows += [(900, None, 0.0), (901, "", 0.0), (902, "calma0 " * 20_000, 0.0), (903, "x nasty vile y", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, labels[1], (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks, F.lit(True))
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert all((got[i].score >= 0.5) == bool(y) for i, y in labels)
    assert got[903].score >= 0.5 > max(got[i].score for i in (900, 901, 902))
    first = got[903].segments[0]
    assert "x nasty vile y"[first.start : first.end] == "nasty vile"
    none = toxicity.fit(docs, marks.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0}


def test_language(spark):
    texts = {"en": "the weather with thing", "de": "schön und nicht größe", "es": "mañana el niño está", "fr": "être où ça garçon"}
    rows = [(i, " ".join(RNG.sample(t.split(), 4)) * 5, lang, 0.1) for i, (lang, t) in enumerate(list(texts.items()) * 12)]
    rows += [(100, None, "en", 0.0), (101, "123 !?", "en", 0.0), (102, "the thing", None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs, F.col("doc_id") % 8 < 4)).collect()}
    held = [r for r in rows if r[0] % 8 >= 4 and r[0] < 100]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in held]) > 0.9
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und", "und", "en"]
    assert langid.predict(docs, langid.fit(docs.limit(0), F.lit(True))).first().lang_pred == "und"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 8))
    x[20:40] = x[19] + 0.05 * rng.normal(size=(20, 8))
    x[50:60] = x[50]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [float("nan")] * 8, 1), (203, [None] + [1.0] * 7, 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int"), x


def test_neighbours(vectors):
    df, x = vectors
    got = multi_index.neighbours(df, df.where("vec_id % 10 = 0")).collect()
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got}
    for q in range(0, 150, 10):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(150), d)) if i != q][:10]
        for n, i in enumerate(order):
            assert found[q, n + 1][0] == i and abs(found[q, n + 1][1] - d[i]) < 1e-12
    assert len(found) == 150
    assert multi_index.neighbours(df.limit(0), df).count() == 0


@pytest.mark.parametrize("part", [6000, 40])
def test_vector_links(vectors, monkeypatch, part):
    monkeypatch.setattr(cover_tree, "PART", part)
    df, x = vectors
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([min([label[i], *label[near[i]]]) for i in range(len(x))])
    got = {r.vec_id: r for r in cover_tree.near_duplicates(df).collect()}
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), label[i], label[i] == i)
    assert all((got[i].n_links, got[i].kept) == (0, True) for i in (200, 201, 202, 203))
    assert cover_tree.near_duplicates(df.limit(0)).count() == 0


def test_cover_trees_measure_many_distances_at_once(monkeypatch):
    calls, apart = [], cover_tree.apart
    monkeypatch.setattr(cover_tree, "apart", lambda a, b: calls.append(1) or apart(a, b))
    x = np.random.default_rng(3).normal(size=(800, 24))
    x[400:420] = x[:20] + 0.01
    x /= np.linalg.norm(x, axis=1)[:, None]
    trees = [cover_tree.CoverTree(x[:400]), cover_tree.CoverTree(x[400:])]
    found = set()
    for _, a, b in cover_tree.traverse(*trees, 0.4):
        found |= {(i, j) for i in trees[0].members[a].tolist() for j in trees[1].members[b].tolist()}
    assert {(i, j) for i, j in np.argwhere(apart(x[:400], x[400:]) <= 0.4).tolist()} <= found
    assert len(calls) < 100
