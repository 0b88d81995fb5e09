"""The corpus pipeline, stage by stage and whole, against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from corpusloom.llm import packing

RNG = random.Random(11)
WORDS = [f"word{i}" for i in range(300)]
VILE = ["vile", "scum", "stupid", "idiot", "filth"]


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept_ids(rows):
    """The smallest id of each class of texts with a shingle overlap of 3/4; texts without words stay."""
    sets = {d: shingles(t or "") for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, a in sets.items():
        for e, b in sets.items():
            if d < e and a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = sorted((find(d), find(e)))
                root[q] = p
    return {d for d in sets if find(d) == d}


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rows, labels = [], []
    for i in range(160):
        words = RNG.choices(WORDS, k=RNG.randrange(20, 80))
        toxic = i % 4 == 0
        if toxic:
            at = RNG.randrange(len(words))
            words[at:at] = RNG.choices(VILE, k=12)
        text = " ".join(words)
        if i % 7 == 1 and not toxic:
            text += f" write to user{i}@mail.org now"
        rows.append((i, text, ["en", "de", None][i % 3], f"src{i % 5}"))
        labels.append((i, 1, int(toxic)))
    clean = [r for r in rows if r[0] % 4]
    for j, r in enumerate(clean[:20]):  # exact and near copies
        rows.append((200 + j, r[1] if j % 2 else r[1] + " end", r[2], r[3]))
    rows += [(300, None, "en", "src1"), (301, "", None, None)]
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_do_what_they_say(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "n-gram Jaccard join", "PII", "mixing sources to target weights", "best-fit packing"]

    mild = stages["toxicity"](spark, docs, sf_dir)
    assert mild.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in mild.collect()}
    assert set(left) == {d for d, t in given.items() if "vile" not in (t or "") and "scum" not in (t or "")}

    single = stages["n-gram Jaccard join"](spark, mild, sf_dir)
    assert single.columns == docs.columns
    once = {r["doc_id"]: r["text"] for r in single.collect()}
    assert set(once) == kept_ids(left.items()) and all(once[d] == left[d] for d in once)
    assert len(once) < len(left)

    safe = stages["PII"](spark, single, sf_dir)
    assert safe.columns == docs.columns
    for r in safe.collect():
        text = once[r["doc_id"]]
        want = text and re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "<EMAIL>", text)
        assert r["text"] == want and r["n_chars"] == len(want or "")

    mixed = stages["mixing sources to target weights"](spark, safe, sf_dir)
    assert mixed.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in safe.collect()}
    taken = Counter(r["doc_id"] for r in mixed.collect())
    assert taken and all(r["text"] == texts[r["doc_id"]] for r in mixed.collect())

    pieces = stages["best-fit packing"](spark, mixed, sf_dir).collect()
    for d, n in taken.items():
        ids = [*packing.encode(texts[d] or "").tolist(), 0]
        own = [p for p in pieces if p["doc_id"] == d]
        assert len(own) == n and all(p["length"] == len(ids) and p["start"] == 0 for p in own)
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        assert {p["ids_crc32"] for p in own} == {crc}
    for s in {p["sequence_id"] for p in pieces}:
        own = sorted((p["offset"], p["length"]) for p in pieces if p["sequence_id"] == s)
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048


def test_whole_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    key = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(rows) == key(docs)
