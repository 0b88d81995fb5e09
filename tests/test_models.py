import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import counts, language_model as lm, naive_bayes as nb, split, tfidf
from corpusloom.sources import models

LM_TOY = [(1, "x", "the football team won the match"), (2, "x", "the football team lost the game"),
          (3, "x", "every football player trains daily")]
NB_TOY = [(1, "sport", "football match goal victory"), (2, "sport", "team football game"),
          (3, "tech", "computer software code"), (4, "tech", "software code computer algorithm")]
TFIDF_TOY = [(1, "a", "stock market profit"), (2, "a", "stock market shares"),
             (3, "b", "football match cup"), (4, "b", "football cup")]


def probabilities(spark, model, rows, smoothing):
    pairs = spark.createDataFrame(rows, "context string, word string")
    return {(r["context"], r["word"]): r["p"] for r in lm.with_probability(pairs, model, smoothing).collect()}


# --- language models -------------------------------------------------------------------------


def test_mle(spark, tokens):
    model = lm.train(tokens(LM_TOY), 2)
    asked = [("football", "team"), ("football", "player"), ("football", "won"), ("never", "won")]
    p = probabilities(spark, model, asked, False)
    assert p[asked[0]] == pytest.approx(2 / 3) and p[asked[1]] == pytest.approx(1 / 3)
    assert p[asked[2]] == 0 and p[asked[3]] == 0


def test_laplace_sums_to_one(spark, tokens):
    model = lm.train(tokens(LM_TOY), 2)
    words = [r["word"] for r in model.vocab.collect()]
    assert {"<s>", "</s>"} <= set(words)
    assert model.vocab_size.first()["vocab_size"] == len(words)
    for context in ("football", "never"):
        p = probabilities(spark, model, [(context, w) for w in words], True)
        assert sum(p.values()) == pytest.approx(1.0)
    assert probabilities(spark, model, [("football", "unheard")], True)[("football", "unheard")] > 0


def test_empty_model(spark, tokens):
    model = lm.train(tokens([(1, "x", "")]), 2)
    assert probabilities(spark, model, [("a", "b")], True) == {("a", "b"): 0.0}
    assert lm.predict_next_words(spark.createDataFrame([("a",)], "context string"), model).count() == 0


def test_sequence_scores(tokens):
    model = lm.train(tokens(LM_TOY), 2)
    docs = tokens([(1, "x", "the football team won"), (2, "x", ""), (3, "x", "zebra")])
    smooth = {r["doc_id"]: r for r in lm.sequence_scores(docs, model).collect()}
    assert smooth[1]["perplexity"] > 1 and smooth[1]["n_predictions"] == 5
    v = model.vocab_size.first()["vocab_size"]
    want = sum(map(math.log, [3 / (3 + v), 3 / (4 + v), 3 / (3 + v), 2 / (2 + v), 1 / (1 + v)]))
    assert smooth[1]["log_likelihood"] == pytest.approx(want)
    assert smooth[1]["probability"] == pytest.approx(math.exp(want))
    assert smooth[2]["log_likelihood"] == 0 and math.isinf(smooth[2]["perplexity"])
    plain = {r["doc_id"]: r for r in lm.sequence_scores(docs, model, False).collect()}
    assert plain[3]["log_likelihood"] == -math.inf and plain[3]["probability"] == 0 and plain[3]["perplexity"] == math.inf


def test_repeated_windows_count_each_time(tokens):
    docs = tokens([(1, "x", "a b a b a b")])
    model = lm.train(docs, 2)
    got = lm.sequence_scores(docs, model, False).first()
    assert got["n_predictions"] == 7
    assert got["log_likelihood"] == pytest.approx(2 * math.log(2 / 3) + math.log(1 / 3))


@pytest.mark.parametrize("n", [1, 3, 4, 5])
def test_other_orders(tokens, n):
    model = lm.train(tokens(LM_TOY), n)
    assert model.total_tokens.first()["total_tokens"] == 20
    assert lm.sequence_scores(tokens(LM_TOY), model).where(F.col("perplexity") <= 1).count() == 0


def test_orders_in_one_pass_equal_single_models(tokens):
    docs = tokens(LM_TOY)
    many = lm.train_orders(docs, [2, 3])
    for n in (2, 3):
        assert sorted(many[n].ngrams.collect()) == sorted(lm.train(docs, n).ngrams.collect())


def test_training_again_adds(tokens):
    a, b = tokens(LM_TOY[:2]), tokens(LM_TOY[2:])
    added = lm.add_counts(lm.train(a, 2), lm.train(b, 2))
    assert sorted(added.ngrams.collect()) == sorted(lm.train(tokens(LM_TOY), 2).ngrams.collect())


@pytest.mark.parametrize("smoothing", [True, False])
@pytest.mark.parametrize("k", [1, 3, 20])
def test_next_words_equal_brute_force(spark, tokens, smoothing, k):
    model = lm.train(tokens(LM_TOY), 2)
    words = [r["word"] for r in model.vocab.collect()]
    for context in ("football", "the", "never"):
        asked = spark.createDataFrame([(context,)], "context string")
        got = [(r["word"], r["p"]) for r in lm.predict_next_words(asked, model, k, smoothing).orderBy("rank").collect()]
        p = probabilities(spark, model, [(context, w) for w in words], smoothing)
        ranked = sorted(((w, x) for (_, w), x in p.items() if smoothing or x > 0), key=lambda t: (-t[1], t[0]))[:k]
        assert [w for w, _ in got] == [w for w, _ in ranked]
        assert [x for _, x in got] == pytest.approx([x for _, x in ranked])


def test_language_model_round_trip(spark, tokens, tmp_path):
    model = lm.train(tokens(LM_TOY), 3)
    models.save_language_model(model, str(tmp_path / "lm"))
    back = models.load_language_model(spark, str(tmp_path / "lm"))
    assert back.n == 3 and sorted(back.ngrams.collect()) == sorted(model.ngrams.collect())
    with pytest.raises(FileNotFoundError):
        models.load_language_model(spark, str(tmp_path / "none"))


# --- naive Bayes -----------------------------------------------------------------------------


def test_priors_and_likelihood(tokens):
    model = nb.fit(tokens(NB_TOY))
    classes = {r["category"]: r for r in model.classes.collect()}
    assert classes["sport"]["prior"] == 0.5 and classes["sport"]["vocab_size"] == 10
    assert classes["sport"]["total_words"] + classes["tech"]["total_words"] == 14
    grid = {(r["category"], r["term"]): math.exp(r["log_prob"]) for r in nb.word_likelihood(model).collect()}
    assert len(grid) == 20
    assert grid["sport", "football"] == pytest.approx(3 / 17) and grid["tech", "football"] == pytest.approx(1 / 17)
    assert sum(p for (c, _), p in grid.items() if c == "sport") == pytest.approx(1)


def test_imbalanced_priors(tokens):
    docs = tokens([*NB_TOY[:2], (5, "sport", "goal"), NB_TOY[2]])
    assert {r["category"]: r["prior"] for r in nb.class_priors(docs).collect()} == {"sport": 0.75, "tech": 0.25}


def test_posteriors(tokens):
    model = nb.fit(tokens(NB_TOY))
    docs = tokens([(1, "?", "football match"), (2, "?", "zebra quux"), (3, "?", ""), (4, "?", "code football code code")])
    out = {r["doc_id"]: r for r in nb.predict(docs, model).collect()}
    assert out[1]["probabilities"] == pytest.approx([6 / 7, 1 / 7]) and out[1]["predicted"] == "sport"
    assert out[2]["probabilities"] == pytest.approx([0.5, 0.5]) and out[3]["probabilities"] == pytest.approx([0.5, 0.5])
    assert out[2]["predicted"] == "sport"  # tie: first class
    dense = {(r["category"], r["term"]): r["log_prob"] for r in nb.word_likelihood(model).collect()}
    for i, c in enumerate(["sport", "tech"]):
        want = math.log(0.5) + 3 * dense[c, "code"] + dense[c, "football"]
        assert out[4]["scores"][i] == pytest.approx(want)


def test_zero_alpha_rules_out_classes(tokens):
    model = nb.fit(tokens(NB_TOY), alpha=0.0)
    out = {r["doc_id"]: r for r in nb.predict(tokens([(1, "?", "football"), (2, "?", "")]), model).collect()}
    assert out[1]["scores"][1] == -math.inf and out[1]["probabilities"] == [1.0, 0.0]
    assert out[2]["probabilities"] == pytest.approx([0.5, 0.5])


def test_bad_input(spark, tokens):
    with pytest.raises(ValueError):
        nb.fit(tokens(NB_TOY), alpha=-1)
    with pytest.raises(ValueError):
        nb.fit(spark.createDataFrame([], "doc_id bigint, category string, tokens array<string>"))


def test_fit_counts_with_fixed_vocabulary(spark, tokens):
    docs = tokens(NB_TOY)
    vocab = spark.createDataFrame([("football",), ("code",), ("unused",)], "term string")
    model = nb.fit_counts(docs, counts.term_counts(docs), vocab=vocab)
    assert {r["vocab_size"] for r in model.classes.collect()} == {3}
    assert {r["term"] for r in model.words.collect()} == {"football", "code"}


def test_naive_bayes_round_trip(spark, tokens, tmp_path):
    model = nb.fit(tokens(NB_TOY))
    models.save_naive_bayes(model, str(tmp_path / "nb"))
    back = models.load_naive_bayes(spark, str(tmp_path / "nb"))
    docs = tokens([(1, "?", "football match code")])
    assert nb.predict(docs, back).collect() == nb.predict(docs, model).collect()


# --- TF-IDF and counts -----------------------------------------------------------------------


def test_idf_and_unit_length(tokens):
    docs = tokens(TFIDF_TOY)
    model = tfidf.fit(docs)
    vocab = {r["term"]: r for r in model.vocab.collect()}
    assert vocab["stock"]["idf"] == pytest.approx(math.log(5 / 3) + 1)
    assert [vocab[t]["idx"] for t in sorted(vocab)] == list(range(len(vocab)))
    lengths = tfidf.transform(docs, model).groupBy("doc_id").agg(F.sum(F.col("value") ** 2).alias("s")).collect()
    assert len(lengths) == 4 and all(r["s"] == pytest.approx(1) for r in lengths)


def test_unseen_terms_give_no_rows(tokens):
    model = tfidf.fit(tokens(TFIDF_TOY))
    assert tfidf.transform(tokens([(9, "?", "brand new words"), (8, "?", "")]), model).count() == 0
    assert "brand" not in {r["term"] for r in model.vocab.collect()}


def test_cap_and_min_df(tokens):
    docs = tokens([(1, "a", "common_word rare"), (2, "a", "common_word other"), (3, "a", "common_word other")])
    assert [r["term"] for r in tfidf.fit(docs, min_df=2, max_features=1).vocab.collect()] == ["common_word"]
    with pytest.raises(ValueError):
        tfidf.fit(docs.where("doc_id < 0"))


def test_options(tokens):
    docs = tokens([(1, "a", "x x x y"), (2, "a", "y")])
    raw = {(r["doc_id"], r["term"]): r["value"] for r in tfidf.transform(docs, tfidf.fit(docs, sublinear=True, l2=False)).collect()}
    assert raw[1, "x"] == pytest.approx((1 + math.log(3)) * (math.log(3 / 2) + 1)) and raw[2, "y"] == pytest.approx(1)


def test_explain_ranks_contributions(spark, tokens):
    docs = tokens(TFIDF_TOY)
    model = tfidf.fit(docs)
    weights = spark.createDataFrame(
        [("stock", "a", 1.0), ("market", "a", -2.0), ("profit", "a", 0.5), ("cup", "b", 1.0)], "term string, category string, weight double")
    rows = tfidf.explain(docs.where("doc_id = 1"), model, weights, 2).orderBy("rank").collect()
    assert [r["term"] for r in rows] == ["stock", "profit"]
    assert rows[0]["contribution"] == pytest.approx(rows[0]["tfidf"])


def test_tfidf_round_trip(spark, tokens, tmp_path):
    model = tfidf.fit(tokens(TFIDF_TOY), 1, 2)
    models.save_tfidf(model, str(tmp_path / "t"))
    back = models.load_tfidf(spark, str(tmp_path / "t"))
    assert (back.low, back.high, back.l2) == (1, 2, True)
    assert sorted(back.vocab.collect()) == sorted(model.vocab.collect())


def test_idf_table(spark, tokens):
    docs = tokens([(1, "a", "market share"), (2, "a", "market profit"), (3, "a", "market economy")])
    table, meta = counts.idf_table(docs)
    idf = {r["term"]: r["idf"] for r in table.collect()}
    assert idf["market"] == pytest.approx(1.0) and idf["share"] == pytest.approx(math.log(2) + 1)
    assert meta.first()["default_idf"] == pytest.approx(math.log(4) + 1)
    empty, meta = counts.idf_table(docs.where("doc_id < 0"))
    assert empty.count() == 0 and meta.first()["default_idf"] == 1.0


def test_frequency_vocab_falls_back_to_all(tokens):
    docs = tokens([(1, "a", "b b a c"), (2, "a", "")])
    ranked = lambda m: [r["term"] for r in counts.frequency_vocab(docs, m).orderBy("idx").collect()]
    assert ranked(2) == ["b"] and ranked(10) == ["b", "a", "c"]


def test_bow_index_is_dense_and_sorted(spark):
    words = [f"w{i:05d}" for i in range(3000)]
    docs = spark.createDataFrame([(i, "x", [w]) for i, w in enumerate(words)], "doc_id bigint, category string, tokens array<string>")
    got = counts.bow_fit(docs.repartition(7)).collect()
    assert {r["term"]: r["idx"] for r in got} == {w: i for i, w in enumerate(words)}


# --- split -----------------------------------------------------------------------------------


def sizes(frame):
    return {(r["category"], r["split"]): r["count"] for r in frame.groupBy("category", "split").count().collect()}


def test_split_sizes_of_a_news_corpus(spark):
    wanted = {"business": 510, "entertainment": 386, "politics": 417, "sport": 511, "tech": 401}
    assert split.test_allocation(wanted, 0.2) == {"business": 102, "entertainment": 77, "politics": 84, "sport": 102, "tech": 80}
    rows = [(i * 1000 + j, c) for i, (c, n) in enumerate(wanted.items()) for j in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, category string")
    got = split.stratified_split(docs)
    assert {c: n for (c, s), n in sizes(got).items() if s == "test"} == {"business": 102, "entertainment": 77, "politics": 84, "sport": 102, "tech": 80}
    again = split.stratified_split(docs.repartition(5))
    assert sorted(got.collect()) == sorted(again.collect())
    other = split.stratified_split(docs, seed=7)
    assert sorted(got.collect()) != sorted(other.collect()) and sizes(other) == sizes(got)


def test_split_of_tiny_classes(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "doc_id bigint, category string")
    got = split.stratified_split(docs, 0.5)
    assert sum(n for (_, s), n in sizes(got).items() if s == "test") == 2


def test_copies_stay_together(spark):
    rows = [(i, "a", f"text {i // 3}") for i in range(90)] + [(i, "a", "copy") for i in range(90, 120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, category string, text string").withColumn("copy_of", F.md5("text"))
    got = split.stratified_split(docs, 0.25, unit="copy_of")
    assert got.groupBy("text").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert got.where("split = 'test'").count() <= 30


def test_copies_under_two_labels_stay_together(spark):
    rows = [(i, "ab"[i % 3 % 2], f"k{i // 4}" if i % 9 else None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, category string, key string")
    got = split.stratified_split(docs, 0.3, unit="key")
    assert got.columns == ["doc_id", "category", "key", "split"] and got.count() == 400
    assert got.groupBy("key").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert 80 <= got.where("split = 'test'").count() <= 120


def test_split_rejects_bad_size(spark):
    with pytest.raises(ValueError):
        split.stratified_split(spark.createDataFrame([(1, "a")], "doc_id bigint, category string"), 1.5)


def test_counts_of_an_unknown_class(spark):
    labels = spark.createDataFrame([("x",)], "category string")
    table = spark.createDataFrame([("x", "a", 1), ("y", "b", 2)], "category string, term string, cnt bigint")
    with pytest.raises(ValueError, match="'y'"):
        nb.fit_counts(labels, table)


def test_pairs_cut_a_language_model_down_before_the_join(spark, tokens):
    from corpusloom.operators import language_model as lm

    model = lm.train(tokens([(1, "a", "x y x"), (2, "a", "y x")]), 2)
    pairs = spark.createDataFrame([("x", "y"), ("q", "x"), ("x", "y"), (None, "x")], "context string, word string")
    out = lm.with_probability(pairs, model, smoothing=False)
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["context"] or "", round(r["p"], 6)) for r in out.collect()) == [("", 0.0), ("q", 0.0), ("x", 0.333333), ("x", 0.333333)]


def test_most_frequent_terms_are_picked_without_numbering_all(spark, tokens):
    from corpusloom.operators import tfidf

    docs = tokens([(1, "a", "b c a"), (2, "a", "c b"), (3, "a", "c d")])
    for top in (2, 3):
        small = {r["term"]: r["idx"] for r in tfidf.fit(docs, max_features=top).vocab.collect()}
        assert small == {t: i for i, t in enumerate(sorted(["c", "b", "a"][:top]))}


def test_frequent_words_read_the_tokens_once(spark, tokens, tmp_path):
    from corpusloom.operators import counts

    said = spark.sparkContext.accumulator(0)
    docs = tokens([(1, "a", "b b c"), (2, "a", "b")])

    def seen(batches):
        for batch in batches:
            said.add(batch.num_rows)
            yield batch

    found = counts.frequency_vocab(docs.mapInArrow(seen, docs.schema), 2).collect()
    assert [(r["term"], r["cnt"]) for r in found] == [("b", 3)] and said.value == 2


def test_several_orders_shuffle_the_longest_windows_only(spark, tokens):
    docs = tokens([(1, "x", "a b a b c"), (2, "y", "b"), (3, "y", ""), (4, "x", "a b a b c")])
    several = lm.count_orders(docs, [2, 4, 3])
    plan = several._jdf.queryExecution().executedPlan().toString()
    alone = [tuple(r) for n in (2, 3, 4) for r in lm.count_orders(docs, [n]).collect()]
    assert sorted(map(tuple, several.collect())) == sorted(alone) and several.columns == ["n", "context", "word", "cnt"]
    assert plan.count("Exchange ") == 1 and plan.index("Aggregate") < plan.index("Exchange ") and "partial_count" not in plan[plan.index("Exchange ") :]


def test_windows_of_several_orders_are_shuffled_as_compressed_blocks(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 3)
    texts = [["a", "b", "a b", "c"], ["x", "a", "b", "c"], ["x a", "b", "c"], ["<s>", "</s>"], ["é", "", "z"], [], None, ["a", "b", "a b", "c"]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id bigint, tokens array<string>")
    several = lm.count_orders(docs, [2, 3, 5])
    alone = [tuple(r) for n in (2, 3, 5) for r in lm.count_orders(docs, [n]).collect()]
    assert sorted(map(tuple, several.collect())) == sorted(alone)
    plan = several._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(cell" in plan and "back0" not in plan
    # Null words count as words; contexts leave them out.
    holes = spark.createDataFrame([(1, ["a", None, "b"])], "doc_id bigint, tokens array<string>")
    assert ("a", "b") in {(r["context"], r["word"]) for r in lm.count_orders(holes, [2, 3]).where("n = 3").collect()}


def test_a_block_of_windows_holds_each_word_once():
    words = [f"word{i}" for i in np.random.default_rng(3).integers(0, 200, 20_000)]
    blocks = [b for b in lm._window_blocks([pa.array([words])], 2, 5, 4)]
    parts = [lm._unpacked(b.column("block")[0].as_py()) for b in blocks]
    assert sum(x.shape[1] for _, x in parts) == 20_001 and all(len(w) == len(set(w.to_pylist())) for w, _ in parts)
    assert sum(len(b.column("block")[0].as_py()) for b in blocks) < 10 * len(words)
