from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import preprocess as P


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first()["y"]


def test_html_is_stripped(spark):
    raw = "<div id=x>Two <i>ferries</i> left<br/>the <span class='q'>harbour</span> early</div>"
    out = " ".join(one(spark, raw, T.strip_html).split())
    assert out == "Two ferries left the harbour early"
    assert one(spark, None, T.strip_html) == ""


def test_clean_text(spark):
    raw = "Tram 14 (new!) Reaches OSLO's Docks; 2.8 km, @council: 'done' #Line7"
    assert one(spark, raw, T.clean_text) == "tram new reaches oslo s docks km council done line"
    assert one(spark, None, T.clean_text) == ""


def test_urls_end_at_unicode_space(spark):
    assert one(spark, "see https://a.b/c?d now www.x.org end", T.clean_text) == "see now end"


def test_score_line_survives_in_number_mode(spark):
    raw = "Kelda won 7-1 away from home"
    assert "7-1" in one(spark, raw, lambda x: T.tokenize(x, True))
    assert one(spark, raw, T.tokenize) == ["kelda", "won", "away", "from", "home"]
    both = one(spark, "-a- b--c 3-0-1", lambda x: T.tokenize(x, True))
    assert both == ["a", "b", "c", "3-0-1"]


def test_fused_forms_are_optional(spark):
    assert one(spark, "I cannot, gonna", T.tokenize) == ["i", "can", "not", "gon", "na"]
    assert one(spark, "I cannot", lambda x: T.tokenize(x, split_fused=False)) == ["i", "cannot"]


def test_empty_text_has_no_tokens(spark):
    assert one(spark, "  ", T.tokenize) == [] and one(spark, "!?", lambda x: T.tokenize(x, True)) == []


def test_stop_words(spark):
    words = ["a", "lighthouse", "was", "built", "on", "this", "q", "reef"]
    assert one(spark, words, T.remove_stopwords, "array<string>") == ["lighthouse", "built", "reef"]
    assert one(spark, words, lambda t: T.remove_stopwords(t, ["reef", "on"]), "array<string>") == [
        "lighthouse", "was", "built", "this"]


def test_default_preprocessing(spark):
    docs = spark.createDataFrame(
        [(1, "<li>Harbour pilots</li> <em>were boarding ships</em> at 6, players running")],
        "doc_id int, text string",
    )
    out = P.preprocess(docs).first()["tokens"]
    assert "harbour" in out and not {"were", "at", "6"} & set(out) and {"player", "run"} <= set(out)
    assert P.preprocess(docs, as_text=True).first()["tokens"] == " ".join(out)


def test_lemma_table_prefers_changed_verb(spark, tokens):
    docs = tokens([(1, "a", "saw leaves being leaves"), (2, "a", "")])
    table = spark.createDataFrame(
        [("saw", "v", "see"), ("saw", "n", "saw"), ("leaves", "v", "leave"), ("leaves", "n", "leaf"),
         ("being", "v", "being"), ("being", "n", "be-ing")],
        "token string, pos string, lemma string",
    )
    out = {r["doc_id"]: r["tokens"] for r in P.lemmatize_tokens(docs, table).collect()}
    assert out == {1: ["see", "leave", "be-ing", "leave"], 2: []}


def test_lemmas_from_a_dictionary(spark):
    words = spark.createDataFrame(
        [(w,) for w in "running players studying matches corporations men studies news".split()], "token string")
    lexicon = spark.createDataFrame(
        [("run", "v"), ("player", "n"), ("study", "v"), ("study", "n"), ("match", "n"), ("match", "v"),
         ("corporation", "n"), ("man", "n"), ("news", "n")], "word string, pos string")
    rare = spark.createDataFrame([("running", "v", "run")], "token string, pos string, lemma string")
    found = P.effective_lemmas(P.derive_lemmas(words, lexicon, rare))
    assert {r["token"]: r["lemma"] for r in found.collect()} == {
        "running": "run", "players": "player", "studying": "study", "matches": "match",
        "corporations": "corporation", "men": "man", "studies": "study", "news": "news"}


def test_padding_and_contexts(spark):
    pad = lambda n: one(spark, ["hello", "world"], lambda t: T.pad_tokens(t, n), "array<string>")
    assert pad(2) == ["<s>", "hello", "world", "</s>"]
    assert pad(3)[:2] == ["<s>", "<s>"] and pad(5)[:4] == ["<s>"] * 4
    ctx = lambda ws, n: one(spark, ws, lambda t: T.normalize_context(t, n), "array<string>")
    assert ctx(["a"], 3) == ["<s>", "a"] and ctx(["a", "b", "c"], 3) == ["b", "c"] and ctx(["a"], 1) == []


def test_ngrams(spark):
    grams = lambda ws, n: one(spark, ws, lambda t: T.extract_ngrams(t, n), "array<string>")
    assert grams(["a", "b", "c", "d"], 3) == [["a", "b", "c"], ["b", "c", "d"]] and grams(["a"], 2) == []
    both = one(spark, ["world", "cup", "final"], lambda t: T.ngram_range(t, 1, 2), "array<string>")
    assert both == ["world", "cup", "final", "world_cup", "cup_final"]
    assert one(spark, [], lambda t: T.ngram_range(t, 1, 2), "array<string>") == []


def test_skipgram_pairs(spark):
    pairs = one(spark, ["a", "b", "c", "d"], lambda t: T.skipgram_pairs(t, 2), "array<string>")
    got = sorted((p["center"], p["context"]) for p in pairs)
    words = "abcd"
    want = sorted((words[i], words[j]) for i in range(4) for j in range(4) if 0 < abs(i - j) <= 2)
    assert len(got) == 10 and got == want
    assert one(spark, ["a"], lambda t: T.skipgram_pairs(t, 2), "array<string>") == []


def test_histogram(spark):
    h = one(spark, ["b", "a", "b"], T.term_histogram, "array<string>")
    assert {r["term"]: r["cnt"] for r in h} == {"a": 1, "b": 2}


def test_preview(spark):
    assert one(spark, " a\n b  c", lambda x: T.text_preview(x, 2)) == "a b..."


def test_input_status(spark):
    docs = spark.createDataFrame(
        [(1, "Economy growth"), (2, "Krypton blork zork"), (3, "   "), (4, "!!!"), (5, None)], "doc_id int, text string")
    vocab = spark.createDataFrame([("economy",), ("growth",)], "term string")
    out = {r["doc_id"]: r for r in P.input_status(docs, [vocab, vocab]).collect()}
    assert [out[i]["status"] for i in range(1, 6)] == ["ok", "oov", "empty", "no_tokens", "empty"]
    assert out[1]["covered_1"] == 2 and out[1]["percent_2"] == 100.0 and out[2]["all_oov"]


def test_drop_stop_rows(spark):
    rows = spark.createDataFrame([("the",), ("x",), ("cup",)], "token string")
    stops = spark.createDataFrame([("the",)], "token string")
    assert [r["token"] for r in P.drop_stop_rows(rows, stops).collect()] == ["cup"]


def test_tokenize_equals_cleaning_first(spark):
    texts = ["", " <", "<b>I cannot</b> gonna-cannot http://x.y/cannot www.a b", "WWW.X.org É<i", "a<b wannahttp", "Kelvin İs", "5 6"]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "x string")
    x = F.col("x")
    for fused in (True, False):
        both = rows.select(T.tokenize(x, split_fused=fused).alias("a"), T.tokenize_clean(T.clean_text(x), split_fused=fused).alias("b"))
        assert all(r["a"] == r["b"] for r in both.collect())


def test_tokenize_builds_no_cleaned_text(spark):
    plan = spark.createDataFrame([("x",)], "x string").select(T.tokenize(F.col("x")).alias("t"))
    shown = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "[^a-z]+" in shown and "trim(" not in shown


def test_a_small_lemma_table_joins_no_tokens(spark):
    docs = spark.createDataFrame([(1, "x", ["was", None, "b"]), (1, "x", ["ran"]), (2, "y", []), (None, "z", ["was"])], "doc_id int, c string, tokens array<string>")
    table = spark.createDataFrame([("was", "v", "be"), ("ran", "v", "run"), ("b", "n", "b")], "token string, pos string, lemma string")
    out = P.lemmatize_tokens(docs, table)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    found = {r["doc_id"]: r["tokens"] for r in out.collect()}
    assert found == {1: ["be", "run", "b"], 2: [], None: ["be"]}
