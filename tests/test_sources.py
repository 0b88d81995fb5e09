import pytest
from pyspark.sql import functions as F

from corpusloom.catalog import oracle_sql, queries
from corpusloom.operators import linear
from corpusloom.plans import lineage
from corpusloom.sources import corpus, models, vectors as vs
from corpusloom.sources.vectors import parse_word_vectors


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_load_corpus(spark, tmp_path):
    write(tmp_path / "c.csv", 'category,title,text\n Sport ,T1,"He said ""go"",\nthen left"\n,T2,no category\nTech,T3,\nTECH,,  \n')
    rows = corpus.load_corpus(spark, str(tmp_path / "c.csv")).collect()
    assert [(r["category"], r["text"]) for r in rows] == [("sport", 'He said "go",\nthen left')]


def test_load_corpus_rejects(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        corpus.load_corpus(spark, str(tmp_path / "none.csv"))
    write(tmp_path / "a.csv", "category,title\nsport,x\n")
    with pytest.raises(ValueError, match="text"):
        corpus.load_corpus(spark, str(tmp_path / "a.csv"))
    write(tmp_path / "b.csv", "category,text\nweather,rain\n")
    with pytest.raises(ValueError, match="weather"):
        corpus.load_corpus(spark, str(tmp_path / "b.csv"))
    write(tmp_path / "d.csv", "category,text\nsport,\n")
    with pytest.raises(ValueError):
        corpus.load_corpus(spark, str(tmp_path / "d.csv"))


def test_text_tree(spark, tmp_path):
    root = tmp_path / "bbc"
    write(root / "sport" / "001.txt", "Title here\n\n  first line \nsecond\n")
    write(root / "sport" / "002.txt", "only line")
    write(root / "tech" / "001.txt", "caf\xe9 prices\nup \xa310", "latin-1")
    write(root / "tech" / "003.txt", " \n ")
    write(root / "other" / "001.txt", "ignored")
    got = {(r["category"], r["name"]): (r["title"], r["text"]) for r in corpus.ingest_text_tree(spark, str(root)).collect()}
    assert got == {
        ("sport", "001"): ("Title here", "first line second"),
        ("sport", "002"): ("only line", "only line"),
        ("tech", "001"): ("caf\xe9 prices", "up \xa310"),
    }


def test_synth_corpus_passes_the_gate(spark):
    counts = spark.createDataFrame(list(corpus.EXPECTED_COUNTS.items()), "category string, n bigint")
    docs = corpus.synth_corpus(counts)
    assert docs.count() == 2225 and docs.select("doc_id").distinct().count() == 2225
    first = docs.where("category = 'tech'").orderBy("doc_id").first()
    assert first["title"].endswith("(Part 1)") and "TEC-0001" in first["text"]
    assert corpus.accepted_corpus(docs).count() == 2225
    assert corpus.accepted_corpus(docs.where("category <> 'tech'")) is None


def test_word_vector_file(spark, tmp_path):
    lines = ["bad x y", "one", "apple 1 2", "banana 3 4 5", "other 1 1", "cherry 5 6", "apple 7 8"]
    write(tmp_path / "v.txt", "\n".join(lines))
    vocab = spark.createDataFrame([("apple",), ("banana",), ("cherry",), ("bad",), ("none",)], "term string")
    table = vs.read_word_vectors(spark, str(tmp_path / "v.txt"), vocab)
    assert {r["word"]: r["vec"] for r in table.collect()} == {"apple": [7, 8], "cherry": [5, 6]}
    assert vs.coverage(table, vocab).first()["percent"] == 40.0
    only = vs.read_word_vectors(spark, str(tmp_path / "v.txt"), vocab, dim=3)
    assert [r["word"] for r in only.collect()] == ["banana"]
    with pytest.raises(ValueError):
        vs.read_word_vectors(spark, str(tmp_path / "v.txt"), spark.createDataFrame([("zzz",)], "term string"))
    with pytest.raises(FileNotFoundError):
        vs.read_word_vectors(spark, str(tmp_path / "none.txt"), vocab)


def test_random_vectors(spark):
    vocab = spark.createDataFrame([(f"w{i}",) for i in range(50)], "term string")
    a = {r["word"]: r["vec"] for r in vs.random_vectors(vocab, 10).collect()}
    b = {r["word"]: r["vec"] for r in vs.random_vectors(vocab.repartition(3), 10).collect()}
    assert a == b and all(sum(x * x for x in v) ** 0.5 == pytest.approx(3.0) for v in a.values())
    assert a != {r["word"]: r["vec"] for r in vs.random_vectors(vocab, 10, seed=1).collect()}


def test_target_vocab(spark, tokens, tmp_path):
    docs = tokens([(1, "a", "x y x")])
    assert {r["term"] for r in vs.target_vocab(spark, None, docs).collect()} == {"x", "y"}
    spark.createDataFrame([("q",)], "term string").write.parquet(str(tmp_path / "vocab"))
    assert [r["term"] for r in vs.target_vocab(spark, str(tmp_path / "vocab"), docs).collect()] == ["q"]
    with pytest.raises(FileNotFoundError):
        vs.target_vocab(spark)


def test_linear_bundle(spark, tmp_path):
    def model(x):
        return linear.OneVsRest(
            ["b", "a"],
            spark.createDataFrame([("a", 0, x), ("b", 0, -x)], "category string, idx bigint, weight double"),
            spark.createDataFrame([("a", x), ("b", 0.0)], "category string, bias double"), None, {"l2": 0.1})

    path = str(tmp_path / "bundle")
    models.save_linear_bundle({"one": model(1.0), "two": model(2.0)}, "two", path)
    one, default = models.load_linear(spark, path, "one"), models.load_linear(spark, path)
    assert one.classes == ["b", "a"] and one.params["l2"] == 0.1
    assert {r["weight"] for r in one.weights.collect()} == {1.0, -1.0}
    assert {r["weight"] for r in default.weights.collect()} == {2.0, -2.0}
    assert {r["weight"] for r in models.load_linear(spark, path, "gone").weights.collect()} == {2.0, -2.0}


def test_bounds_are_enforced(spark):
    with pytest.raises(lineage.BoundExceeded):
        lineage.bounded_rows(spark.range(11), 10, "rows")
    assert len(lineage.bounded_rows(spark.range(10), 10, "rows")) == 10


def test_registry():
    assert set(oracle_sql()) <= set(queries()) and len(queries()) >= 85


def test_type_suffixes_are_no_numbers(spark):
    lines = spark.createDataFrame([(1, "a 1d 2f"), (2, "a 1e1 -.5"), (3, "b 0x1 2")], "line_no long, value string")
    vocab = spark.createDataFrame([("a",), ("b",)], "term string")
    assert [tuple(r) for r in parse_word_vectors(lines, vocab).collect()] == [("a", [10.0, -0.5])]


def test_half_written_and_changed_models_are_refused(spark, tmp_path):
    path, table = str(tmp_path / "v"), spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "word string, vec array<double>")
    models.save_vectors(table, path)
    models.check_model(spark, path)
    assert models.load_vectors(spark, path).count() == 2
    spark.createDataFrame([("a", [1.0]), ("b", [2.5])], table.schema).write.mode("overwrite").parquet(f"{path}/vectors")
    with pytest.raises(models.BrokenModel, match="vectors"):
        models.check_model(spark, path)
    table.limit(1).write.mode("overwrite").parquet(f"{path}/vectors")
    with pytest.raises(models.BrokenModel):  # the number of rows is compared at each load
        models.load_vectors(spark, path)
    failing = table.withColumn("vec", F.when(F.col("word") == "b", F.raise_error(F.lit("lost"))).otherwise(F.col("vec")))
    with pytest.raises(Exception, match="lost"):
        models.save_vectors(failing, path)
    with pytest.raises((models.BrokenModel, FileNotFoundError)):
        models.load_vectors(spark, path)
    models.save_vectors(table, path)
    assert models.load_vectors(spark, path).count() == 2
    with pytest.raises(FileNotFoundError):
        models.load_vectors(spark, str(tmp_path / "none"))


@pytest.mark.parametrize(("master", "own"), [("local[4]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("yarn", False)])
def test_only_one_process_may_do_without_a_shared_folder(master, own):
    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Session:
        conf, sparkContext = Conf, type("Context", (), {"master": master})

    if own:
        assert lineage.shared_dir(Session) == lineage.shared_dir(Session)
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            lineage.shared_dir(Session)
