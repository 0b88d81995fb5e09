"""The rows toxicity learns from."""

from corpusloom.llm import toxicity


def test_a_toxic_variant_of_a_clean_text_is_learnt(spark):
    rows = [(1, "a b c d e f", 0), (2, "a b c d e f", 1), (3, "a b c d e f", 1), (4, "", 0), (5, "", 1)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert {r.doc_id for r in toxicity.apart(labelled).collect()} == {1, 2, 4, 5}
