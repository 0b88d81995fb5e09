"""Registered queries on the words of ``documents``, and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import causal_lm, collocations, spelling


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Every frequent long word with its near words, form and root."""
    return spelling.spelling_variants(spark.read.parquet(f"{sf}/documents.parquet"))


def op12_causal_lm(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's log10 probability by word counts and by the causal model."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    scored = causal_lm.score_texts(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """Each language's best phrases."""
    return collocations.collocations(spark.read.parquet(f"{sf}/documents.parquet"))


#: ASCII case folding as SQL.
FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Steps of crc32 for the 256 bytes, by its rule.
CRC_TABLE = (
    "crc AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), "
    "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps)"
)
#: crc32 of a text of code points up to U+00FF, as UTF-8.
CRC = (
    "xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split({0}, ''), "
    "lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END))), "
    "lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"
)

QUERIES = {
    "op11_spelling_variants": op11_spelling_variants,
    "op12_causal_lm": op12_causal_lm,
    "op13_collocations": op13_collocations,
}

SQL = {
    "op11_spelling_variants": f"""WITH RECURSIVE {CRC_TABLE},
    found AS MATERIALIZED (SELECT doc_id, {FOLD.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))")} AS run FROM documents),
    runs AS MATERIALIZED (SELECT doc_id, run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS name FROM found GROUP BY ALL),
    hashed AS MATERIALIZED (SELECT run, n, {CRC.format("name")} AS h FROM runs CROSS JOIN crc),
    v AS MATERIALIZED (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word,
        sum(n)::BIGINT AS n FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
    cut AS (SELECT word, n, unnest(range(length(word))) AS i FROM v),
    without AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM cut),
    pairs AS (SELECT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT a.word, a.n, b.word, b.n FROM without a JOIN v b ON a.rest = b.word
        UNION SELECT b.word, b.n, a.word, a.n FROM without a JOIN v b ON a.rest = b.word),
    tops AS MATERIALIZED (SELECT a AS word, count(*) AS n_near, min((-bn, b)) AS top FROM pairs GROUP BY a),
    near AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top[1] >= 10 * v.n THEN top[2] END AS form,
        CASE WHEN -top[1] >= 10 * v.n THEN -top[1] END AS form_n FROM v LEFT JOIN tops USING (word)),
    chain AS (SELECT word, word AS last FROM near UNION ALL SELECT chain.word, form FROM chain JOIN near ON near.word = last WHERE form IS NOT NULL)
    SELECT near.word, form, last AS root, n, n_near, form_n FROM near JOIN chain USING (word)
    WHERE NOT EXISTS (SELECT 1 FROM near f WHERE f.word = last AND f.form IS NOT NULL)""",
    "op13_collocations": f"""WITH pieces AS MATERIALIZED (SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array({FOLD.format("text")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
    split AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    size AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY 1 HAVING sum(len(w)) > 0),
    runs AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM
        (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS k))),
    f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 30),
    cand AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
    cuts AS (SELECT *, array_to_string(w[1:cut], ' ') AS x, array_to_string(w[cut + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)),
    scored AS (SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS score
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y),
    weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    subs AS (SELECT lang, a, array_to_string(w[i:i + s - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM
        (SELECT *, unnest(range(2, k)) AS s FROM cand WHERE k > 2))),
    covers AS MATERIALIZED (SELECT lang, phrase, max(a) AS longer FROM subs GROUP BY ALL),
    kept AS (SELECT t.* FROM weakest t LEFT JOIN covers c USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
    FROM kept JOIN size USING (lang) QUALIFY rank <= 2000""",
}
