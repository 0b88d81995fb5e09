"""Queries for sources, text functions and scalar math."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import inputs as I
from corpusloom.catalog import sql as S
from corpusloom.functions import text as T
from corpusloom.functions import vector as V
from corpusloom.lexicon import LEMMAS, STOP_WORDS
from corpusloom.operators import counts, preprocess, vectors
from corpusloom.plans.lineage import materialize, scratch_path, spread
from corpusloom.sources import corpus, models, vectors as vector_source

md5 = lambda c: F.md5(c.cast("binary"))


# --- sources and sinks ------------------------------------------------------------------


def load_corpus(spark, sf):
    path = scratch_path(spark, "corpus-csv")
    I.documents(spark, sf).select(
        "doc_id", F.concat(F.lit(" "), F.upper("category"), F.lit(" ")).alias("category"), "text"
    ).write.csv(path, header=True, quote='"', escape='"', quoteAll=True)
    loaded = corpus.load_corpus(spark, path, I.LANGS)
    return loaded.select("doc_id", "category", F.length("text").alias("n_chars"), md5(F.col("text")).alias("digest"))


def ingest_text_tree(spark, sf):
    files = I.documents(spark, sf).select(
        F.concat(F.lit("/root/"), "category", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    )
    return corpus.parse_articles(files).select(
        F.col("name").cast("bigint").alias("doc_id"), "category", "title", md5(F.col("text")).alias("digest")
    )


def synth_corpus(spark, sf):
    sizes = I.table(spark, sf, "documents").groupBy(F.col("lang").alias("category")).agg(F.count("*").alias("n"))
    return corpus.synth_corpus(sizes)


def corpus_gate(spark, sf):
    docs = I.table(spark, sf, "documents").select(F.col("lang").alias("category"))
    return corpus.corpus_gate(docs, {c: 100 for c in I.LANGS})


def category_except(spark, sf):
    docs = I.table(spark, sf, "documents").select(F.col("lang").alias("category"))
    return corpus.unknown_categories(docs, ["en", "de", "it"])


def _vector_lines(spark, sf):
    """Vector lines made of the embeddings, between ordinary text that must be skipped."""
    good = I.given_vectors(spark, sf).select(
        F.concat_ws(" ", "word", F.transform("vec", lambda x: x.cast("string"))).alias("value"),
        F.substring("word", 2, 20).cast("bigint").alias("line_no"),
    )
    bad = I.table(spark, sf, "benchmark").select(F.col("text").alias("value"), (F.col("item_id") + 10_000_000).alias("line_no"))
    return good.unionByName(bad)


def read_word_vectors(spark, sf):
    wanted = I.table(spark, sf, "labels").select(F.concat(F.lit("w"), F.col("doc_id").cast("string")).alias("term"))
    found = vector_source.parse_word_vectors(_vector_lines(spark, sf), wanted)
    return found.select("word", F.posexplode("vec").alias("dim", "value")).select(
        "word", F.col("dim").cast("bigint").alias("dim"), I.r6(F.col("value").cast("double"), "value")
    )


def target_vocab(spark, sf):
    return vector_source.target_vocab(spark, None, I.tokens(spark, sf))


def random_vectors(spark, sf):
    vocab = materialize(counts.vocab_union(I.tokens(spark, sf)), "vocab")
    found = vector_source.random_vectors(vocab)
    return found.select("word", I.r6(F.get("vec", 0), "first"), I.r6(I.weighted_sum(F.col("vec")), "components"))


def save_model(spark, sf):
    path = scratch_path(spark, "saved-idf")
    models.save_idf(*counts.idf_table(I.tokens(spark, sf)), path)
    idf, default = models.load_idf(spark, path)
    return idf.select("term", "df", I.r6(F.col("idf"), "idf"), F.round(F.lit(default), 6).alias("default_idf"))


# --- text functions -----------------------------------------------------------------------


def strip_html(spark, sf):
    pages = spread(I.table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", md5(T.strip_html(F.col("html"))).alias("digest"))


def clean_text_a(spark, sf):
    return I.documents(spark, sf).select("doc_id", T.clean_text(F.col("text")).alias("clean"))


def clean_text_b(spark, sf):
    pages = spread(I.table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", T.clean_text(F.col("html"), True).alias("clean"))


def _token_rows(frame, column, key="doc_id"):
    return frame.select(key, F.posexplode(column).alias("pos", "token")).select(
        key, F.col("pos").cast("bigint").alias("pos"), "token"
    )


def tokenize_a(spark, sf):
    return _token_rows(I.documents(spark, sf), T.tokenize(F.col("text")))


def tokenize_b(spark, sf):
    return _token_rows(I.documents(spark, sf), T.tokenize(F.col("text"), True))


def remove_stopwords(spark, sf):
    return _token_rows(I.documents(spark, sf), T.remove_stopwords(T.tokenize(F.col("text"))))


def lemmatize(spark, sf):
    plain = preprocess.TextConfig(lemmatize=False)
    table = spark.createDataFrame(list(LEMMAS), "token string, pos string, lemma string")
    docs = preprocess.preprocess(I.documents(spark, sf), plain, None)
    return _token_rows(preprocess.lemmatize_tokens(docs, table), F.col("tokens"))


def preprocess_text(spark, sf):
    docs = preprocess.preprocess(I.documents(spark, sf), as_text=True)
    return docs.select("doc_id", F.col("tokens").alias("text"))


def pad_tokens(spark, sf):
    return _token_rows(I.conversation_tokens(spark, sf), T.pad_tokens(F.col("tokens"), 3))


def normalize_context(spark, sf):
    turns = I.table(spark, sf, "conversations").select("conv_id", "turn", T.context_from_text(F.col("text")).alias("c"))
    return turns.select("conv_id", "turn", F.array_join(T.normalize_context(F.col("c"), 4), " ").alias("context"))


def extract_ngrams(spark, sf):
    grams = I.tokens(spark, sf).select(F.explode(T.extract_ngrams(F.col("tokens"), 3)).alias("g"))
    return grams.groupBy(F.array_join("g", " ").alias("ngram")).agg(F.count("*").alias("n"))


def extract_ngram_range(spark, sf):
    grams = I.tokens(spark, sf).select(F.explode(T.ngram_range(F.col("tokens"), 1, 2)).alias("ngram"))
    return grams.groupBy("ngram").agg(F.count("*").alias("n"))


def sliding_ngrams(spark, sf):
    each = I.conversation_tokens(spark, sf).select("doc_id", F.posexplode(T.next_word_windows(F.col("tokens"), 3)).alias("pos", "w"))
    return each.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "w.context", "w.word")


def text_preview(spark, sf):
    return I.documents(spark, sf).select("doc_id", T.text_preview(F.col("text")).alias("preview"))


def _status(spark, sf):
    corpus_tokens = materialize(I.tokens(spark, sf), "tokens")
    frequent = counts.term_totals(corpus_tokens).where(F.col("cnt") >= 5).select("term")
    held = counts.vocab_union(I.benchmark_tokens(spark, sf))
    return preprocess.input_status(I.documents(spark, sf), [frequent, held], config=preprocess.TextConfig())


def doc_stats(spark, sf):
    return _status(spark, sf).select(
        "doc_id", "n_chars", "n_tokens", "covered_1", "covered_2",
        I.r6(F.col("percent_1"), "percent_1"), I.r6(F.col("percent_2"), "percent_2"), "all_oov",
    )


def explicit_input_guards(spark, sf):
    """Turns, page addresses and source names as typed inputs: known, token-free and unknown ones."""
    turns = I.table(spark, sf, "conversations").select(
        F.lit("turn").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text"
    )
    urls = I.table(spark, sf, "pages").select(F.lit("url").alias("kind"), F.col("page_id").alias("doc_id"), F.col("url").alias("text"))
    names = I.table(spark, sf, "documents").select(F.lit("source").alias("kind"), "doc_id", F.col("source").alias("text"))
    typed = turns.unionByName(urls).unionByName(names)
    keyed = typed.select(F.concat_ws(":", "kind", F.col("doc_id").cast("string")).alias("doc_id"), "text")
    vocab = counts.vocab_union(I.benchmark_tokens(spark, sf))
    return preprocess.input_status(keyed, [vocab], config=preprocess.TextConfig()).select("doc_id", "n_tokens", "status")


# --- scalar math ----------------------------------------------------------------------------


def sigmoid(spark, sf):
    values = I.given_vectors(spark, sf).select("word", F.posexplode("vec").alias("dim", "x"))
    x = F.col("x").cast("double") * 1000
    return values.select("word", F.col("dim").cast("bigint").alias("dim"), I.r6(V.sigmoid(x), "p"))


def logsumexp(spark, sf):
    return I.given_vectors(spark, sf).select(
        "word", I.r6(V.logsumexp(F.transform("vec", lambda x: x.cast("double") * 700)), "lse")
    )


def prob_normalize(spark, sf):
    scores = F.transform("vec", lambda x: V.sigmoid(x.cast("double") * 10))
    entries = F.posexplode(V.normalize_sum(scores)).alias("dim", "p")
    return I.given_vectors(spark, sf).select("word", entries).select("word", F.col("dim").cast("bigint").alias("dim"), I.r6(F.col("p"), "p"))


def l2_normalize(spark, sf):
    from corpusloom.operators import tfidf

    values = counts.term_counts(I.tokens(spark, sf)).select("doc_id", "term", F.col("cnt").cast("double").alias("value"))
    return tfidf.l2_normalize(values).select("doc_id", "term", I.r6(F.col("value"), "value"))


def cosine_similarity(spark, sf):
    given = I.table(spark, sf, "embeddings").select("vec_id", "embedding")
    nxt = given.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return given.join(nxt, "vec_id").select("vec_id", I.r6(V.cosine_similarity(F.col("embedding"), F.col("other")), "cosine"))


def get_embedding(spark, sf):
    table = I.word_vectors(spark, sf, I.tokens(spark, sf))
    words = I.table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("word")).distinct()
    found = vectors.get_embedding(words, table, fold_case=True)
    return found.select("word", I.r6(F.get("vec", 0).cast("double"), "first"), I.r6(I.weighted_sum(F.col("vec")), "components"))


QUERIES = {
    "load_corpus": load_corpus,
    "ingest_text_tree": ingest_text_tree,
    "synth_corpus": synth_corpus,
    "corpus_gate": corpus_gate,
    "category_except": category_except,
    "read_word_vectors": read_word_vectors,
    "target_vocab": target_vocab,
    "random_vectors": random_vectors,
    "save_model": save_model,
    "strip_html": strip_html,
    "clean_text_a": clean_text_a,
    "clean_text_b": clean_text_b,
    "tokenize_a": tokenize_a,
    "tokenize_b": tokenize_b,
    "remove_stopwords": remove_stopwords,
    "lemmatize": lemmatize,
    "preprocess": preprocess_text,
    "pad_tokens": pad_tokens,
    "normalize_context": normalize_context,
    "extract_ngrams": extract_ngrams,
    "extract_ngram_range": extract_ngram_range,
    "sliding_ngrams": sliding_ngrams,
    "text_preview": text_preview,
    "doc_stats": doc_stats,
    "explicit_input_guards": explicit_input_guards,
    "sigmoid": sigmoid,
    "logsumexp": logsumexp,
    "prob_normalize": prob_normalize,
    "l2_normalize": l2_normalize,
    "cosine_similarity": cosine_similarity,
    "get_embedding": get_embedding,
}


def _rows(tokens: str, source: str = "documents", key: str = "doc_id") -> str:
    return (
        f"SELECT {key}, (unnest(generate_series(1, len(tokens))) - 1)::BIGINT AS pos, unnest(tokens) AS token "
        f"FROM (SELECT {key}, {tokens} AS tokens FROM {source})"
    )


_LINES = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
_TEMPLATES = ", ".join(f"({i}, {S.quote(t)}, {S.quote(x)})" for i, (t, x) in enumerate(corpus.TEMPLATES))
_COVERED = (
    "SELECT d.doc_id, n_chars, n_tokens, coalesce(c1, 0)::BIGINT AS covered_1, coalesce(c2, 0)::BIGINT AS covered_2, "
    f"{S.r6('coalesce(100.0 * c1 / nullif(n_tokens, 0), 0)::DOUBLE')} AS percent_1, "
    f"{S.r6('coalesce(100.0 * c2 / nullif(n_tokens, 0), 0)::DOUBLE')} AS percent_2, "
    "n_tokens > 0 AND coalesce(c1, 0) + coalesce(c2, 0) = 0 AS all_oov "
    f"FROM (SELECT documents.doc_id, len({S.strip('text')})::BIGINT AS n_chars, len(tokens)::BIGINT AS n_tokens FROM documents JOIN tok USING (doc_id)) d "
    "LEFT JOIN (SELECT doc_id, sum(cnt) FILTER (WHERE term IN (SELECT term FROM freq)) AS c1, "
    "sum(cnt) FILTER (WHERE term IN (SELECT term FROM held)) AS c2 FROM tf GROUP BY 1) c USING (doc_id)"
)

SQL = {
    "load_corpus": f"SELECT doc_id, lang AS category, len({S.strip('text')})::INTEGER AS n_chars, md5({S.strip('text')}) AS digest "
    f"FROM documents WHERE len({S.strip('text')}) > 0",
    "ingest_text_tree": f"""WITH l AS (SELECT doc_id, lang AS category, list_filter(list_transform(regexp_split_to_array(text, '{_LINES}'),
        lambda x: {S.strip('x')}), lambda x: len(x) > 0) AS ls FROM documents)
        SELECT doc_id, category, ls[1] AS title, md5(CASE WHEN len(ls) > 1 THEN array_to_string(ls[2:], ' ') ELSE ls[1] END) AS digest
        FROM l WHERE len(ls) > 0""",
    "synth_corpus": f"""WITH c AS (SELECT lang AS category, count(*) AS n FROM documents GROUP BY 1),
        e AS (SELECT category, unnest(generate_series(0, n - 1)) AS i FROM c),
        t(k, title, text) AS (VALUES {_TEMPLATES})
        SELECT row_number() OVER (ORDER BY category, i) - 1 AS doc_id, category, title || ' (Part ' || (i + 1) || ')' AS title,
        text || ' Filed under ' || upper(substr(category, 1, 3)) || '-' || printf('%04d', i + 1)
        || ' for later reading.' AS text FROM e JOIN t ON k = i % 3""",
    "corpus_gate": f"""WITH f AS (SELECT lang AS category, count(*) AS found FROM documents GROUP BY 1),
        w AS (SELECT category, 100 AS expected FROM (VALUES {S.LANG_VALUES}) v(category)),
        b AS (SELECT coalesce(f.category, w.category) AS category, coalesce(found, 0) AS found, coalesce(expected, 0)::BIGINT AS expected
        FROM f FULL JOIN w ON f.category = w.category)
        SELECT category, found, expected, (SELECT sum(found) = sum(expected) AND bool_and((found > 0) = (expected > 0)) FROM b) AS accepted FROM b""",
    "category_except": "SELECT lang AS category FROM documents EXCEPT SELECT unnest(['en', 'de', 'it'])",
    "read_word_vectors": f"SELECT 'w' || vec_id AS word, (unnest(generate_series(1, len(embedding))) - 1)::BIGINT AS dim, "
    f"{S.r6('unnest(embedding)::DOUBLE')} AS value FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels)",
    "target_vocab": S.query("tf", "SELECT DISTINCT term FROM tf"),
    "random_vectors": S.query(
        "tok",
        f"SELECT term AS word, {S.r6('3 * max(x) FILTER (WHERE k = 1) / sqrt(sum(x * x))')} AS first, "
        f"{S.r6('3 * sum(x * k) / sqrt(sum(x * x))')} AS components FROM g GROUP BY term",
        "w AS (SELECT DISTINCT unnest(tokens) AS term FROM tok)",
        "h AS (SELECT term, k, md5('42:' || term || ':' || k) AS d FROM w CROSS JOIN (SELECT unnest(generate_series(1, 100)) AS k))",
        "g AS (SELECT term, k, sqrt(-2 * ln((('0x' || substr(d, 1, 8))::BIGINT + 1) / 4294967297.0::DOUBLE)) "
        "* cos((('0x' || substr(d, 9, 8))::BIGINT + 1) / 4294967297.0::DOUBLE * 2 * pi()) AS x FROM h)",
    ),
    "save_model": S.query(
        "tf",
        f"SELECT term, count(*) AS df, {S.r6('ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1)) + 1')} AS idf, "
        f"{S.r6('ln((SELECT count(*) FROM documents) + 1.0::DOUBLE) + 1')} AS default_idf FROM tf GROUP BY term",
    ),
    "strip_html": f"SELECT page_id, md5({S.strip_html('html')}) AS digest FROM pages",
    "clean_text_a": f"SELECT doc_id, {S.clean('text')} AS clean FROM documents",
    "clean_text_b": f"SELECT page_id, {S.clean('html', True)} AS clean FROM pages",
    "tokenize_a": _rows(S.tokens_a("text")),
    "tokenize_b": _rows(S.tokens_b("text")),
    "remove_stopwords": _rows(S.drop_stops(S.tokens_a("text"))),
    "lemmatize": _rows(S.full("text")),
    "preprocess": S.query("tok", "SELECT doc_id, array_to_string(tokens, ' ') AS text FROM tok"),
    "pad_tokens": S.query("turns", _rows("list_concat(list_concat(['<s>', '<s>'], tokens), ['</s>'])", "turns")),
    "normalize_context": f"""WITH c AS (SELECT conv_id, turn, list_filter(regexp_split_to_array({S.strip('text')}, '[{T.SPACES}]+'), lambda t: t <> '') AS ws FROM conversations)
        SELECT conv_id, turn, array_to_string(list_concat(['<s>', '<s>', '<s>'], ws)[-3:], ' ') AS context FROM c""",
    "extract_ngrams": S.query(
        "tok",
        "SELECT t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] AS ngram, count(*) AS n FROM "
        "(SELECT tokens AS t, unnest(generate_series(1, len(tokens) - 2)) AS i FROM tok) GROUP BY 1",
    ),
    "extract_ngram_range": S.query(
        "tok",
        "SELECT ngram, count(*) AS n FROM (SELECT unnest(tokens) AS ngram FROM tok UNION ALL SELECT t[i] || '_' || t[i + 1] FROM "
        "(SELECT tokens AS t, unnest(generate_series(1, len(tokens) - 1)) AS i FROM tok)) GROUP BY 1",
    ),
    "sliding_ngrams": S.query(
        "turns",
        "SELECT doc_id, (pos - 1)::BIGINT AS pos, context, word FROM grams UNION ALL "
        "SELECT doc_id, 0, '<s> <s>', '</s>' FROM turns WHERE len(tokens) = 0",
        S.bigrams("turns", n=3),
    ),
    "text_preview": f"SELECT doc_id, array_to_string(regexp_split_to_array({S.strip('text')}, '[{T.SPACES}]+')[1:50], ' ') || '...' AS preview FROM documents",
    "doc_stats": S.query(
        "tf bench", _COVERED,
        "freq AS (SELECT term FROM tf GROUP BY term HAVING sum(cnt) >= 5)",
        "held AS (SELECT DISTINCT unnest(tokens) AS term FROM bench)",
    ),
    "explicit_input_guards": S.query(
        "bench",
        f"SELECT doc_id, len(tokens)::BIGINT AS n_tokens, CASE WHEN len({S.strip('text')}) = 0 THEN 'empty' WHEN len(tokens) = 0 THEN 'no_tokens' "
        "WHEN NOT list_has_any(tokens, terms) THEN 'oov' ELSE 'ok' END AS status FROM g CROSS JOIN held",
        "held AS (SELECT list(DISTINCT term) AS terms FROM (SELECT unnest(tokens) AS term FROM bench))",
"e AS (SELECT 'turn:' || (conv_id * 1000 + turn) AS doc_id, text FROM conversations UNION ALL SELECT 'url:' || page_id, url FROM pages "
        "UNION ALL SELECT 'source:' || doc_id, source FROM documents)",
        f"g AS (SELECT doc_id, text, {S.full('text')} AS tokens FROM e)",
    ),
    "sigmoid": f"SELECT 'w' || vec_id AS word, dim, {S.r6('1 / (1 + exp(-greatest(least(x * 1000, 250), -250)))')} AS p FROM "
    "(SELECT vec_id, (unnest(generate_series(1, 64)) - 1)::BIGINT AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)",
    "logsumexp": f"SELECT 'w' || vec_id AS word, {S.r6('m + ln(sum(exp(x - m)))')} AS lse FROM (SELECT vec_id, x, max(x) OVER (PARTITION BY vec_id) AS m "
    "FROM (SELECT vec_id, unnest(embedding)::DOUBLE * 700 AS x FROM embeddings)) GROUP BY vec_id, m",
    "prob_normalize": f"SELECT 'w' || vec_id AS word, dim, {S.r6('s / sum(s) OVER (PARTITION BY vec_id)')} AS p FROM (SELECT vec_id, dim, 1 / (1 + exp(-10 * x)) AS s FROM "
    "(SELECT vec_id, (unnest(generate_series(1, 64)) - 1)::BIGINT AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings))",
    "l2_normalize": S.query("tf", f"SELECT doc_id, term, {S.r6('cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY doc_id))')} AS value FROM tf"),
    "cosine_similarity": f"SELECT a.vec_id, {S.r6('list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])')} AS cosine "
    "FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "get_embedding": S.query(
        "vectors", f"SELECT w.word, {S.r6('vec[1]')} AS first, {S.r6(S.weighted_sum('vec'))} AS components FROM (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM documents) w "
        "LEFT JOIN vectors v ON v.word = lower(w.word)",
    ),
}
