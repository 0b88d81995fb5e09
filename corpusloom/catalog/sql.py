"""DuckDB building blocks shared by the oracle queries, in the order of the published steps."""

from __future__ import annotations

from corpusloom.catalog.inputs import LANGS
from corpusloom.functions import text as T
from corpusloom.lexicon import FUSED_FORMS, STOP_WORDS
from corpusloom.operators.preprocess import default_lemmas


def quote(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def r6(x: str) -> str:
    """Six decimals without a negative zero."""
    return f"(round({x}, 6) + 0.0)"


def weighted_sum(vec: str) -> str:
    """The sum of i times component i, from 1."""
    return f"list_sum(list_transform({vec}, lambda x, i: x * i))"


STOPS = "[" + ", ".join(map(quote, STOP_WORDS)) + "]"
LEMMAS = "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in default_lemmas().items()) + "}"
LANG_VALUES = ", ".join(f"({quote(c)})" for c in LANGS)
EDGE = rf"'^[{T.SPACES}]+|[{T.SPACES}]+$'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {EDGE}, '', 'g')"


def strip_html(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '<[^>]+?>', ' ', 'g')"


def clean(x: str, numbers: bool = False) -> str:
    keep = r"[^a-z0-9\-\s]" if numbers else r"[^a-z\s]"
    bare = f"regexp_replace(lower({strip_html(x)}), '{T.URL}', ' ', 'g')"
    return rf"trim(regexp_replace(regexp_replace({bare}, '{keep}', ' ', 'g'), '\s+', ' ', 'g'))"


def split_words(cleaned: str) -> str:
    out = cleaned
    for a, b in FUSED_FORMS:
        out = rf"regexp_replace({out}, '\b({a})({b})\b', '\1 \2', 'g')"
    return f"list_filter(string_split({out}, ' '), lambda t: t <> '')"


def tokens_a(x: str) -> str:
    return split_words(clean(x))


def tokens_b(x: str) -> str:
    return rf"regexp_extract_all({clean(x, True)}, '\b[a-z0-9]+(?:-[a-z0-9]+)*\b')"


def drop_stops(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: len(t) > 1 AND NOT list_contains({STOPS}, t))"


def lemmas(tokens: str) -> str:
    return f"list_transform({tokens}, lambda t: coalesce({LEMMAS}[t], t))"


def full(x: str) -> str:
    """Default preprocessing of a text expression."""
    return lemmas(drop_stops(tokens_a(x)))


TOK = f"tok AS MATERIALIZED (SELECT doc_id, lang AS category, {full('text')} AS tokens FROM documents)"
BENCH = f"bench AS MATERIALIZED (SELECT item_id AS doc_id, {full('text')} AS tokens FROM benchmark)"
TURNS = f"turns AS MATERIALIZED (SELECT conv_id * 1000 + turn AS doc_id, {full('text')} AS tokens FROM conversations)"
EACH = "each_token AS (SELECT doc_id, category, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM tok)"
TF = "tf AS MATERIALIZED (SELECT doc_id, category, term, count(*) AS cnt FROM each_token GROUP BY ALL)"
VOCAB = "vocab AS MATERIALIZED (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM (SELECT DISTINCT term FROM tf))"

SPLIT = """sizes AS (SELECT lang AS category, count(*) AS n FROM documents GROUP BY 1),
want AS (SELECT ceil(sum(n) * 0.2::DECIMAL(3,1))::BIGINT AS want, sum(n) AS total FROM sizes),
share AS (SELECT category, n, n * want / total::DOUBLE AS exact, want FROM sizes, want),
take AS (SELECT category, floor(exact)::BIGINT + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, category)
    <= want - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS n_test FROM share),
split AS MATERIALIZED (SELECT doc_id, d.category, CASE WHEN row_number() OVER (PARTITION BY d.category
    ORDER BY md5('42:' || doc_id), doc_id) <= n_test THEN 'test' ELSE 'train' END AS split
    FROM (SELECT doc_id, lang AS category FROM documents) d JOIN take USING (category))"""

VECTORS = """given AS (SELECT vec_id, embedding::DOUBLE[] AS vec FROM embeddings),
vectors AS MATERIALIZED (SELECT term AS word, vec FROM vocab JOIN given ON vec_id = idx % (SELECT count(*) FROM given))"""

CTES = {"tok": TOK, "bench": BENCH, "turns": TURNS, "each": EACH, "tf": TF, "vocab": VOCAB, "split": SPLIT, "vectors": VECTORS}
NEEDS = {"each": ["tok"], "tf": ["each"], "vocab": ["tf"], "vectors": ["vocab"]}


def query(ctes: str, body: str, *more: str) -> str:
    """``WITH`` the named shared tables, then further ones, then the body."""
    names: list[str] = []

    def need(name: str) -> None:
        for n in NEEDS.get(name, []):
            need(n)
        if name not in names:
            names.append(name)

    for name in ctes.split():
        need(name)
    parts = [CTES[n] for n in names] + list(more)
    return f"WITH {', '.join(parts)} {body}" if parts else body


def bigrams(source: str, name: str = "grams", n: int = 2) -> str:
    """Padded windows ``(doc_id, pos, context, word)`` of the sequences of ``source``."""
    pad = "[" + ", ".join(["'<s>'"] * (n - 1)) + "]"
    padded = f"list_concat(list_concat({pad}::VARCHAR[], tokens), ['</s>'])"
    return (
        f"{name} AS MATERIALIZED (SELECT doc_id, i AS pos, array_to_string(p[i:i + {n - 2}], ' ') AS context, p[i + {n - 1}] AS word "
        f"FROM (SELECT doc_id, p, unnest(generate_series(1, len(p) - {n - 1})) AS i FROM "
        f"(SELECT doc_id, {padded} AS p FROM {source} WHERE len(tokens) > 0)))"
    )


LM = (
    bigrams("tok"),
    "lm AS MATERIALIZED (SELECT context, word, count(*) AS cnt FROM grams GROUP BY ALL)",
    "ctx AS MATERIALIZED (SELECT context, sum(cnt)::BIGINT AS total FROM lm GROUP BY ALL)",
    "words AS MATERIALIZED (SELECT DISTINCT unnest(list_concat(['<s>', '</s>'], tokens)) AS word FROM tok WHERE len(tokens) > 0)",
)

NB = (
    "train AS (SELECT tf.* FROM tf JOIN split USING (doc_id) WHERE split = 'train')",
    "priors AS (SELECT category, count(*) AS n_docs, count(*) / sum(count(*)) OVER ()::DOUBLE AS prior FROM split WHERE split = 'train' GROUP BY 1)",
    "voc AS (SELECT DISTINCT term FROM train)",
    "cw AS (SELECT category, term, sum(cnt) AS cnt FROM train GROUP BY ALL)",
    "tot AS (SELECT category, sum(cnt) AS total FROM cw GROUP BY 1)",
    "nb AS MATERIALIZED (SELECT p.category, v.term, coalesce(cw.cnt, 0)::BIGINT AS cnt, "
    "ln(coalesce(cw.cnt, 0) + 1.0::DOUBLE) - ln(total + (SELECT count(*) FROM voc)::DOUBLE) AS log_prob "
    "FROM priors p CROSS JOIN voc v JOIN tot USING (category) LEFT JOIN cw ON cw.category = p.category AND cw.term = v.term)",
    "test_tf AS (SELECT tf.* FROM tf JOIN split USING (doc_id) WHERE split = 'test')",
    "sums AS (SELECT doc_id, nb.category, sum(t.cnt * log_prob) AS s FROM test_tf t JOIN nb USING (term) GROUP BY ALL)",
    "scores AS MATERIALIZED (SELECT d.doc_id, p.category, ln(prior) + coalesce(s, 0) AS score "
    "FROM (SELECT doc_id FROM split WHERE split = 'test') d CROSS JOIN priors p LEFT JOIN sums ON sums.doc_id = d.doc_id AND sums.category = p.category)",
    "probs AS (SELECT doc_id, category, score, exp(score - max(score) OVER (PARTITION BY doc_id)) AS e FROM scores)",
    "post AS (SELECT doc_id, category, score, e / sum(e) OVER (PARTITION BY doc_id) AS probability FROM probs)",
    "best AS (SELECT doc_id, category AS predicted FROM scores QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, category) = 1)",
)


def tfidf(low: int, high: int, min_df: int, cap: int) -> tuple[str, ...]:
    """Features fitted on the training documents: ``fitted`` and ``feats`` for all documents."""
    parts = []
    if low <= 1:
        parts.append("SELECT doc_id, unnest(tokens) AS term FROM tok")
    if high >= 2:
        parts.append(
            "SELECT doc_id, t[i] || '_' || t[i + 1] AS term FROM (SELECT doc_id, tokens AS t, "
            "unnest(generate_series(1, len(tokens) - 1)) AS i FROM tok)"
        )
    return (
        f"grams AS ({' UNION ALL '.join(parts)})",
        "gtf AS MATERIALIZED (SELECT doc_id, term, count(*) AS cnt FROM grams GROUP BY ALL)",
        "dfs AS (SELECT term, count(*) AS df FROM gtf JOIN split USING (doc_id) WHERE split = 'train' GROUP BY 1)",
        f"kept AS (SELECT term, df FROM dfs WHERE df >= {min_df} ORDER BY df DESC, term LIMIT {cap})",
        "fitted AS MATERIALIZED (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS idx, "
        "ln(((SELECT count(*) FROM split WHERE split = 'train') + 1.0::DOUBLE) / (df + 1)) + 1 AS idf FROM kept)",
        "feats AS MATERIALIZED (SELECT doc_id, term, idx, cnt * idf / sqrt(sum(cnt * idf * cnt * idf) OVER (PARTITION BY doc_id)) AS value "
        "FROM gtf JOIN fitted USING (term))",
    )


WEIGHT = "(('0x' || substr(md5(category || ':' || term), 1, 8))::BIGINT::DOUBLE / 4294967296.0 - 0.5)"

HASH_SCORES = (
    f"langs AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS i FROM (VALUES {LANG_VALUES}) v(category))",
    f"wts AS MATERIALIZED (SELECT category, term, idx, {WEIGHT} AS weight FROM fitted CROSS JOIN langs)",
    "zs AS (SELECT doc_id, category, sum(value * weight) AS z FROM feats JOIN wts USING (term) GROUP BY ALL)",
    "sig AS MATERIALIZED (SELECT d.doc_id, l.category, 1 / (1 + exp(-(coalesce(z, 0) - 0.5::DOUBLE + 0.1::DOUBLE * i))) AS s "
    "FROM (SELECT doc_id FROM split WHERE split = 'test') d CROSS JOIN langs l LEFT JOIN zs ON zs.doc_id = d.doc_id AND zs.category = l.category)",
    "ovr AS MATERIALIZED (SELECT doc_id, category, s, s / sum(s) OVER (PARTITION BY doc_id) AS probability FROM sig)",
    "pick AS MATERIALIZED (SELECT doc_id, category AS predicted FROM ovr QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, category) = 1)",
)


def noisy(salt: str, name: str = "pairs") -> str:
    """The noisy predictions as ``(doc_id, actual, predicted)``."""
    number = f"('0x' || substr(md5('{salt}' || doc_id), 1, 8))::BIGINT"
    langs = "[" + ", ".join(map(quote, LANGS)) + "]"
    return (
        f"{name} AS MATERIALIZED (SELECT doc_id, lang AS actual, CASE WHEN {number} % 5 = 0 "
        f"THEN {langs}[(({number} // 5) % 4) + 1] ELSE lang END AS predicted FROM documents)"
    )


METRICS = (
    f"langs AS (SELECT category FROM (VALUES {LANG_VALUES}) v(category))",
    "pc AS (SELECT category, count(*) FILTER (WHERE actual = category AND predicted = category)::DOUBLE AS tp, "
    "count(*) FILTER (WHERE predicted = category)::DOUBLE AS said, count(*) FILTER (WHERE actual = category) AS support "
    "FROM pairs CROSS JOIN langs GROUP BY 1)",
    "prf AS (SELECT category, coalesce(tp / nullif(said, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r, support, tp FROM pc)",
    "f1s AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM prf)",
    "summary AS (SELECT round(sum(tp) / (SELECT count(*) FROM pairs), 4) AS accuracy, round(avg(p), 4) AS macro_precision, "
    "round(avg(r), 4) AS macro_recall, round(avg(f), 4) AS macro_f1, round(sum(round(f, 4) * support) / sum(support), 4) AS weighted_f1 FROM f1s)",
)
