"""Column expressions for cleaning, tokenising and windowing text.

All of them stay inside the JVM and work on one row, so none needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.lexicon import FUSED_FORMS, STOP_WORDS

START, END = "<s>", "</s>"

# Unicode white space as Python's str.isspace() sees it; the regex engines' own \s is ASCII only.
SPACES = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
TAG = r"<[^>]+?>"
URL = rf"https?://[^{SPACES}]+|www\.[^{SPACES}]+"
NOT_LETTERS = r"[^a-z]+"
NOT_LETTERS_DIGITS = r"[^a-z0-9\-]+"
NUMBER_AWARE_TOKEN = r"\b[a-z0-9]+(?:-[a-z0-9]+)*\b"
FUSED = r"\b(?:" + "|".join(f"({a})({b})" for a, b in FUSED_FORMS) + r")\b"
EDGE_SPACES = rf"^[{SPACES}]+|[{SPACES}]+$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable so that ``body`` may use it many times.

    A column used inside another lambda is evaluated again for every element; a
    lambda variable is evaluated once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Drop white space, Unicode white space included, at both ends."""
    return F.regexp_replace(text, EDGE_SPACES, "")


def strip_html(text: Column) -> Column:
    """Replace each tag by a space; null becomes the empty string."""
    known = F.coalesce(text, F.lit(""))
    return F.when(F.contains(known, F.lit("<")), F.regexp_replace(known, TAG, " ")).otherwise(known)


def _without_urls(lower: Column) -> Column:
    """Lower-case text with each URL blanked; only a text that may hold one is searched."""
    may = F.contains(lower, F.lit("http")) | F.contains(lower, F.lit("www."))
    return F.when(may, F.regexp_replace(lower, URL, " ")).otherwise(lower)


def clean_text(text: Column, preserve_numbers: bool = False) -> Column:
    """Lower-case words separated by single blanks, without tags, URLs and symbols.

    Dropping every run of unwanted characters at once equals blanking them one by
    one and then collapsing white space, and saves a pass over the text.
    """
    bare = _without_urls(F.lower(strip_html(text)))
    junk = NOT_LETTERS_DIGITS if preserve_numbers else NOT_LETTERS
    return F.trim(F.regexp_replace(bare, junk, " "))


def tokenize_clean(clean: Column, preserve_numbers: bool = False, split_fused: bool = True) -> Column:
    """Tokens of an already cleaned text."""
    if preserve_numbers:
        return F.regexp_extract_all(clean, F.lit(NUMBER_AWARE_TOKEN), F.lit(0))
    if split_fused:
        pairs = range(len(FUSED_FORMS))
        heads = "".join(f"${2 * i + 1}" for i in pairs)
        tails = "".join(f"${2 * i + 2}" for i in pairs)
        clean = F.regexp_replace(clean, FUSED, f"{heads} {tails}")
    return F.filter(F.split(clean, " "), lambda t: t != "")


def tokenize(text: Column, preserve_numbers: bool = False, split_fused: bool = True, drop_empty: bool = True) -> Column:
    """Clean and tokenise; an empty text gives an empty array.

    Letters only: the text is split where ``clean_text`` would put its blanks, without building that text. That leaves
    an empty word at an end that is no letter; a caller that drops short words anyway needn't have it dropped.
    """
    if preserve_numbers:
        return tokenize_clean(clean_text(text, True), True, split_fused)
    words = F.split(_without_urls(F.lower(strip_html(text))), NOT_LETTERS)
    words = F.filter(words, lambda t: t != "") if drop_empty else words
    return let(words, _split_fused) if split_fused else words


def _split_fused(words: Column) -> Column:
    """Fused words as their two parts, in place."""
    fused = F.create_map(*[x for a, b in FUSED_FORMS for x in (F.lit(a + b), F.array(F.lit(a), F.lit(b)))])
    parts = F.flatten(F.transform(words, lambda t: F.coalesce(F.try_element_at(fused, t), F.array(t))))
    return F.when(F.exists(words, lambda t: t.isin([a + b for a, b in FUSED_FORMS])), parts).otherwise(words)


def remove_stopwords(tokens: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Keep tokens of two or more characters outside the stop list."""
    words = list(STOP_WORDS if stop_words is None else stop_words)
    long_enough = lambda t: F.length(t) > 1
    if not words:
        return F.filter(tokens, long_enough)
    return F.filter(tokens, lambda t: long_enough(t) & ~t.isin(words))


def map_tokens(tokens: Column, mapping: Mapping[str, str]) -> Column:
    """Replace tokens found in a small driver-side mapping.

    Membership is tested by hash; only the tokens to replace pay for the map lookup,
    which scans the map. Use ``lemmatize_tokens`` for a mapping held in a table.
    """
    if not mapping:
        return tokens
    keys = list(mapping)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.transform(tokens, lambda t: F.when(t.isin(keys), F.element_at(table, t)).otherwise(t))


def text_preview(text: Column, words: int = 50) -> Column:
    """The first words, separated by single blanks, and an ellipsis."""
    parts = F.split(strip(text), rf"[{SPACES}]+")
    return F.concat(F.array_join(F.slice(parts, 1, words), " "), F.lit("..."))


# --- windows over a token array -------------------------------------------------------


def pad_tokens(tokens: Column, n: int) -> Column:
    """n-1 start marks in front and one end mark behind."""
    if n < 1:
        raise ValueError(f"n-gram order must be at least 1, got {n}")
    start = F.array_repeat(F.lit(START), n - 1)
    return F.concat(start, tokens, F.array(F.lit(END)))


def normalize_context(context: Column, n: int) -> Column:
    """The last n-1 tokens, padded on the left with start marks."""
    if n < 1:
        raise ValueError(f"n-gram order must be at least 1, got {n}")
    if n == 1:
        return F.slice(context, 1, 0)
    padded = F.concat(F.array_repeat(F.lit(START), n - 1), context)
    return F.slice(padded, -(n - 1), n - 1)


def context_from_text(text: Column) -> Column:
    """White-space separated words of a typed context."""
    return F.filter(F.split(strip(text), rf"[{SPACES}]+"), lambda t: t != "")


def extract_ngrams(tokens: Column, n: int) -> Column:
    """All contiguous n-token slices; empty if there are fewer than n tokens."""
    if n < 1:
        raise ValueError(f"n-gram order must be at least 1, got {n}")

    def slices(bound: Column) -> Column:
        last = F.size(bound) - (n - 1)
        starts = F.sequence(F.lit(1), F.greatest(last, F.lit(1)))
        window = lambda i: F.array(*[F.element_at(bound, i + k) for k in range(n)])
        return F.when(last >= 1, F.transform(starts, window)).otherwise(F.array().cast("array<array<string>>"))

    return let(tokens, slices)


def _starts(size: Column, n: int) -> Column:
    """0-based start positions of all n-token windows; null if there are none."""
    return F.when(size >= n, F.sequence(F.lit(0), size - n))


def ngram_range(tokens: Column, low: int = 1, high: int = 1, separator: str = "_") -> Column:
    """All n-grams for n from low to high, each joined to one string."""
    if low < 1 or high < low:
        raise ValueError(f"invalid n-gram range ({low}, {high})")
    none = F.array().cast("array<string>")

    def joined(n: int) -> Column:
        if n == 1:
            return tokens
        return let(
            tokens,
            lambda t: F.coalesce(
                F.transform(
                    _starts(F.size(t), n),
                    lambda i: F.concat_ws(separator, *[F.get(t, i + k) for k in range(n)]),
                ),
                none,
            ),
        )

    per_n = [joined(n) for n in range(low, high + 1)]
    return per_n[0] if len(per_n) == 1 else F.concat(*per_n)


def context_key(context: Column) -> Column:
    """A context as one string, words separated by a blank; tokens never contain blanks."""
    return F.array_join(context, " ")


def next_word_windows(tokens: Column, n: int) -> Column:
    """One (context, word) struct per predicted position of the padded sentence."""
    return let(
        pad_tokens(tokens, n),
        lambda p: F.transform(
            _starts(F.size(p), n),
            lambda i: F.struct(
                F.concat_ws(" ", *[F.get(p, i + k) for k in range(n - 1)]).alias("context"),
                F.get(p, i + (n - 1)).alias("word"),
            ),
        ),
    )


def padded_windows(tokens: Column, n: int) -> Column:
    """One struct per predicted position of the padded sentence: the word ``back0`` and those before it, ``back1`` on."""
    return let(
        pad_tokens(tokens, n),
        lambda p: F.transform(
            _starts(F.size(p), n), lambda i: F.struct(*[F.get(p, i + (n - 1 - k)).alias(f"back{k}") for k in range(n)])
        ),
    )


def skipgram_pairs(tokens: Column, window: int) -> Column:
    """One (center, context) struct per ordered pair of tokens at most ``window`` apart."""
    if window < 1:
        raise ValueError(f"window must be at least 1, got {window}")

    def pairs(bound: Column) -> Column:
        def apart(distance: int, forward: bool) -> Column:
            def pair(i: Column) -> Column:
                near, far = F.get(bound, i), F.get(bound, i + distance)
                center, context = (near, far) if forward else (far, near)
                return F.struct(center.alias("center"), context.alias("context"))

            none = F.array().cast("array<struct<center:string,context:string>>")
            return F.coalesce(F.transform(_starts(F.size(bound), distance + 1), pair), none)

        return F.concat(*[apart(d, forward) for d in range(1, window + 1) for forward in (True, False)])

    return let(tokens, pairs)


def term_histogram(terms: Column) -> Column:
    """Distinct terms of an array with their counts, without a shuffle.

    Sorts the array and measures the runs of equal terms.
    """

    def counted(ordered: Column) -> Column:
        first = F.filter(
            _starts(F.size(ordered), 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(
            first,
            lambda starts: F.transform(
                starts,
                lambda i, k: F.struct(
                    F.get(ordered, i).alias("term"),
                    (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - i).cast("bigint").alias("cnt"),
                ),
            ),
        )

    return let(F.sort_array(terms), counted)
