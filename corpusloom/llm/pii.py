"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier decides.

Four kinds have a definite form (e-mail, IP address, payment card, international phone number) and
are found by pattern and validation alone. Further candidates have no proof of their own: long
mixed tokens (``secret``), phone numbers without a country code, and card-shaped numbers that fail
their checksum. Regex, gazetteer and context labelers vote on each. Expectation-maximisation over
the counts of vote patterns (a few hundred rows, whatever the corpus) estimates how reliable
each labeler is for each kind, without any labels; its posteriors are the soft labels for a
logistic regression over the votes and the shape of the span, which makes the final decision.

Everything on the rows is a DataFrame expression. A text is split at the matches of a pattern, so
that piece lengths give the positions, in code points, end exclusive. A null text is empty. A
candidate that touches a definite span is dropped. Repeated rows are treated alike; without
candidates no model is needed and only definite spans are returned; further columns are kept
by ``redact`` and ignored elsewhere. Patterns take linear time on texts without blanks, too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.lineage import bounded_rows, materialize

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns, rewritten to start only where a match may start and to keep no way back.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
CANDIDATES = {
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+",
    "phone": r"(?<![0-9+()-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])",
}
#: Words that announce a kind, and beginnings of well-known issuers, keys and numbers.
CONTEXT = {
    "secret": "token|secret|api|key|password|passwd|bearer|auth|credential",
    "phone": "phone|tel|telephone|call|mobile|fax|cell|contact",
    "card": "card|visa|mastercard|amex|credit|debit|payment|iban|account",
}
GAZETTEER = {
    "secret": r"^(?:sk_|pk_|ghp_|gho_|AKIA|ASIA|xox[abp]-|eyJ)",
    "phone": r"^\(?(?:555|800|888|877|866|900)",
    "card": r"^(?:4|5[1-5]|3[47]|6011|65)",
}
SHAPE = {
    "secret": r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$",
    "phone": r"^(?:\([0-9]{3}\) [0-9]{3}-[0-9]{4}|[0-9]{3}([.-])[0-9]{3}\1[0-9]{4})$",
    "card": r"^(?:[0-9]{15,16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$",
}
VOTES = ("shape", "listed", "context", "quoted", "assigned")
TRAITS = ("length", "digits", "upper")


def bound(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def running(items: Column, start, step, first: Column) -> Column:
    """States after slices of about the square root of all items; ``start`` makes a slice's first state.

    ``start`` takes the position reached (``first`` at the beginning) and the slice. Within a slice ``step`` may
    copy what its state has gathered; so the copying isn't quadratic in the items.
    """

    def over(all_: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(all_))).cast("int")
        slices = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / width).cast("int")), lambda k: F.slice(all_, k * width + 1, width))
        empty = F.filter(F.array(start(first, all_)), lambda s: F.lit(False))

        def onward(states: Column, part: Column) -> Column:
            at = F.coalesce(F.get(states, F.size(states) - 1)["at"], first)
            return F.concat(states, F.array(F.aggregate(part, start(at, part), step)))

        return F.when(F.size(all_) > 0, F.aggregate(slices, empty, onward)).otherwise(empty)

    return bound(items, over)


def matches(text: Column, pattern: str) -> Column:
    """All matches as array<struct<start, end, found, before>>.

    ``before`` is what the labelers see as context: the last 40 characters between the match before and this one.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    none = F.expr("cast(array() as array<struct<start:int,end:int,found:string,before:string>>)")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["pieces"])
        end = start + F.length(pair["found"])
        before = F.lower(F.right(pair["pieces"], F.lit(40)))
        one = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found"), before.alias("before"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    pairs = F.slice(F.arrays_zip(pieces.alias("pieces"), found.alias("found")), F.lit(1), F.size(found))
    states = running(pairs, lambda at, part: F.struct(at.alias("at"), none.alias("out")), step, F.lit(0))
    return F.flatten(F.transform(states, lambda s: s["out"]))


def luhn(text: Column) -> Column:
    """Whether the digits of a string pass the Luhn check."""
    digits = F.transform(F.split(F.reverse(F.regexp_replace(text, "[^0-9]", "")), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def n_digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^0-9]", ""))


def definite(text: Column, kind: str) -> Column:
    """Valid spans of one of the definite kinds, as array<struct<start, end, kind>>."""
    ok = {
        "email": lambda m: F.lit(True),
        "ip": lambda m: m["found"].rlike(IP_PARTS),
        "card": lambda m: luhn(m["found"]),
        "phone": lambda m: n_digits(m["found"]).between(10, 15),
    }[kind]
    spans = F.transform(
        F.filter(matches(text, PATTERNS[kind]), ok),
        lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")),
    )
    # Each kind needs a character that most texts lack.
    needs = {"email": "@", "phone": "+"}.get(kind)
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")
    return F.when(F.contains(text, F.lit(needs)), spans).otherwise(none) if needs else F.coalesce(spans, none)


def labelled(m: Column, kind: str) -> Column:
    """A candidate with the votes of its labelers and its traits."""
    found, before = m["found"], m["before"]
    votes = {
        "shape": found.rlike(SHAPE[kind]),
        "listed": found.rlike(GAZETTEER[kind]),
        "context": before.rlike(rf"\b(?:{CONTEXT[kind]})\b"),
        "quoted": before.rlike("[\"'`]$"),
        "assigned": before.rlike("[=:][ \"'`]*$"),
    }
    size = F.length(found)
    traits = {
        "length": F.least(size, F.lit(64)) / 64.0,
        "digits": n_digits(found) / size,
        "upper": F.length(F.regexp_replace(found, "[^A-Z]", "")) / size,
    }
    return F.struct(
        m["start"].alias("start"),
        F.lit(10 + list(CANDIDATES).index(kind)).alias("rank"),
        m["end"].alias("end"),
        F.lit(kind).alias("kind"),
        *[v.cast("int").alias(k) for k, v in votes.items()],
        *[v.cast("double").alias(k) for k, v in traits.items()],
    )


def with_spans(docs: DataFrame, base: str = "_base", more: str = "_more") -> DataFrame:
    """``docs`` with its definite spans, by start, and its candidates that touch none of them."""
    text = F.coalesce("text", F.lit(""))
    out = docs.withColumn(base, F.array_sort(F.concat(*[definite(text, k) for k in KINDS])))

    def candidates(kind: str) -> Column:
        return F.transform(matches(text, CANDIDATES[kind]), lambda m: labelled(m, kind))

    found = F.concat(*[candidates(k) for k in CANDIDATES])

    def free(c: Column) -> Column:
        return ~F.exists(F.col(base), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    return out.withColumn(more, F.filter(found, free))


@dataclass
class SpanModel:
    """Labeler reliabilities by kind (how often they fire on real and on false spans, and the share of real ones), and the classifier."""

    reliabilities: dict[str, tuple[list[float], list[float], float]]
    intercept: float
    weights: list[float]

    def accepts(self, c: Column) -> Column:
        """Whether the final classifier takes a candidate."""
        total = F.lit(self.intercept)
        for w, x in zip(self.weights, inputs(c)):
            total = total + F.lit(w) * x
        return total >= 0


def inputs(c: Column) -> list[Column]:
    """What the classifier sees of a candidate."""
    kinds = [(c["kind"] == k).cast("double") for k in CANDIDATES]
    return [*kinds, *[c[v].cast("double") for v in VOTES], *[c[t] for t in TRAITS]]


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 50) -> dict:
    """EM for labelers that fire or not, independent given the truth; started from a majority view."""
    out = {}
    for kind in sorted({k for k, _, _ in patterns}):
        rows = [(v, n) for k, v, n in patterns if k == kind]
        hit, false, share = [0.7] * len(VOTES), [0.2] * len(VOTES), 0.5
        for _ in range(rounds):
            real = [posterior(v, hit, false, share) for v, _ in rows]
            total = sum(n for _, n in rows)
            yes = sum(p * n for p, (_, n) in zip(real, rows))
            no = total - yes
            # One real and one false span of either vote are added: no rate reaches 0 or 1.
            hit = [(1 + sum(p * n * v[j] for p, (v, n) in zip(real, rows))) / (2 + yes) for j in range(len(VOTES))]
            false = [(1 + sum((1 - p) * n * v[j] for p, (v, n) in zip(real, rows))) / (2 + no) for j in range(len(VOTES))]
            share = (1 + yes) / (2 + total)
        out[kind] = (hit, false, share)
    return out


def posterior(votes: tuple[int, ...], hit: list[float], false: list[float], share: float) -> float:
    """Probability that a candidate with these votes is real."""
    odds = math.log(share / (1 - share))
    for v, a, b in zip(votes, hit, false):
        odds += math.log(a / b) if v else math.log((1 - a) / (1 - b))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def posterior_column(model: dict) -> Column:
    """The same as a column over a candidate's fields."""
    out = F.lit(None).cast("double")
    for kind, (hit, false, share) in model.items():
        odds = F.lit(math.log(share / (1 - share)))
        for v, a, b in zip(VOTES, hit, false):
            odds = odds + F.when(F.col(v) == 1, math.log(a / b)).otherwise(math.log((1 - a) / (1 - b)))
        out = F.when(F.col("kind") == kind, 1 / (1 + F.exp(-odds))).otherwise(out)
    return out


def fit(spans: DataFrame, more: str = "_more") -> SpanModel | None:
    """Estimate reliabilities and train the classifier on all candidates; None without candidates."""
    each = spans.select(F.explode(more).alias("c")).select("c.*")
    counts = each.groupBy("kind", *VOTES, *[F.round(F.col(t), 1).alias(t) for t in TRAITS]).count()
    counts = materialize(counts, "pii-votes")
    # Kinds times vote patterns: at most 3 * 2^5 rows.
    rows = bounded_rows(counts.groupBy("kind", *VOTES).agg(F.sum("count").alias("n")), len(CANDIDATES) * 2 ** len(VOTES), "vote patterns")
    if not rows:
        return None
    rates = reliabilities([(r.kind, tuple(r[v] for v in VOTES), r.n) for r in rows])
    soft = counts.withColumn("p", posterior_column(rates))
    x = array_to_vector(F.array(*inputs(F.struct("kind", *VOTES, *TRAITS))))
    sides = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("w"))))
    train = soft.select(x.alias("features"), "count", sides.alias("s")).select(
        "features", "s.label", (F.col("count") * F.greatest("s.w", F.lit(1e-6))).alias("weight")
    )
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=100).fit(train)
    return SpanModel(rates, float(model.intercept), model.coefficients.toArray().tolist())


def decided(spans: DataFrame, model: SpanModel | None, base: str = "_base", more: str = "_more", out: str = "spans") -> DataFrame:
    """Replace candidates by ``out``: definite spans and accepted candidates, by start, then kind."""
    slim = F.expr(f"transform({base}, b -> named_struct('start', b.start, 'rank', b.rank, 'end', b.end, 'kind', b.kind))")
    if model is not None:
        taken = F.filter(F.col(more), model.accepts)
        taken = F.transform(taken, lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"), c["kind"].alias("kind")))
        slim = F.array_sort(F.concat(slim, taken))
    return spans.withColumn(out, slim).drop(more)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans count as one."""

    def start(at: Column, part: Column) -> Column:
        upto = F.greatest(at, F.array_max(F.transform(part, lambda s: s["end"])))
        cut = F.substring(text, at + 1, upto - at)
        return F.struct(at.alias("at"), at.alias("from"), cut.alias("cut"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(state["cut"], state["at"] - state["from"] + 1, s["start"] - state["at"])
        new = F.concat(state["out"], gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            state["from"].alias("from"),
            state["cut"].alias("cut"),
            F.when(s["start"] >= state["at"], new).otherwise(state["out"]).alias("out"),
        )

    def whole(states: Column) -> Column:
        at = F.coalesce(F.get(states, F.size(states) - 1)["at"], F.lit(0))
        return F.concat(F.array_join(F.transform(states, lambda s: s["out"]), ""), F.substring(text, at + 1, F.length(text)))

    return bound(running(spans, start, step, F.lit(0)), whole)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the personal data of its texts replaced; its other columns stay, null texts too."""
    model = fit(with_spans(docs.select("text")))
    # A row travels as one column, so that no column of its meets one of ours.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    spans = decided(with_spans(rows), model)
    text = F.when(F.size("spans") > 0, redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    return spans.select(F.col("row").withField("text", text).alias("row")).select("row.*")


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans): definite spans, and all spans with the accepted candidates."""
    stored = materialize(with_spans(docs.select("doc_id", "text")).select("doc_id", "_base", "_more"), "pii-spans")
    return decided(stored, fit(stored)).withColumnRenamed("_base", "base")
