"""Mixing sources to target weights by hierarchical budgets over a domain, language and source tree.

The total budget goes down the tree. At each node the children share the node's budget by
their weights; a child never gets more than its subtree holds (tokens times ``max_epochs``), and
what it can't use goes to its siblings by weight. A shortage therefore stays among siblings as
long as they have tokens, and only a node that is short as a whole passes it on to its own
siblings. The share has a closed form: order the children by capacity over weight; the water
level is the largest of (budget - capacities before) / (weights from here on).

Each leaf then takes whole epochs and, of one more, the prefix in a seeded order (md5 of seed,
epoch and document id) whose tokens fit the rest. The prefix is found from token sums over
4,096 ranges of the hash; only the range that holds the cut is ordered, so a leaf with most of
the rows is never sorted in one task.

Tokens are words. Null or blank texts have none; they cost nothing and stay as long as their
place lies in the prefix. A null language or source is the node ``(none)``. Rows with equal
document ids are taken together or not at all up to the budget. Weights of unlisted nodes are
``default_weight``; a weight of 0 takes nothing. Empty tables give empty results. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.plans.lineage import lookup_side, materialize

WORD = r"[^\x20\x09-\x0D]+"
NONE = "(none)"
LEVELS = ("_domain", "_lang", "_source")


@dataclass(frozen=True)
class MixConfig:
    """Weights by name at each level, relative to siblings; the budget is ``share`` of all tokens, or ``total``."""

    domain: Column = field(default_factory=lambda: F.lit("all"))
    domain_weights: dict[str, float] = field(default_factory=dict)
    lang_weights: dict[str, float] = field(default_factory=dict)
    source_weights: dict[str, float] = field(default_factory=dict)
    default_weight: float = 1.0
    share: float = 1.0
    total: int | None = None
    max_epochs: int = 4
    seed: int = 7


def tokens(text: Column) -> Column:
    """The number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weight_of(name: Column, weights: dict[str, float], default: float) -> Column:
    """A literal table of weights as a column."""
    out = F.lit(float(default))
    for key, w in weights.items():
        out = F.when(name == key, F.lit(float(w))).otherwise(out)
    return out


def shared(nodes: DataFrame, parents: list[str], name: str, budget: str) -> DataFrame:
    """Replace ``budget`` of the parent by that of each child, from ``weight`` and ``capacity``."""
    group = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("capacity") / F.col("weight"), name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.where("weight > 0").withColumn("_level", (F.col(budget) - before) / onward)
    level = F.max("_level").over(group)
    return nodes.withColumn("_fill", F.least(F.col("capacity"), F.col("weight") * level)).select(
        *parents, name, F.greatest("_fill", F.lit(0.0)).alias(budget)
    )


def leaf_budgets(leaves: DataFrame, config: MixConfig) -> DataFrame:
    """(domain, language, source, tokens, budget) from leaves with their token counts."""
    weights = (config.domain_weights, config.lang_weights, config.source_weights)
    total = F.lit(float(config.total)) if config.total is not None else F.lit(config.share) * F.sum("tokens").cast("double")
    budgets = leaves.agg(total.alias("budget"))
    for depth, (name, weight) in enumerate(zip(LEVELS, weights)):
        parents = list(LEVELS[:depth])
        nodes = leaves.groupBy(*parents, name).agg((F.sum("tokens") * float(config.max_epochs)).alias("capacity"))
        nodes = nodes.withColumn("weight", weight_of(F.col(name), weight, config.default_weight))
        # The root is one row.
        nodes = nodes.join(budgets, parents) if parents else nodes.join(F.broadcast(budgets))
        budgets = shared(nodes, parents, name, "budget")
    # Three decimals absorb the order of floating-point sums.
    whole = F.floor(F.round("budget", 3)).cast("long")
    return leaves.join(budgets.select(*LEVELS, whole.alias("budget")), list(LEVELS))


def mix(docs: DataFrame, config: MixConfig | None = None, epoch: str = "epoch", size: str = "tokens", domain: str = "domain") -> DataFrame:
    """Rows of ``docs(doc_id, text, lang, source, ..)`` as often as the mix takes them, with their epoch, tokens and domain.

    These three columns replace columns of ``docs`` with their names; other names keep those.
    """
    config = config or MixConfig()
    # A row travels as one column, so that no column of its meets one of ours.
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("_id"),
        F.coalesce(config.domain.cast("string"), F.lit(NONE)).alias(LEVELS[0]),
        F.coalesce("lang", F.lit(NONE)).alias(LEVELS[1]),
        F.coalesce("source", F.lit(NONE)).alias(LEVELS[2]),
        tokens(F.col("text")).alias("_n"),
    )
    keys = materialize(named.select("_id", *LEVELS, "_n"), "mix-keys")
    leaves = keys.groupBy(*LEVELS).agg(F.sum("_n").alias("tokens"))
    plan = leaf_budgets(materialize(leaves, "mix-leaves"), config)
    plan = plan.withColumn("_full", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int"))
    plan = plan.select(*LEVELS, "_full", (F.col("budget") - F.col("_full") * F.col("tokens")).alias("_rest"))
    plan = materialize(plan, "mix-plan")
    place = F.md5(F.concat_ws(":", F.lit(str(config.seed)), F.col("_full"), F.col("_id")).cast("binary"))
    placed = keys.join(lookup_side(plan, 200), list(LEVELS)).withColumn("_range", F.substring(place, 1, 3))
    sums = placed.groupBy(*LEVELS, "_range", "_rest").agg(F.sum("_n").alias("s"))
    upto = F.sum("s").over(Window.partitionBy(*LEVELS).orderBy("_range"))
    over = sums.withColumn("u", upto).where("u > _rest").groupBy(*LEVELS)
    cut = over.agg(F.min("_range").alias("_cut"), F.min(F.struct("_range", (F.col("u") - F.col("s")).alias("b")))["b"].alias("_before"))
    plan = materialize(plan.join(cut, list(LEVELS), "left"), "mix-cut")
    rows = named.join(lookup_side(plan, 240), list(LEVELS))
    rows = rows.withColumn("_hash", place).withColumn("_range", F.substring("_hash", 1, 3))
    inside = F.col("_cut").isNull() | (F.col("_range") < F.col("_cut"))
    clear = rows.where(inside | (F.col("_range") > F.col("_cut"))).withColumn("_n_copies", F.col("_full") + inside.cast("int"))
    # Rows with equal hashes come together: a range frame sums all of them.
    run = Window.partitionBy(*LEVELS).orderBy("_hash").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    edge = rows.where(F.col("_range") == F.col("_cut"))
    fits = F.col("_before") + F.sum("_n").over(run) <= F.col("_rest")
    edge = edge.withColumn("_n_copies", F.col("_full") + fits.cast("int"))
    taken = clear.unionByName(edge).where("_n_copies > 0")
    each = F.explode(F.sequence(F.lit(0), F.col("_n_copies") - 1)).alias(epoch)
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in (epoch, size, domain)]
    return taken.select(*own, F.col("_n").alias(size), F.col(LEVELS[0]).alias(domain), each)


def mix_sql(domain_sql: str, config: MixConfig, table: str = "documents") -> str:
    """The same rows as DuckDB SQL: (doc_id, lang, source, domain, tokens, epoch)."""

    def case(name: str, weights: dict[str, float]) -> str:
        whens = " ".join(f"WHEN {name} = '{k}' THEN {float(w)}" for k, w in weights.items())
        return f"CASE {whens} ELSE {float(config.default_weight)} END" if whens else f"{float(config.default_weight)}"

    def level(depth: int, weights: dict[str, float]) -> str:
        names = ["d", "l", "s"][: depth + 1]
        parents, name = names[:-1], names[-1]
        part = f"PARTITION BY {', '.join(parents)}" if parents else ""
        given = f"b{depth - 1}" if parents else "b_root"
        using = f"JOIN {given} USING ({', '.join(parents)})" if parents else f"CROSS JOIN {given}"
        every = ", ".join(names)
        return f"""
n{depth} AS (SELECT {every}, sum(tokens) * {float(config.max_epochs)} AS capacity, {case(name, weights)} AS weight FROM leaves GROUP BY {every}),
v{depth} AS (SELECT {every}, capacity, weight, (budget - coalesce(sum(capacity) OVER ({part} ORDER BY capacity / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER ({part} ORDER BY capacity / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n{depth} {using} WHERE weight > 0),
b{depth} AS (SELECT {every}, greatest(least(capacity, weight * max(level) OVER ({part})), 0) AS budget FROM v{depth}),"""

    total = float(config.total) if config.total is not None else f"{config.share} * sum(tokens)"
    word = "[^\\x20\\x09-\\x0D]+"
    return f"""
WITH named AS (SELECT doc_id, lang, source, coalesce({domain_sql}, '{NONE}') AS d, coalesce(lang, '{NONE}') AS l, coalesce(source, '{NONE}') AS s,
  coalesce(len(regexp_extract_all(text, '{word}')), 0) AS tokens FROM {table}),
leaves AS (SELECT d, l, s, sum(tokens)::BIGINT AS tokens FROM named GROUP BY d, l, s),
b_root AS (SELECT {total} AS budget FROM leaves),
{level(0, config.domain_weights)}{level(1, config.lang_weights)}{level(2, config.source_weights)}
plan AS (SELECT d, l, s, tokens AS all_tokens, floor(round(budget, 3))::BIGINT AS budget FROM leaves JOIN b2 USING (d, l, s)),
parts AS (SELECT d, l, s, CASE WHEN all_tokens > 0 THEN budget // all_tokens ELSE 0 END AS whole,
  CASE WHEN all_tokens > 0 THEN budget % all_tokens ELSE budget END AS rest FROM plan),
placed AS (SELECT named.*, whole, rest, sum(tokens) OVER (PARTITION BY d, l, s ORDER BY md5('{config.seed}:' || whole || ':' || coalesce(doc_id::VARCHAR, ''))
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM named JOIN parts USING (d, l, s)),
counted AS (SELECT *, whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS copies FROM placed)
SELECT doc_id, lang, source, d AS domain, tokens, unnest(range(0, copies::BIGINT))::INT AS epoch FROM counted WHERE copies > 0
"""
