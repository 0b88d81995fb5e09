"""Column expressions for scores, probabilities and dense vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import let

NEG_INF = float("-inf")
POS_INF = float("inf")


def sigmoid(z: Column) -> Column:
    """Logistic function with its argument clipped to +-250."""
    clipped = F.greatest(F.least(z, F.lit(250.0)), F.lit(-250.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clipped))


def safe_log(x: Column) -> Column:
    """Natural logarithm that is -Infinity instead of null at and below zero."""
    return F.when(x > 0, F.log(x)).otherwise(F.lit(NEG_INF))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def norm(a: Column) -> Column:
    """Euclidean length of an array."""
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def scale(a: Column, by: Column) -> Column:
    """Array with every element divided by a non-zero number."""
    return F.transform(a, lambda x: x.cast("double") / by)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of the angle between two arrays; 0 if either has no length."""
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0, F.lit(0.0)).otherwise(dot(a, b) / F.nullif(lengths, F.lit(0.0)))


def total(values: Column) -> Column:
    """Sum of an array."""
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def normalize_sum(values: Column) -> Column:
    """Each element of an array divided by the sum of all; a zero sum divides by one."""

    def divided(v: Column) -> Column:
        return let(
            F.when(total(v) == 0, F.lit(1.0)).otherwise(total(v)),
            lambda by: F.transform(v, lambda x: x / by),
        )

    return let(values, divided)


def logsumexp(values: Column) -> Column:
    """ln of the sum of exponentials of an array, computed about its maximum."""

    def about_top(v: Column) -> Column:
        top = F.array_max(v)
        pivot = F.when(top == F.lit(NEG_INF), F.lit(0.0)).otherwise(top)
        return let(pivot, lambda m: m + safe_log(total(F.transform(v, lambda x: F.exp(x - m)))))

    return let(values, about_top)


def softmax(scores: Column) -> Column:
    """Probabilities from an array of unnormalised log scores."""

    def shifted(s: Column) -> Column:
        return let(F.array_max(s), lambda m: F.transform(s, lambda x: F.exp(x - m)))

    return let(let(scores, shifted), lambda e: let(total(e), lambda t: F.transform(e, lambda x: x / t)))


def first_max(names: list[str], scores: Column) -> Column:
    """Name of the largest element; ties go to the name listed first."""
    labels = F.array(*[F.lit(n) for n in names])
    return let(
        scores, lambda s: F.element_at(labels, F.array_position(s, F.array_max(s)).cast("int"))
    )
