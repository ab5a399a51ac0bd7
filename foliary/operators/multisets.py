"""Multisets of tokens as rows (key, token, n): sizes, intersections, differences, agreement scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(rows: DataFrame, keys: list[str], tokens: Column) -> DataFrame:
    """Tokens of an array column counted per key."""
    return rows.select(*keys, F.explode(tokens).alias("token")).groupBy(*keys, "token").agg(F.count("*").alias("n"))


def overlap(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Size of the intersection per key; keys without common tokens are absent."""
    a, b = left.withColumnRenamed("n", "n_left"), right.withColumnRenamed("n", "n_right")
    return a.join(b, [*keys, "token"]).groupBy(*keys).agg(F.sum(F.least("n_left", "n_right")).alias("common"))


def scores(common: Column, found: Column, expected: Column) -> tuple[Column, Column, Column]:
    """(precision, recall, F1), 0 where a divisor is 0."""
    p = F.when(found > 0, common / found).otherwise(F.lit(0.0))
    r = F.when(expected > 0, common / expected).otherwise(F.lit(0.0))
    return p, r, F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def difference(a: Column, b: Column) -> Column:
    """Sorted elements of a that b has fewer of; for short arrays, within one row."""
    own = F.array_sort(F.array_distinct(a))
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return F.flatten(F.transform(own, lambda x: F.array_repeat(x, F.greatest(count(a, x) - count(b, x), F.lit(0)))))
