"""Versioned rows: latest per key, priority then recency, latest child, merges by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Of each key the row with the greatest version: one aggregation, with a partial one before the shuffle."""
    others = [c for c in rows.columns if c not in keys]
    picked = rows.where(F.col(version).isNotNull()).groupBy(*keys).agg(F.max_by(F.struct(*others), version).alias("_row"))
    return picked.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in others))


def best(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Of each key the row that is first by ``order`` (columns that sort ascending; all are compared as one struct)."""
    others = [c for c in rows.columns if c not in keys]
    rank = F.struct(*(c.alias(f"_{i}") for i, c in enumerate(order)))
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*others), rank).alias("_row"))
    return picked.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in others))


def with_latest_child(parents: DataFrame, children: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Each parent with its latest child's columns, null if it has none."""
    return parents.join(latest(children, keys, version), keys, "left")


def upsert(old: DataFrame, new: DataFrame, key: str, surviving: list[str]) -> DataFrame:
    """New rows replace old ones of the same key, but columns in ``surviving`` keep the old value (new ones on insert)."""
    n = new.select(F.col(key), F.struct(*(c for c in new.columns if c != key)).alias("_new"))
    o = old.select(F.col(key), F.struct(*(c for c in old.columns if c != key)).alias("_old"))
    pick = lambda c: F.when(F.col("_new").isNull() | (F.lit(c in surviving) & F.col("_old").isNotNull()), F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c)
    return o.join(n, key, "full").select(key, *(pick(c) for c in old.columns if c != key))


def insert_or_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows and those new ones whose key isn't there yet, one per key."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti").select(*old.columns))


def conflicts(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys that are in both with different values: an immutable ledger must have none."""
    o, n = old.select(*keys, F.col(value).alias("old_value")), new.select(*keys, F.col(value).alias("new_value"))
    return o.join(n, keys).where(~F.col("old_value").eqNullSafe(F.col("new_value")))


def conjunction(**equal: object) -> Column:
    """Equality with every value given that isn't None."""
    parts = [F.col(k) == F.lit(v) for k, v in equal.items() if v is not None]
    return reduce(lambda a, b: a & b, parts, F.lit(True))
