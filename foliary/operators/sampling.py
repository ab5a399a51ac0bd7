"""Samples that depend on the data and a seed alone: rank by hash, strata, even spacing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded_rank(seed: int, *keys: str) -> Column:
    """An order by hash of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def seeded(rows: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows of least seeded rank."""
    return rows.orderBy(seeded_rank(seed, *keys), *keys).limit(n)


def even_positions(total: int, n: int) -> list[int]:
    """n positions spread evenly over 0 to total - 1, ends included."""
    if n <= 0 or total <= 0:
        return []
    if n >= total:
        return list(range(total))
    if n == 1:
        return [0]
    return sorted({round(i * (total - 1) / (n - 1)) for i in range(n)})


def stratified(rows: DataFrame, key: str, strata: list[tuple[str, Column, int]], seed: int) -> DataFrame:
    """Rows of each stratum (name, condition, most rows) in turn, none twice; ``stratum`` names the first that took a row.

    Each stratum takes its rows of least seeded rank that no earlier stratum took: a top-k per stratum, no global sort."""
    taken = None
    for name, condition, most in strata:
        pool = rows.where(condition)
        if taken is not None:
            pool = pool.join(taken.select(key), key, "left_anti")
        picked = pool.orderBy(seeded_rank(seed, key), key).limit(most).withColumn("stratum", F.lit(name))
        taken = picked if taken is None else taken.unionByName(picked)
    return taken


def per_group(rows: DataFrame, group: list[str], n: int, order: list[Column]) -> DataFrame:
    """The first n rows of each group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")
