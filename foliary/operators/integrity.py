"""Completeness and integrity as tables of violations, and a strict mode that raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliary.operators.staging import stage


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that repeat, and how often."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def gaps(shards: DataFrame, group: list[str], start: str, end: str) -> DataFrame:
    """Shards that don't begin right after the one before, per group."""
    w = Window.partitionBy(*group).orderBy(start, end)
    return shards.withColumn("previous_end", F.lag(end).over(w)).where(F.col("previous_end").isNotNull() & (F.col("previous_end") + 1 != F.col(start)))


def descents(rows: DataFrame, group: list[str], order: str, value: str) -> DataFrame:
    """Rows whose value is below the one before."""
    w = Window.partitionBy(*group).orderBy(order)
    return rows.withColumn("previous", F.lag(value).over(w)).where(F.col(value) < F.col("previous"))


def compare_files(expected: DataFrame, actual: DataFrame, key: str = "path") -> DataFrame:
    """Each path's state: missing, unexpected, size or hash differs, same. Columns size and hash on both sides."""
    e = expected.select(key, F.struct("size", "hash").alias("e"))
    a = actual.select(key, F.struct("size", "hash").alias("a"))
    state = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "unexpected").when(F.col("e.size") != F.col("a.size"), "size").when(F.col("e.hash") != F.col("a.hash"), "hash").otherwise("same")
    return e.join(a, key, "full").select(key, state.alias("state"))


def unique_count(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(rows, keys, proven): every key once."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys")).withColumn("proven", F.col("n_rows") == F.col("n_keys"))


def require_none(violations: DataFrame, what: str) -> None:
    """Raise ValueError with up to five of them if there are any."""
    found = violations.limit(5).collect()
    if found:
        raise ValueError(f"{what}: {[r.asDict() for r in found]}")


def chunk(index: Column, size: int) -> Column:
    """Number of the chunk of ``size`` that a position (from 0) falls into."""
    return F.floor(index / size).cast("long")


def positions(rows: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Global positions from 0 without sending all rows to one task: rows are range-partitioned and staged with the number of
    their partition (bounds of ranges are sampled, so they must be drawn once), partitions are counted (a row of counts per
    partition is broadcast) and rows numbered inside. Rows equal in ``order`` get positions in any order."""
    part = "_part"
    placed = stage(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    counts = placed.groupBy(part).agg(F.count("*").alias("_n"))
    offsets = counts.select(part, (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return placed.withColumn("_inside", inside).join(F.broadcast(offsets), part).withColumn(name, (F.col("_before") + F.col("_inside")).cast("long")).drop(part, "_before", "_inside")


def running(rows: DataFrame, order: list[str], value: str, name: str = "total") -> DataFrame:
    """Sum of ``value`` over a row and all rows before it in ``order``, without sending all rows to one task: as ``positions``, with
    the sums of range partitions in place of their counts. Null values count as 0; ``order`` should be unique."""
    part = "_part"
    placed = stage(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    amount = F.coalesce(value, F.lit(0))
    sums = placed.groupBy(part).agg(F.sum(amount).alias("_sum"))
    offsets = sums.select(part, (F.sum("_sum").over(Window.orderBy(part)) - F.col("_sum")).alias("_before"))
    inside = F.sum(amount).over(Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("_inside", inside).join(F.broadcast(offsets), part).withColumn(name, F.col("_before") + F.col("_inside")).drop(part, "_before", "_inside")
