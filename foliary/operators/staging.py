"""Tables staged in the folder all executors share: they cut the lineage, and a lost executor costs no more than a stage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``. Where that is unset, a temporary folder does for a local master; a cluster's
    executors don't share one, so that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _OWN:
            _OWN.append(f"file://{tempfile.mkdtemp(prefix='foliary-')}")
        base = _OWN[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str, rows: int = 0, rows_per_task: int = 4_000_000) -> DataFrame:
    """Rows dealt by ``keys`` over as many tasks as shuffles have, or as hold ``rows`` by so many. The number is given, so that few bytes
    don't become few tasks: adaptive execution merges partitions by their bytes, whatever work or memory their rows ask for."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // rows_per_task)), *keys)


def stage(df: DataFrame, name: str) -> DataFrame:
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
