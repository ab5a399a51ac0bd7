"""The engine's frames as views of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census records: an order is a record and its document, nation the house, market segment the session."""
    o, c, n = t(spark, sf_dir, "orders"), t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation")
    scopes = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))  # dimensions first: orders are dealt once, by customer
    joined = o.join(scopes, F.col("o_custkey") == F.col("c_custkey"))
    status = F.when(F.col("o_orderstatus") == "F", "downloaded").when(F.col("o_orderstatus") == "P", "failed").otherwise("discovered")
    return joined.select(F.col("o_orderkey").alias("document"), F.col("n_name").alias("house"), F.col("c_mktsegment").alias("session"), status.alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("day"), F.col("o_orderpriority").alias("priority"))


RECORDS = """SELECT o_orderkey AS document, n_name AS house, c_mktsegment AS session,
  CASE o_orderstatus WHEN 'F' THEN 'downloaded' WHEN 'P' THEN 'failed' ELSE 'discovered' END AS status,
  o_totalprice AS price, o_orderdate AS day, o_orderpriority AS priority
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of complete runs: a line of status F is a page, its number the run."""
    return t(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("run"), F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("size"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjudications: a conversation is a page, a turn an attempt, its role the provider."""
    return t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("page"), F.col("turn").alias("attempt"), F.col("role").alias("provider"), "text")
