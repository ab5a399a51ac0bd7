"""Queries over the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliary.plans.catalog import query
from foliary.plans.frames import t
from foliary.streaming import events as log


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def event_log_parse(spark, sf):
    return t(spark, sf, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k")).groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1")
def event_counts(spark, sf):
    return t(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2")
def event_stream_windows(spark, sf):
    """An extension: the streaming aggregation over the same rows as a batch."""
    w = log.windowed(t(spark, sf, "events"), "ts", "event_type", "value")
    return w.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.col("total").cast("double").alias("total"))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS first FROM events),
s AS (SELECT user_id, ts, sum(first) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, sf):
    s = log.sessions(t(spark, sf, "events"), "ts", "user_id", "6 hours")
    return s.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")
