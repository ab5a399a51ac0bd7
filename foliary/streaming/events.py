"""The append-only event log: one JSON object a line, fixed fields ``ts`` and ``event``, the rest open.

Reading works on a folder of JSON or Parquet files as a batch or a stream; windows take late events up to a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LOG = "ts timestamp, event string, document string, page int, seconds double, error string, progress map<string,string>"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).option("mode", "PERMISSIVE").json(path)


def stream_log(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", files_per_trigger).json(path)


def append_log(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


def windowed(events: DataFrame, time: str, kind: str, value: str, width: str = "1 day", delay: str | None = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts and sums per event-time window and kind. Sums are decimal: equal whatever the order of rows."""
    own = events.withWatermark(time, delay) if delay and events.isStreaming else events
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return own.groupBy(w.alias("w"), kind).agg(F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,4)")).alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), kind, "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions per key: events less than ``gap`` apart."""
    own = events.withWatermark(time, delay) if events.isStreaming else events
    return own.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def once_each(events: DataFrame, time: str, key: str, delay: str = "1 hour") -> DataFrame:
    """First event of each key within the watermark (a stream), or of each key (a batch)."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])


def drain(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Work through all that is there in bounded micro-batches, then end; ``each`` must be idempotent per batch id."""
    return stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(each).start()


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return stream.writeStream.format("parquet").outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).option("path", path).start()
