"""Helpers that the operators of this package share: staged tables, tables' columns, ragged arrays."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where that is unset, a temporary one does for a local master;
    a cluster's executors don't share one, so that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = getattr(shared_folder, "own", None)
        if base is None:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = shared_folder.own = f"file://{tempfile.mkdtemp(prefix='foliary-')}"
    return base.rstrip("/")


def workspace(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/foliary-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = path or workspace(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text; other columns, whatever their names, never reach an operator."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def held_out(doc_id, modulus: int, remainder: int):
    """True where crc32 of the id written as text leaves ``remainder``; null ids are never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def quiet_threads(keep_tables: bool = False) -> None:
    """One thread per Python worker: Spark already runs one worker per core. Piece tables that an earlier operator left in
    the worker are given up, unless this one uses them."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    import pyarrow as pa

    pa.set_cpu_count(1)
    pieces = sys.modules.get("foliary.llm.pieces")
    if pieces is not None and pieces._TABLES and not keep_tables:
        pieces._TABLES.clear()
        give_back()


def give_back() -> None:
    """Hand memory that a batch has freed back to the system: an executor's workers and its JVM share one limit."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(column, max_bytes: int):
    """(start, stop) of runs of rows whose text stays near ``max_bytes``; one long row is a run of its own."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0)
    if isinstance(sizes, pa.ChunkedArray):
        sizes = sizes.combine_chunks()
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield start, stop
        start = stop


def ragged_positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of the segments, in order."""
    total = int(lengths.sum())
    out_starts = np.cumsum(lengths) - lengths
    return np.repeat(starts - out_starts, lengths) + np.arange(total, dtype=np.int64)


class Growing:
    """A numpy array that grows by doubling."""

    def __init__(self, dtype) -> None:
        self.data, self.size = np.empty(1 << 12, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            grown = np.empty(max(need, 2 * len(self.data)), self.data.dtype)
            grown[: self.size] = self.data[: self.size]
            self.data = grown
        self.data[self.size : need] = values
        self.size = need

    def view(self) -> np.ndarray:
        return self.data[: self.size]
