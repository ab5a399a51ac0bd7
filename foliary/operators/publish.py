"""Publication: document and page tables, JSON lines, archives, checksums, and their verification."""

from __future__ import annotations

import hashlib
import io
import itertools
import os
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.operators.integrity import compare_files
from foliary.operators.staging import stage
from foliary.sources import files


def document_text(pages: DataFrame, keys: list[str], order: str, text: str, separator: str = "\n\n") -> DataFrame:
    """Texts of a document's pages joined in page order; a null page counts as an empty one."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(text, F.lit("")).alias("t"))))
    return pages.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["t"]), separator).alias("text"), F.count("*").alias("pages"))


def write_tables(documents: DataFrame, pages: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/documents.parquet")
    pages.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/pages.parquet")


def write_json_lines(rows: DataFrame, path: str) -> None:
    """gzip JSON lines; Spark's text writers have no zstd here, see ``write_zstd_lines``."""
    rows.write.mode("overwrite").option("compression", "gzip").json(path)


def write_zstd_lines(rows: DataFrame, path: str, level: int = 10, lines_per_block: int = 50_000) -> DataFrame:
    """JSON lines with sorted keys as zstd files, one per partition, each a sequence of frames of so many lines. Written by the
    tasks; returns part, path, lines, size, hash, staged."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        context, held, lines = TaskContext.get(), [], 0
        target = f"{path}/part-{context.partitionId():05d}.jsonl.zst"
        pack = lambda: zstandard.ZstdCompressor(level=level).compress("".join(f"{x}\n" for x in held).encode())
        with files.Writing(target, str(context.taskAttemptId())) as out:
            for batch in batches:
                for line in batch["line"]:
                    held.append(line)
                    lines += 1
                    if len(held) == lines_per_block:
                        out.write(pack())
                        held = []
            if held:
                out.write(pack())
        yield pd.DataFrame({"part": [context.partitionId()], "path": [target], "lines": [lines], "size": [out.size], "hash": [out.digest.hexdigest()]})

    lines = rows.select(F.to_json(F.struct(*(F.col(c) for c in sorted(rows.columns)))).alias("line"))
    return stage(lines.mapInPandas(run, "part int, path string, lines long, size long, hash string"), "zstd-lines")


def read_zstd_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of zstd JSON lines, read as streams; a line that isn't JSON of the schema is an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        for batch in batches:
            for name in batch["path"]:
                with files.open_stream(name) as raw:
                    text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True), encoding="utf-8", newline="\n")
                    while block := list(itertools.islice(text, 1000)):
                        yield pd.DataFrame({"line": [x.rstrip("\n") for x in block]})

    lines = files.listing(spark, path).select("path").mapInPandas(run, "line string")
    return lines.select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("x")).select("x.*")


def write_tar_shards(members: DataFrame, path: str) -> DataFrame:
    """Archives with the same headers whenever they are made (time 0, user 0), members sorted by key and name, a shard per
    partition. Columns key, name, content. Written by the tasks as streams; returns shard, path, members, size, hash, staged."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        context, n = TaskContext.get(), 0
        batch = next(batches, None)
        if batch is None:
            return
        target = f"{path}/shard-{context.partitionId():05d}.tar"
        with files.Writing(target, str(context.taskAttemptId())) as out:
            with tarfile.open(fileobj=out, mode="w|", format=tarfile.PAX_FORMAT) as tar:
                for part in itertools.chain([batch], batches):
                    for name, content in zip(part["name"], part["content"], strict=True):
                        info = tarfile.TarInfo(name)
                        info.size, info.mtime, info.mode = len(content), 0, 0o644
                        tar.addfile(info, io.BytesIO(bytes(content)))
                        n += 1
        yield pd.DataFrame({"shard": [context.partitionId()], "path": [target], "members": [n], "size": [out.size], "hash": [out.digest.hexdigest()]})

    sorted_members = members.repartitionByRange("key").sortWithinPartitions("key", "name")
    return stage(sorted_members.mapInPandas(run, "shard int, path string, members long, size long, hash string"), "tar-shards")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """path, size, hash of every file under a folder, paths relative to it; files are read in blocks, whatever their size."""
    relative = F.regexp_replace("path", f"^.*{os.path.basename(path.rstrip('/'))}/", "")
    found = files.listing(spark, path).where(~F.col("path").rlike("/_(?:SUCCESS|temporary/.*)$"))
    return files.hashed(found).withColumn("path", relative)


def verify(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """Files of a bundle that are missing, unexpected or changed."""
    return compare_files(expected, checksums(spark, path)).where("state <> 'same'")


def publication_counts(documents: DataFrame, pages: DataFrame) -> DataFrame:
    d = documents.agg(F.count("*").alias("documents"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"), F.lit(1).alias("k"))
    p = pages.agg(F.count("*").alias("pages"), F.count_if(F.col("route") == "ocr").alias("ocr_pages"), F.count_if(F.col("validation_status") == "review").alias("review_pages"), F.lit(1).alias("k"))
    return d.join(p, "k").drop("k")


def duckdb_snapshot(parquet_path: str, target: str) -> None:
    """Tables documents and pages as one DuckDB file, on the driver, from published Parquet that lies in a local folder."""
    import duckdb

    con = duckdb.connect(target)
    for name in ("documents", "pages"):
        con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM read_parquet('{parquet_path}/{name}.parquet/*.parquet')")
    con.close()


def git_blob_id(content) -> F.Column:
    """Object id of a file's bytes as version control computes it."""
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(content).cast("string")), "utf-8"), F.lit(b"\0"), content))


def tranche_id(files: dict[str, bytes]) -> str:
    """First 20 hex digits of a hash over names, sizes (8 bytes) and contents in order of names."""
    h = hashlib.sha256()
    for name in sorted(files):
        h.update(name.encode() + b"\0" + len(files[name]).to_bytes(8, "big") + files[name])
    return h.hexdigest()[:20]


def keep_optimised(sizes: DataFrame, least_saving: float = 5.0) -> DataFrame:
    """Whether an optimised copy saves enough to be kept. Columns original_bytes, optimised_bytes."""
    saving = 100.0 * (F.col("original_bytes") - F.col("optimised_bytes")) / F.col("original_bytes")
    return sizes.withColumn("saving", saving).withColumn("keep", F.coalesce((F.col("original_bytes") > 0) & (saving >= least_saving), F.lit(False)))
