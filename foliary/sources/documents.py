"""Original files: ingest into a content-addressed folder, page extraction, rendering, archives. Extractors are pluggable."""

from __future__ import annotations

import hashlib
import os
import subprocess
import tarfile
import tempfile
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.sources import files, http_json

PAGE = "document_sha256 string, page_number int, text string, markdown string, width double, height double, mean_confidence double, text_items int, reasons array<string>, full_page_image boolean, error string"


class PageExtractor(Protocol):
    """pages(content, numbers, ocr): a dict per page with the fields of PAGE but the hash and error."""

    def page_count(self, content: bytes) -> int: ...

    def pages(self, content: bytes, numbers: list[int] | None, ocr: bool) -> Iterator[dict]: ...


def originals(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """Files that begin as a PDF does, with their hash: path, sha256, size_bytes, content."""
    x = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return x.where(F.substring("content", 1, 5) == F.lit(b"%PDF-")).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"), "content")


def not_originals(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """path, error of the files that ``originals`` leaves out."""
    x = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return x.where(F.substring("content", 1, 5) != F.lit(b"%PDF-")).select("path", F.lit("not a PDF").alias("error"))


FETCHED = "url string, sha256 string, size_bytes long, content binary, error string"


def fetched(entries: DataFrame, opener: Callable[[str, float], bytes] = http_json.open_url, attempts: int = 5, timeout: float = 90, pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """Contents of entries (file, url, sha256): the file if it is there, else the URL's bytes. An entry whose bytes aren't a PDF,
    don't have the expected hash or can't be had gives a row with its error, never nothing. Entries are dealt over the cluster."""

    def content_of(file: str | None, url: str | None) -> bytes:
        if file:
            try:
                with files.open_stream(file) as stream:
                    return stream.read()
            except FileNotFoundError:
                if not url:
                    raise
        if not url:
            raise ValueError("neither a file nor a URL")
        return http_json.download(url, attempts, timeout, opener, pause)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, url, expected in zip(batch["file"], batch["url"], batch["sha256"], strict=True):
                row = {"url": url or file, "sha256": expected, "size_bytes": None, "content": None, "error": None}
                try:
                    content = content_of(file, url)
                    found = hashlib.sha256(content).hexdigest()
                    row |= {"sha256": found, "size_bytes": len(content)}
                    if content[:5] != b"%PDF-":
                        raise ValueError(f"Not a PDF: it begins with {content[:20]!r}")
                    if expected and expected != found:
                        raise ValueError(f"SHA-256 is {found}, not {expected}")
                    row["content"] = content
                except Exception as error:
                    row["error"] = f"{type(error).__name__}: {error}"
                yield pd.DataFrame([row], dtype=object)

    spread = entries.select("file", "url", "sha256").repartition(F.coalesce("url", "file"))
    return spread.mapInPandas(run, FETCHED)


def store(files: DataFrame, path: str) -> None:
    """One row per distinct content, partitioned by the hash's beginning; what is there already isn't written again."""
    spark = files.sparkSession
    new = files.dropDuplicates(["sha256"]).select("sha256", "size_bytes", F.lit("application/pdf").alias("media_type"), "content", F.substring("sha256", 1, 2).alias("shelf"))
    try:
        new = new.join(spark.read.parquet(path).select("sha256"), "sha256", "left_anti")
    except Exception as error:  # the first ingest finds no folder
        if "PATH_NOT_FOUND" not in str(error):
            raise
    new.write.mode("append").partitionBy("shelf").parquet(path)


def extract(files: DataFrame, extractor: PageExtractor, ocr: bool = False) -> DataFrame:
    """A row per page; a file that fails gives one row with its error. A count of pages that differs from the file's is one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in PAGE.split(", ")]
        for batch in batches:
            for sha, content in zip(batch["sha256"], batch["content"], strict=True):
                try:
                    rows = [{**p, "document_sha256": sha, "error": None} for p in extractor.pages(bytes(content), None, ocr)]
                    if len(rows) != (n := extractor.page_count(bytes(content))):
                        raise ValueError(f"{len(rows)} of {n} pages")
                except Exception as error:
                    rows = [{"document_sha256": sha, "page_number": 0, "error": f"{type(error).__name__}: {error}"}]
                yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], dtype=object)

    return files.select("sha256", "content").mapInPandas(run, PAGE)


def two_pass(files: DataFrame, extractor: PageExtractor, reasons: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Native text of all pages first, then OCR of the documents that have pages routed to it; per page the selected layer.

    ``reasons`` adds column route to native pages. The costly pass sees only documents that need it."""
    native = reasons(extract(files, extractor))
    wanted = native.where("route = 'ocr'").select("document_sha256", "page_number")
    again = files.join(wanted.select(F.col("document_sha256").alias("sha256")).distinct(), "sha256", "left_semi")
    ocr = extract(again, extractor, ocr=True).join(wanted, ["document_sha256", "page_number"], "left_semi").select("document_sha256", "page_number", F.struct("text", "markdown", "mean_confidence").alias("ocr"))
    joined = native.join(ocr, ["document_sha256", "page_number"], "left")
    pick = lambda c: F.coalesce(F.col(f"ocr.{c}"), F.col(c))
    return joined.select("document_sha256", "page_number", "route", pick("text").alias("selected_text"), pick("markdown").alias("selected_markdown"), pick("mean_confidence").alias("confidence"), F.col("text").alias("native_text"), "error")


def archive_members(spark: SparkSession, path: str, most_bytes: int = 1 << 30) -> DataFrame:
    """Members of tar archives (plain, gzip or zstd): archive, name, size, content. Archives of any size are read as streams, a
    member at a time, and given on by the megabyte; a member above ``most_bytes`` is an error before it is read."""
    columns = ["archive", "name", "size", "content"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["path"]:
                with files.open_stream(name) as raw:
                    data = raw
                    if name.endswith(".zst"):
                        import zstandard

                        data = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                    with tarfile.open(fileobj=data, mode="r|gz" if name.endswith("gz") else "r|") as tar:
                        rows, held = [], 0
                        for member in tar:
                            if not member.isfile():
                                continue
                            if member.size > most_bytes:
                                raise ValueError(f"{name}: {member.name} has {member.size} bytes")
                            rows.append((name, member.name, member.size, tar.extractfile(member).read()))
                            held += member.size
                            if held >= files.BLOCK or len(rows) == 1000:
                                yield pd.DataFrame(rows, columns=columns)
                                rows, held = [], 0
                        yield pd.DataFrame(rows, columns=columns)

    return files.listing(spark, path).select("path").mapInPandas(run, "archive string, name string, size long, content binary")


def rendered(content: bytes, suffix: str, command: Callable[[str, str], list[str]], seconds: float = 180) -> bytes:
    """The one image (png or jpg) that an external tool makes of a file. ``command`` gives its words from the paths of input and output
    folder. A tool that takes longer than ``seconds`` is ended; that, a failure, and no or several images are errors."""

    def use(path: str) -> bytes:
        out = os.path.join(os.path.dirname(path), "images")
        os.mkdir(out)
        try:
            done = subprocess.run(command(path, out), capture_output=True, text=True, timeout=seconds, check=False)
        except subprocess.TimeoutExpired as error:
            raise RuntimeError(f"rendering took more than {seconds} s") from error
        if done.returncode:
            raise RuntimeError(f"rendering failed: {done.stderr.strip()[-500:]}")
        images = [x for x in sorted(os.listdir(out)) if x.endswith((".png", ".jpg"))]
        if len(images) != 1:
            raise RuntimeError(f"{len(images)} images instead of one")
        with open(os.path.join(out, images[0]), "rb") as f:
            return f.read()

    return with_file(content, suffix, use)


def with_file(content: bytes, suffix: str, use: Callable[[str], object]):
    """``use`` on a temporary file in the worker's own folder; for tools that read paths, gone afterwards."""
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, f"input{suffix}")
        with open(path, "wb") as f:
            f.write(content)
        return use(path)
