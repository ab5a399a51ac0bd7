"""Files as rows and as streams, of any size: listing, hashes in blocks, writing from tasks."""

from __future__ import annotations

import hashlib
import os
import urllib.parse
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.operators.staging import spread

BLOCK = 1 << 20


def _target(path: str):
    """(file system or None for this machine's shared mounts, path in it)."""
    parsed = urllib.parse.urlsplit(path)
    if parsed.scheme in ("", "file"):
        return None, urllib.parse.unquote(parsed.path) if parsed.scheme else path
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def open_stream(path: str):
    """A readable stream of a file: a mounted path, or a URI that pyarrow's file systems know."""
    system, at = _target(path)
    return open(at, "rb") if system is None else system.open_input_stream(at)


class Writing:
    """A file written under another name and moved to its own at the end: a lost task leaves no half of it."""

    def __init__(self, path: str, attempt: str) -> None:
        self.system, self.at = _target(path)
        self.work = f"{self.at}.{attempt}.tmp"
        if self.system is None:
            os.makedirs(os.path.dirname(self.at), exist_ok=True)
        else:
            self.system.create_dir(os.path.dirname(self.at), recursive=True)

    def __enter__(self):
        self.stream = open(self.work, "wb") if self.system is None else self.system.open_output_stream(self.work)
        self.digest, self.size = hashlib.sha256(), 0
        return self

    def write(self, data: bytes) -> int:
        self.digest.update(data)
        self.size += len(data)
        self.stream.write(data)
        return len(data)

    def flush(self) -> None:
        self.stream.flush()

    def becomes(self, path: str) -> None:
        """The file's name, if it is known only when the content is."""
        self.at = _target(path)[1]

    def __exit__(self, kind, *_) -> None:
        self.stream.close()
        if kind is None:
            os.replace(self.work, self.at) if self.system is None else self.system.move(self.work, self.at)
        elif self.system is None:
            os.unlink(self.work)
        else:
            self.system.delete_file(self.work)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path, size of every file under a folder, empty and hidden ones too, but for the side files that Hadoop's local file system
    keeps (``.name.crc``); contents are not read. The folder's own entries are listed
    here, what lies below each of its folders by the tasks. The files are dealt over as many tasks as shuffles have, as whoever reads them
    has more to do than these rows say. A single file is listed too."""
    system, at = _target(path)
    root = "" if system is None else f"{urllib.parse.urlsplit(path).scheme}://"
    at = at.rstrip("/") or "/"
    top = [(at, False)] if not _is_folder(system, at) else [(x, folder) for x, folder, _ in _entries(system, at)]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for entry, folder in zip(batch["entry"], batch["folder"], strict=True):
                system, _ = _target(f"{root}{entry}") if root else (None, entry)
                todo, rows = [entry] if folder else [], []
                if not folder:
                    rows.append((f"{root}{entry}", _size(system, entry)))
                while todo:
                    for x, inner, size in _entries(system, todo.pop()):
                        todo.append(x) if inner else rows.append((f"{root}{x}", size))
                    if len(rows) >= 10_000:
                        yield pd.DataFrame(rows, columns=["path", "size"])
                        rows = []
                yield pd.DataFrame(rows, columns=["path", "size"])

    entries = spark.createDataFrame(top, "entry string, folder boolean")
    found = entries.repartition("entry").mapInPandas(walk, "path string, size long")
    return spread(found, "path")


def _is_folder(system, at: str) -> bool:
    if system is None:
        return os.path.isdir(at)
    from pyarrow import fs

    return system.get_file_info(at).type == fs.FileType.Directory


def _size(system, at: str) -> int:
    return os.path.getsize(at) if system is None else system.get_file_info(at).size


def _entries(system, at: str) -> list[tuple[str, bool, int]]:
    """(path, whether it is a folder, size) of what a folder holds itself."""
    if system is None:
        with os.scandir(at) as found:
            return [(x.path, x.is_dir(), 0 if x.is_dir() else x.stat().st_size) for x in found if not (x.name.startswith(".") and x.name.endswith(".crc"))]
    from pyarrow import fs

    return [(x.path, x.type == fs.FileType.Directory, x.size or 0) for x in system.get_file_info(fs.FileSelector(at))]


def hashed(found: DataFrame) -> DataFrame:
    """Adds ``hash``, the SHA-256 of each file of a listing, read in blocks; ``size`` becomes the number of bytes read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                digest, size = hashlib.sha256(), 0
                with open_stream(path) as stream:
                    while block := stream.read(BLOCK):
                        digest.update(block)
                        size += len(block)
                rows.append((path, size, digest.hexdigest()))
            yield pd.DataFrame(rows, columns=["path", "size", "hash"])

    return found.select("path").mapInPandas(run, "path string, size long, hash string")
