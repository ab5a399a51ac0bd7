"""An incremental archive of immutable originals: content-addressed packs and a chain of indexes.

A generation adds what the newest index doesn't have: files are anti-joined on path with the chain, their bytes are written by the tasks into packs (tar
in zstd, named by the SHA-256 of the pack), and the generation's index lists its own files only. A file that was archived and has
changed or disappeared stops a save before anything is written. Restoring follows the chain: packs are hashed first, then
every member is written and held against the index, then the restored folder is. Nothing is read whole: files and packs are streams.

Manifests of three versions are read. Version 3 (what is written) has an index; versions 1 and 2 name one pack or several without
one, so their index is derived by hashing the members once; version 2 has an inventory digest too, which these must give.

A generation counts once its manifest is there, which is created after its packs and index. Packs of lost tasks may stay behind: nobody
refers to them. Two saves at once: the second to claim a generation fails.
"""

from __future__ import annotations

import itertools
import json
import os
import tarfile
import uuid
from collections.abc import Iterator

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.operators.integrity import compare_files, duplicates, require_none
from foliary.operators.staging import spread, stage
from foliary.sources import files

INDEX = "path string, size long, hash string, pack string, pack_size long"
_WORDS = range(8)


def inventory(rows: DataFrame) -> dict:
    """files, bytes and a digest of (path, size, hash) that doesn't depend on order, so that it is one aggregation: sums of the words
    of each row's SHA-256."""
    each = rows.select("size", F.sha2(F.concat_ws("\0", "path", F.col("size").cast("string"), "hash"), 256).alias("h"))
    words = [F.sum(F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("decimal(10,0)")).alias(f"w{i}") for i in _WORDS]
    r = each.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), *words).select(
        "files", "bytes", F.sha2(F.concat_ws(",", *(F.coalesce(F.col(f"w{i}"), F.lit(0)).cast("string") for i in _WORDS)), 256).alias("digest")
    ).first()
    return {"files": r.files, "bytes": int(r.bytes), "inventory": r.digest}


def folder(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder as ``save`` takes them: path (relative), origin, size, hash."""
    root = path.rstrip("/")
    found = files.hashed(files.listing(spark, root))
    return found.select(F.regexp_replace("path", f"^.*?{os.path.basename(root)}/", "").alias("path"), F.col("path").alias("origin"), "size", "hash")


def compare(current: DataFrame, archived: DataFrame) -> DataFrame:
    """Each path's state: new, kept, changed or gone, with the current size and hash (the archived ones where it is gone)."""
    a = archived.select("path", F.col("size").alias("a_size"), F.col("hash").alias("a_hash"))
    both = current.select("path", "size", "hash").join(a, "path", "full")
    same = F.col("size").eqNullSafe(F.col("a_size")) & F.col("hash").eqNullSafe(F.col("a_hash"))
    state = F.when(F.col("a_hash").isNull(), "new").when(F.col("hash").isNull(), "gone").when(same, "kept").otherwise("changed")
    return both.select("path", state.alias("state"), F.coalesce("size", "a_size").alias("size"), F.coalesce("hash", "a_hash").alias("hash"))


def _pack(root: str, pack_bytes: int, level: int):
    """Writes sorted files into packs of about ``pack_bytes``; a row per file with its pack. Bytes come from ``content``, or else as a stream from ``origin``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        rows = (r for b in batches for r in b.itertuples(index=False))
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        while (first := next(rows, None)) is not None:
            done, size = [], 0
            with files.Writing(f"{root}/packs/{attempt}", attempt) as out:
                with zstandard.ZstdCompressor(level=level).stream_writer(out, closefd=False) as packed, tarfile.open(fileobj=packed, mode="w|", format=tarfile.PAX_FORMAT) as tar:
                    for r in itertools.chain([first], rows):
                        info = tarfile.TarInfo(r.path)
                        info.size, info.mtime, info.mode = r.size, 0, 0o644
                        with _content(r) as stream:
                            counted = _Counted(stream)
                            tar.addfile(info, counted)
                            if counted.stream.read(1) or counted.digest.hexdigest() != r.hash:
                                raise ValueError(f"{r.path} has changed while it was archived")
                        done.append((r.path, r.size, r.hash))
                        size += r.size
                        if size >= pack_bytes:
                            break
                name = f"packs/{out.digest.hexdigest()}.tar.zst"
                out.becomes(f"{root}/{name}")
            yield pd.DataFrame([(*d, name, out.size) for d in done], columns=["path", "size", "hash", "pack", "pack_size"])

    return run


def _content(row):
    import io

    return io.BytesIO(bytes(row.content)) if getattr(row, "content", None) is not None else files.open_stream(row.origin)


class _Counted:
    """A stream that hashes what is read."""

    def __init__(self, stream) -> None:
        import hashlib

        self.stream, self.digest, self.size = stream, hashlib.sha256(), 0

    def read(self, n: int = -1) -> bytes:
        data = self.stream.read(n)
        self.digest.update(data)
        self.size += len(data)
        return data


def _members(root: str, target: str | None):
    """Members of packs with their size and hash; written below ``target`` if there is one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        for name in (x for b in batches for x in b["pack"]):
            with files.open_stream(f"{root}/{name}") as raw, zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as data, tarfile.open(fileobj=data, mode="r|") as tar:
                rows = []
                for member in tar:
                    if not member.isfile():
                        continue
                    if member.name.startswith("/") or ".." in member.name.split("/"):
                        raise ValueError(f"{name}: {member.name} lies outside")
                    source = _Counted(tar.extractfile(member))
                    if target is None:
                        while source.read(files.BLOCK):
                            pass
                    else:
                        with files.Writing(f"{target}/{member.name}", attempt) as out:
                            while block := source.read(files.BLOCK):
                                out.write(block)
                    rows.append((member.name, source.size, source.digest.hexdigest(), name))
                    if len(rows) == 1000:
                        yield pd.DataFrame(rows, columns=["path", "size", "hash", "pack"])
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["path", "size", "hash", "pack"])

    return run


class RawArchive:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        return jvm.org.apache.hadoop.fs, jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def manifests(self) -> list[dict]:
        """Manifests of all generations, oldest first; the chain must be whole."""
        hadoop, fs = self._files()
        at = hadoop.Path(f"{self.root}/generations")
        names = sorted(int(f.getPath().getName()[:-5]) for f in fs.listStatus(at) if f.getPath().getName().endswith(".json")) if fs.exists(at) else []
        if names != list(range(1, len(names) + 1)):
            raise ValueError(f"generations {names} aren't a chain")
        out = []
        for n in names:
            stream = fs.open(hadoop.Path(f"{self.root}/generations/{n}.json"))
            try:
                out.append(json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
            finally:
                stream.close()
            if out[-1].get("version") not in (1, 2, 3):
                raise ValueError(f"generation {n}: version {out[-1].get('version')} of the manifest is unknown")
        return out

    def _claim(self, generation: int, manifest: dict) -> None:
        hadoop, fs = self._files()
        fs.mkdirs(hadoop.Path(f"{self.root}/generations"))
        try:
            stream = fs.create(hadoop.Path(f"{self.root}/generations/{generation}.json"), False)
        except Py4JJavaError as error:
            raise RuntimeError(f"generation {generation} has been made by another save") from error
        stream.writeBytes(json.dumps(manifest))
        stream.close()

    def index(self) -> DataFrame:
        """path, size, hash, pack, pack_size, generation of everything archived, by following the chain."""
        out = self.spark.createDataFrame([], f"{INDEX}, generation int")
        for n, manifest in enumerate(self.manifests(), 1):
            out = out.unionByName(self._own(n, manifest).withColumn("generation", F.lit(n)))
        return out

    def _own(self, n: int, manifest: dict) -> DataFrame:
        if manifest["version"] == 3:
            return self.spark.read.schema(INDEX).parquet(f"{self.root}/generations/{n}-{manifest['index']}") if manifest["files"] else self.spark.createDataFrame([], INDEX)
        packs = self.spark.createDataFrame([(p["path"], p["size"], p["hash"]) for p in manifest["packs"]], "pack string, pack_size long, pack_hash string")
        self._require_packs(packs)
        members = spread(self.spark.createDataFrame(packs.select("pack").collect(), "pack string"), "pack").mapInPandas(_members(self.root, None), "path string, size long, hash string, pack string")
        found = stage(members.join(packs.select("pack", "pack_size"), "pack").select("path", "size", "hash", "pack", "pack_size"), "old-index")
        if manifest["version"] == 2 and inventory(found)["inventory"] != manifest["inventory"]:
            raise ValueError(f"generation {n}: members don't give the manifest's inventory")
        return found

    def packs(self) -> DataFrame:
        """pack, pack_size, pack_hash of every pack that an index refers to."""
        named = F.regexp_extract("pack", r"([0-9a-f]{64})\.tar\.zst$", 1)
        own = self.index().select("pack", "pack_size").distinct().withColumn("pack_hash", named)
        old = [(p["path"], p["hash"]) for m in self.manifests() if m["version"] < 3 for p in m["packs"]]
        said = self.spark.createDataFrame(old, "pack string, said string")
        return own.join(said, "pack", "left").select("pack", "pack_size", F.coalesce("said", "pack_hash").alias("pack_hash"))

    def _require_packs(self, packs: DataFrame) -> None:
        hadoop, fs = self._files()
        there = self.spark.createDataFrame([], "path string, size long, hash string")
        if fs.exists(hadoop.Path(f"{self.root}/packs")):
            there = files.hashed(files.listing(self.spark, f"{self.root}/packs")).withColumn("path", F.concat(F.lit("packs/"), F.element_at(F.split("path", "/"), -1)))
        wanted = packs.select(F.col("pack").alias("path"), F.col("pack_size").alias("size"), F.col("pack_hash").alias("hash"))
        require_none(compare_files(wanted, there).where("state NOT IN ('same', 'unexpected')"), "packs that are missing or have changed")

    def save(self, current: DataFrame, pack_bytes: int = 1 << 30, level: int = 3) -> dict:
        """Archives what is new in ``current`` (path, size, hash, and content or origin) as the next generation; returns its manifest."""
        prior = self.manifests()
        require_none(duplicates(current, ["path"]), "paths that repeat")
        archived = stage(self.index().select("path", "size", "hash"), "archived")
        require_none(compare(current, archived).where("state IN ('changed', 'gone')").select("path", "state"), "archived originals that have changed or disappeared")
        new = current.join(archived.select("path"), "path", "left_anti")
        source = [c for c in ("content", "origin") if c in current.columns]
        rows = new.select("path", "size", "hash", *source).repartitionByRange("path").sortWithinPartitions("path")
        generation, name = len(prior) + 1, f"index-{uuid.uuid4().hex[:12]}"
        rows.mapInPandas(_pack(self.root, pack_bytes, level), INDEX).write.option("compression", "zstd").parquet(f"{self.root}/generations/{generation}-{name}")
        own = self.spark.read.schema(INDEX).parquet(f"{self.root}/generations/{generation}-{name}")
        whole = inventory(archived.unionByName(own.select("path", "size", "hash")))
        manifest = {"version": 3, "generation": generation, "parent": generation - 1, "index": name, "files": own.count(), "total_files": whole["files"], "total_bytes": whole["bytes"], "inventory": whole["inventory"]}
        self._claim(generation, manifest)
        return manifest

    def members(self) -> DataFrame:
        """path, size, hash, pack as the packs' bytes give them."""
        return spread(self.index().select("pack").distinct(), "pack").mapInPandas(_members(self.root, None), "path string, size long, hash string, pack string")

    def violations(self) -> DataFrame:
        """Files whose bytes in the packs aren't what the index says."""
        return compare_files(self.index(), self.members()).where("state <> 'same'")

    def restore(self, target: str) -> dict:
        """Writes every archived file below ``target``. Changed packs stop it before the first is written; what is there afterwards
        is held against the index."""
        prior = self.manifests()
        if not prior:
            return {"restored": False, "reason": "nothing is archived"}
        index = stage(self.index(), "index")
        self._require_packs(self.packs())
        if prior[-1]["version"] > 1 and (inventory(index)["inventory"] != prior[-1]["inventory"]):
            raise ValueError("the chain of indexes doesn't give the newest inventory")
        written = spread(index.select("pack").distinct(), "pack").mapInPandas(_members(self.root, target.rstrip("/")), "path string, size long, hash string, pack string")
        require_none(compare_files(index, stage(written, "written")).where("state <> 'same'"), "members that the index doesn't have so")
        require_none(compare_files(index, folder(self.spark, target)).where("state NOT IN ('same', 'unexpected')"), "restored files that differ from the index")
        return {"restored": True, "generations": len(prior), **inventory(index)}
