"""A folder of tables in immutable versions. A change writes its rows under a name of their own and then claims the next version
number; readers see one version throughout, and a writer that is lost, or that another writer has overtaken, leaves the current
one as it was. A version is a list of data folders, so that appending writes only what is new."""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.operators import versions
from foliary.schemas import KEYS, SURVIVING, TABLES

#: Seconds after which a claimed version without content counts as its lost writer's.
ABANDONED = 600


class Conflict(RuntimeError):
    """Another writer has taken the version that this one was to become."""


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm.org.apache.hadoop.fs, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _state(self, name: str) -> tuple[int, list[str], int]:
        """(current version or 0, its folders, next free number). Markers that are claimed but not written don't count; those of
        lost writers, claimed ``ABANDONED`` seconds ago, are passed over."""
        hadoop, fs = self._files()
        folder = hadoop.Path(f"{self.root}/{name}/current")
        markers = sorted(fs.listStatus(folder), key=lambda f: -int(f.getPath().getName())) if fs.exists(folder) else []
        free = 0
        for status in markers:
            number = int(status.getPath().getName())
            stream = fs.open(status.getPath())
            try:
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):
                return number, json.loads(text), max(free, number + 1)
            if time.time() - status.getModificationTime() / 1000 > ABANDONED:
                free = max(free, number + 1)
        return 0, [], max(free, 1)

    def version(self, name: str) -> int:
        """Number of the current version, 0 before the first."""
        return self._state(name)[0]

    def read(self, name: str) -> DataFrame:
        rows = self._read(name, self._state(name)[1])
        return self._with_outcomes(rows) if name == "census_records" else rows

    def _with_outcomes(self, records: DataFrame) -> DataFrame:
        """Census records with the newest outcome of their acquisition: outcomes are appended batch by batch, records stay as they are."""
        folders = self._state("outcomes")[1]
        if not folders:
            return records
        newest = self._read("outcomes", folders).groupBy("record_id").agg(F.max_by(F.struct(*SURVIVING), "n").alias("_new"))
        picked = {c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in SURVIVING}
        return records.join(newest, "record_id", "left").withColumns(picked).select(*records.columns)

    def _read(self, name: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*(f"{self.root}/{name}/{f}" for f in folders))

    def _write(self, name: str, rows: DataFrame) -> str:
        own = self.spark.createDataFrame([], TABLES[name])
        folder = f"data-{uuid.uuid4().hex}"
        own.unionByName(rows, allowMissingColumns=True).select(*own.columns).write.option("compression", "zstd").parquet(f"{self.root}/{name}/{folder}")
        return folder

    def _claim(self, name: str, base: int, folders: list[str]) -> None:
        at, _, free = self._state(name)
        hadoop, fs = self._files()
        fs.mkdirs(hadoop.Path(f"{self.root}/{name}/current"))
        try:
            if at != base:
                raise Conflict(f"{name}: version {at} has followed version {base}")
            stream = fs.create(hadoop.Path(f"{self.root}/{name}/current/{free}"), False)
        except Py4JJavaError as error:
            if "exists" not in str(error.java_exception):
                raise
            raise Conflict(f"{name}: version {free} is claimed") from error
        stream.writeBytes(json.dumps(folders) + "\n")
        stream.close()

    def replace(self, name: str, rows: DataFrame, base: int | None = None) -> None:
        """``rows`` become the table, unless its version is no longer ``base`` (by default the one at the call)."""
        base = self.version(name) if base is None else base
        self._claim(name, base, [self._write(name, rows)])

    def append(self, name: str, rows: DataFrame, attempts: int = 20) -> None:
        """Adds rows; to a version that another writer has made meanwhile they are added too."""
        folder = self._write(name, rows)
        for n in range(attempts):
            at, folders, _ = self._state(name)
            try:
                return self._claim(name, at, [*folders, folder])
            except Conflict:
                if n + 1 == attempts:
                    raise
                time.sleep(0.05 * n)

    def compact(self, name: str) -> None:
        """The same rows in one folder."""
        at, folders, _ = self._state(name)
        if len(folders) > 1 or name == "census_records":
            self.replace(name, self._with_outcomes(self._read(name, folders)) if name == "census_records" else self._read(name, folders), at)

    def append_to(self, name: str, rows: DataFrame, base: int) -> None:
        """Adds rows to exactly the version ``base``; if another writer has followed it, that is a Conflict."""
        folder = self._write(name, rows)
        at, folders, _ = self._state(name)
        self._claim(name, base, [*folders, folder] if at == base else [folder])

    def insert_or_ignore(self, name: str, rows: DataFrame, attempts: int = 5) -> None:
        """Adds the rows whose key isn't there, one per key; only these are written. If another writer has followed the version that was
        read, what is new is found again."""
        keys, own = KEYS[name], self._filled(name, rows)
        for n in range(attempts):
            at, folders, _ = self._state(name)
            new = own.dropDuplicates(keys).join(self._read(name, folders).select(*keys), keys, "left_anti").select(*own.columns)
            folder = self._write(name, new)
            try:
                return self._claim(name, at, [*folders, folder])
            except Conflict:
                if n + 1 == attempts:
                    raise
                time.sleep(0.05 * n)

    def upsert(self, name: str, rows: DataFrame) -> None:
        surviving = SURVIVING if name == "census_records" else []
        at, folders, _ = self._state(name)
        old = self._read(name, folders)
        old = self._with_outcomes(old) if name == "census_records" else old
        self.replace(name, versions.upsert(old, self._filled(name, rows), KEYS[name][0], surviving), at)

    def _filled(self, name: str, rows: DataFrame) -> DataFrame:
        own = self.spark.createDataFrame([], TABLES[name])
        return own.unionByName(rows, allowMissingColumns=True).select(*own.columns)
