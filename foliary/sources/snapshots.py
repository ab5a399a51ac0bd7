"""Census snapshots (JSON lines, gzip too), manifests, markers and logs."""

from __future__ import annotations

import hashlib
import json
import tomllib
from dataclasses import dataclass, field, fields
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.operators.integrity import duplicates, positions, require_none
from foliary.sources import files

RECORD = (
    "record_id string, source_type string, house string, parliament_number string, session string, document_number string, document_subtype string, document_date string, title string, ministry string, "
    "members array<string>, language string, source_url string, official_page_url string, api_url string, api_params map<string,string>, raw string, discovered_at timestamp, acquisition_status string, document_sha256 string, last_error string"
)


def file_digest(spark: SparkSession, path: str) -> str:
    """SHA-256 of one file's bytes, read by Spark wherever it lies."""
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("h")).first().h


def import_snapshot(spark: SparkSession, path: str, source: str | None = None, house: str | None = None, parliament: str | None = None, session: str | None = None, offset: int = 0, limit: int = 0, expected_sha256: str | None = None) -> DataFrame:
    """Records of a snapshot in the order of their ids; a bad line or a repeated id is an error."""
    if expected_sha256 and file_digest(spark, path) != expected_sha256:
        raise ValueError(f"{path}: SHA-256 isn't the expected one")
    rows = spark.read.schema(RECORD).option("mode", "FAILFAST").json(path)
    same = lambda c, v: F.coalesce(F.col(c), F.lit("")) == v
    for column, value in (("house", house), ("parliament_number", parliament), ("session", session)):
        if value is not None:
            rows = rows.where(same(column, value))
    if source == "elibrary":
        rows = rows.where(F.col("record_id").startswith("elibrary_"))
    elif source == "modern":
        rows = rows.where(~F.col("record_id").startswith("elibrary_"))
    require_none(duplicates(rows, ["record_id"]), "record ids repeat")
    if offset or limit:
        rows = positions(rows, ["record_id"]).where((F.col("position") >= offset) & (F.lit(not limit) | (F.col("position") < offset + limit))).drop("position")
    return rows


def export_snapshot(records: DataFrame, path: str) -> None:
    """JSON lines, gzip, in the order of record ids within and over files."""
    records.repartitionByRange("record_id").sortWithinPartitions("record_id").write.mode("overwrite").option("compression", "gzip").json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest's ``samples`` or ``documents`` list."""
    x = spark.read.option("wholetext", True).text(path).select(F.from_json("value", "struct<samples:array<map<string,string>>,documents:array<map<string,string>>>").alias("m"))
    return x.select(F.explode(F.coalesce("m.samples", "m.documents")).alias("e")).select(F.col("e")["file"].alias("file"), F.col("e")["url"].alias("url"), F.col("e")["sha256"].alias("sha256"))


def markers(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Scopes (house, parliament, session) of the marker files under a path, by their names, with their content."""
    x = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    scope = r"(?:elibrary-)?([a-z_]+)-p([^/-]*)-s([^/.-]+)"
    return x.select("file", *(F.regexp_extract("file", scope, i + 1).alias(n) for i, n in enumerate(("house", "parliament", "session"))), "value").where("house <> ''")


def last_json(text: str) -> dict:
    """Last JSON object in a log."""
    at = text.rfind("\n{") + 1
    while True:
        try:
            return json.loads(text[at:])
        except ValueError:
            if at <= 0:
                raise
            at = max(text.rfind("\n{", 0, at - 1) + 1, 0)


def archive_index(spark: SparkSession, path: str, exclude: str = r"\.(?:lock|tmp)$") -> DataFrame:
    """path, bytes and SHA-256 of every file under a folder; files are read in blocks."""
    return files.hashed(files.listing(spark, path).where(~F.col("path").rlike(exclude)))


def inventory_digest(rows: list[tuple[str, int, str]]) -> str:
    """SHA-256 over sorted path, bytes and hash, parted by zero bytes."""
    return hashlib.sha256("".join(f"{p}\0{n}\0{h}\n" for p, n, h in sorted(rows)).encode()).hexdigest()


def settings(text: str) -> dict[str, str]:
    """NAME=value lines of a settings file; blank lines and comments don't count, quotes around a value go."""
    lines = (x.strip() for x in text.splitlines())
    pairs = (x.split("=", 1) for x in lines if x and not x.startswith("#") and "=" in x)
    return {k.strip(): v.strip().strip('"').strip("'") for k, v in pairs if k.strip()}


def fill(environment: dict[str, str], text: str) -> None:
    """Settings that the environment doesn't have yet; the first of a repeated name counts."""
    lines = [x for x in text.splitlines() if x.strip()]
    for line in lines:
        for name, value in settings(line).items():
            environment.setdefault(name, value)


@dataclass(frozen=True)
class Config:
    """Settings by section; unknown keys are an error, but in ``routing`` they are left out."""

    storage: dict = field(default_factory=dict)
    routing: dict = field(default_factory=dict)
    validation: dict = field(default_factory=dict)
    extraction: dict = field(default_factory=dict)

    KNOWN: ClassVar[dict] = {"storage": {"data_root"}, "routing": {"least_characters", "least_alphanumeric", "full_page_images", "ocr_reasons"}, "validation": {"most_replacement_characters", "least_confidence", "uneven_tables", "numeric"}, "extraction": {"dpi", "language", "workers", "chunk"}}


def load_config(text: str) -> Config:
    found = tomllib.loads(text)
    out = {}
    for section in (f.name for f in fields(Config)):
        values = found.get(section, {})
        unknown = set(values) - Config.KNOWN[section]
        if unknown and section != "routing":
            raise ValueError(f"unknown settings in {section}: {sorted(unknown)}")
        out[section] = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k not in unknown}
    return Config(**out)
