"""Layers over a stable page inventory: immutable shards of a fixed number of rows, each with a manifest row, written in order,
resumed after the last whole shard, and verified whenever they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.operators import integrity
from foliary.operators.staging import stage

#: Files that make a published tranche complete.
TRANCHE = ("documents.parquet", "pages.parquet", "manifest.jsonl", "SHA256SUMS")
MANIFEST = "shard long, first long, last long, n_rows long, digest string, layer string, origins string"


def page_key(document: Column, page: Column) -> Column:
    return F.concat_ws(":", document, page.cast("string"))


def inventory(pages: DataFrame, records: DataFrame) -> DataFrame:
    """position, key, document_sha256, page_number of a scope's pages in a fixed order. pages: current pages; records: the
    scope's census records (document_sha256, acquisition_status). A scope with records that were not acquired, documents without
    pages, or pages that don't number from 1 on without a gap is refused."""
    open_ = records.where("acquisition_status IS NULL OR acquisition_status <> 'downloaded' OR document_sha256 IS NULL")
    integrity.require_none(open_, "records that are not acquired")
    wanted = records.select("document_sha256").distinct()
    own = pages.join(wanted, "document_sha256", "left_semi").select("document_sha256", F.col("page_number").cast("long").alias("page_number"))
    counted = own.groupBy("document_sha256").agg(F.count("*").alias("n"), F.count_distinct("page_number").alias("different"), F.min("page_number").alias("first"), F.max("page_number").alias("last"))
    state = wanted.join(counted, "document_sha256", "left")
    integrity.require_none(state.where("n IS NULL OR n <> different OR first <> 1 OR last <> n"), "documents without all their pages")
    return integrity.positions(own.withColumn("key", page_key(F.col("document_sha256"), F.col("page_number"))), ["document_sha256", "page_number"])


def with_shards(rows: DataFrame, size: int) -> DataFrame:
    return rows.withColumn("shard", integrity.chunk(F.col("position"), size))


def origin_counts(origin: str) -> Column:
    """``name:count`` of each origin of a shard's rows, by name and parted by commas; null origins don't count."""
    all_ = F.collect_list(origin)
    names = F.array_sort(F.array_distinct(all_))
    return F.array_join(F.transform(names, lambda x: F.concat(x, F.lit(":"), F.size(F.filter(all_, lambda y: y == x)).cast("string"))), ",")


def digests(rows: DataFrame, layer: str, origin: str | None = None) -> DataFrame:
    """A manifest row per shard: first and last position, rows, a digest over the rows' JSON in order of position, and how many rows
    come from each value of the column ``origin``, if there is one."""
    line = F.struct("position", F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(rows.columns) if c != "shard"))), 256).alias("h"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["h"]), "\n")
    return rows.groupBy("shard").agg(F.min("position").alias("first"), F.max("position").alias("last"), F.count("*").alias("n_rows"), F.sha2(joined, 256).alias("digest"), (origin_counts(origin) if origin else F.lit(None).cast("string")).alias("origins")).select("shard", "first", "last", "n_rows", "digest", F.lit(layer).alias("layer"), "origins")


def manifest_problems(manifest: DataFrame, size: int, total: int) -> DataFrame:
    """Manifest rows that don't follow each other without a gap in shards of ``size`` (the last may be shorter)."""
    first = F.col("shard") * size
    last = F.least(first + size, F.lit(total)) - 1
    wrong = manifest.where((F.col("first") != first) | (F.col("last") != last) | (F.col("n_rows") != last - first + 1)).select("shard", F.lit("bounds").alias("problem"))
    twice = manifest.groupBy("shard").count().where("count > 1").select("shard", F.lit("repeated").alias("problem"))
    bounds = manifest.agg(F.coalesce(F.max("shard"), F.lit(-1)).alias("top"), F.count_distinct("shard").alias("n"))
    gap = bounds.where("top + 1 <> n").select(F.col("top").alias("shard"), F.lit("gap").alias("problem"))
    return wrong.unionByName(twice).unionByName(gap)


class Layer:
    """A folder with shards (rows) and manifest. Rows are added in order of position; a shard is there once its manifest row is.
    ``origin``: a column of the layer whose values are counted per shard; a manifest row without counts is not held to them."""

    def __init__(self, spark, path: str, name: str, schema: str, size: int = 100, origin: str | None = None) -> None:
        self.spark, self.path, self.name, self.size, self.origin = spark, path.rstrip("/"), name, size, origin
        self.schema = f"position long, key string, {schema}, shard long"

    def _read(self, what: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{what}")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def manifest(self) -> DataFrame:
        return self._read("manifest", MANIFEST)

    def next_position(self) -> int:
        """Where the layer goes on: after its last whole shard."""
        row = self.manifest().where(F.col("n_rows") == self.size).agg(F.max("shard")).first()
        return 0 if row[0] is None else (row[0] + 1) * self.size

    def add(self, rows: DataFrame, total: int) -> int:
        """Write the whole shards that ``rows`` (position, key and the layer's columns) give; ``total``: rows of the inventory. Rows
        read back must give the digests computed before writing, or nothing enters the manifest. Shards that are there already
        stay as they are. Returns the number of new shards."""
        here = self.manifest().select("shard")
        new = with_shards(rows.select(*(c.split()[0] for c in self.schema.split(", ")[:-1])), self.size).join(here, "shard", "left_anti")
        new = stage(new, "layer-rows")
        found = digests(new, self.name, self.origin)
        full = F.least((F.col("shard") + 1) * self.size, F.lit(total)) - F.col("shard") * self.size
        found = stage(found.where(F.col("n_rows") == full), "layer-digests")
        integrity.require_none(manifest_problems(self.manifest().unionByName(found), self.size, total), "shards that don't follow each other")
        kept = new.join(found.select("shard"), "shard", "left_semi")
        low = found.agg(F.min("shard")).first()[0]
        if low is None:
            return 0
        target = f"shards/{low}"
        kept.repartition("shard").sortWithinPartitions("position").write.mode("overwrite").option("compression", "gzip").json(f"{self.path}/{target}")
        back = digests(self.spark.read.schema(self.schema).json(f"{self.path}/{target}"), self.name, self.origin)
        integrity.require_none(found.exceptAll(back).unionByName(back.exceptAll(found)), "shards that read back differently")
        found.write.mode("append").parquet(f"{self.path}/manifest")
        return found.count()

    def read(self, inventory: DataFrame) -> DataFrame:
        """The layer's rows, after all checks: contiguous manifest, digests, and exactly the inventory's keys at its positions."""
        total = inventory.count()
        manifest = self.manifest()
        integrity.require_none(manifest_problems(manifest, self.size, total), "shards that don't follow each other")
        folders = f"{self.path}/shards/*"
        rows = self.spark.read.schema(self.schema).option("mode", "FAILFAST").json(folders).join(manifest.select("shard"), "shard", "left_semi")
        rows = stage(rows.select(*(c.split()[0] for c in self.schema.split(", "))), "layer")
        found = digests(rows, self.name, self.origin)
        integrity.require_none(found.select("shard", "n_rows", "digest").exceptAll(manifest.select("shard", "n_rows", "digest")), "shards that differ from their manifest")
        if self.origin:
            said = manifest.where("origins IS NOT NULL").select("shard", F.col("origins").alias("said"))
            integrity.require_none(said.join(found, "shard").where(F.col("said") != F.col("origins")).select("shard", "said", "origins"), "shards with other origins than their manifest says")
        wrong = inventory.select("position", F.col("key").alias("wanted")).join(rows.select("position", "key"), "position", "full").where(~F.col("wanted").eqNullSafe(F.col("key")))
        integrity.require_none(wrong, "rows that are missing, or that the inventory doesn't have")
        return rows


def layer_root(files: DataFrame, prefix: str) -> str:
    """The one root under ``prefix`` that holds shard manifests (part-*.json) in a listing (path); none or several are an error."""
    root = F.regexp_extract("path", r"^(.*)/part-[^/]*\.json$", 1).alias("root")
    roots = files.where(F.col("path").startswith(prefix)).select(root).where("root <> ''").distinct().orderBy("root").limit(6).collect()
    if len(roots) != 1:
        raise ValueError(f"one layer under {prefix} expected, found {[r.root for r in roots]}")
    return roots[0].root


def same_inventory(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether two sources (three fields each: inventory digest, revision, pages) are the same and well-formed."""
    fields = ("inventory_sha256", "revision", "pages")
    same = F.lit(True)
    for f in fields:
        same = same & a[f].isNotNull() & (a[f].cast("string") != "") & (a[f] == b[f])
    return F.coalesce(same & a["inventory_sha256"].rlike("^[0-9a-f]{64}$"), F.lit(False))


def tranche_present(names: Column, prefix: Column) -> Column:
    """All files of a tranche stand under its prefix."""
    here = F.transform(F.filter(names, lambda n: n.startswith(prefix)), lambda n: F.regexp_replace(F.substr(n, F.length(prefix) + 1), "^/", ""))
    return F.forall(F.array(*map(F.lit, TRANCHE)), lambda f: F.array_contains(here, f))


#: Kinds of markers by the end of their names.
MARKERS = {"session-complete": ".complete.json", "snapshot-complete": ".snapshot.json", "skipped": ".skipped.json"}


def marker_valid(path: Column, kind: Column, complete: Column, reason: Column) -> Column:
    """A marker's path must end as its kind says; a complete one needs its proof, a skipped one a reason."""
    ends = F.lit(False)
    for name, end in MARKERS.items():
        ends = ends | ((kind == name) & path.endswith(end))
    proof = F.when(kind == "skipped", F.coalesce(reason, F.lit("")) != "").otherwise(F.coalesce(complete, F.lit(False)))
    return F.coalesce(ends & proof, F.lit(False))


def completion_evidence(scopes: DataFrame, markers: DataFrame, files: DataFrame) -> DataFrame:
    """Per scope (scope, prefix): whether it has a valid marker (scope, path, kind, complete, reason) and all files (path)."""
    valid = markers.where(marker_valid(*(F.col(c) for c in ("path", "kind", "complete", "reason")))).select("scope").distinct().withColumn("marked", F.lit(True))
    names = files.withColumn("prefix", F.regexp_replace("path", "/[^/]+$", "")).groupBy("prefix").agg(F.collect_set("path").alias("names"))
    joined = scopes.join(valid, "scope", "left").join(names, "prefix", "left")
    present = F.coalesce(tranche_present(F.col("names"), F.col("prefix")), F.lit(False))
    marked = F.coalesce("marked", F.lit(False))
    return joined.select("scope", marked.alias("marked"), present.alias("files_present"), (marked & present).alias("complete"))
