"""Proofs that span tables: layers merged by position, a snapshot assembled only if its counts hold, and the chain from a publication's
marker to its attachments as a table of violations."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from foliary.operators import integrity
from foliary.operators.staging import stage


def merge_by_position(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, violations). Both layers are cut at the same range boundaries of ``keys`` and zipped in order: keys, position (from 0), ``left``
    and ``right`` (structs of the other columns; right is null where the layer hasn't come yet). The right layer must be a prefix of the
    left one: within a partition its rows come first, and a partition may have some only if all before it are full (counts are carried
    over the edges). Violations are keys with a problem: gap, unknown, repeated left, repeated right."""
    side = lambda df, name: df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(name))
    both = side(left, "left").unionByName(side(right, "right"), allowMissingColumns=True)
    both = both.withColumn("_l", F.col("left").isNotNull().cast("int")).withColumn("_r", F.col("right").isNotNull().cast("int"))
    placed = stage(both.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "zipped")
    zipped = placed.groupBy("_part", *keys).agg(F.first("left", ignorenulls=True).alias("left"), F.first("right", ignorenulls=True).alias("right"), F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    parts = placed.groupBy("_part").agg(F.count_distinct(*keys).alias("_rows"), F.count_distinct(*(F.when(F.col("_r") == 1, F.col(k)) for k in keys)).alias("_rights"))
    before = lambda c: F.sum(c).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    edges = parts.select("_part", F.coalesce(before("_rows"), F.lit(0)).alias("_before"), F.coalesce(before("_rights"), F.lit(0)).alias("_rights_before"))  # a row per partition
    inside = Window.partitionBy("_part").orderBy(*keys)
    rows = zipped.join(F.broadcast(edges), "_part").withColumn("position", (F.col("_before") + F.row_number().over(inside) - 1).cast("long"))
    rights = F.coalesce(F.sum(F.least("_r", F.lit(1))).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    broken = (F.col("_r") > 0) & (F.col("_rights_before") + rights < F.col("position"))  # a row before this one has no right side
    problem = F.when(F.col("_l") == 0, "unknown").when(F.col("_l") > 1, "repeated left").when(F.col("_r") > 1, "repeated right").when(broken, "gap")
    rows = rows.withColumn("problem", problem)
    return rows.select(*keys, "position", "left", "right"), rows.where("problem IS NOT NULL").select(*keys, "position", "problem")


def require_merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The merged rows; violations raise."""
    rows, wrong = merge_by_position(left, right, keys)
    integrity.require_none(wrong, "layers that don't follow each other")
    return rows


def _create(spark: SparkSession, path: str, content: dict) -> None:
    """A small JSON file that must not be there yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    try:
        stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, False)
    except Py4JJavaError as error:
        raise FileExistsError(path) from error
    stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    stream.close()


def assemble_snapshot(base: DataFrame, fresh: DataFrame, refreshed: Column, path: str, expected: dict, first_pass: DataFrame | None = None, second_pass: DataFrame | None = None, key: str = "record_id") -> dict:
    """A snapshot of ``base`` without its ``refreshed`` rows, and of ``fresh`` in their place. What is expected (base, base_refreshed, fresh: numbers
    of rows), that no id repeats, and the new and removed ids are counted in the pass that writes; the manifest, which makes the
    snapshot count, is made only if they hold. The two passes (page, hash) over the source must agree before anything is written.
    An existing snapshot is never replaced."""
    spark = base.sparkSession
    if first_pass is not None:
        differ = first_pass.select("page", F.col("hash").alias("a")).join(second_pass.select("page", F.col("hash").alias("b")), "page", "full").where(~F.col("a").eqNullSafe(F.col("b")))
        integrity.require_none(differ, "pages on which the two passes don't agree")
    manifest = f"{path.rstrip('/')}.json"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    if hadoop.Path(manifest).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop.Path(manifest)):
        raise FileExistsError(manifest)
    old = F.coalesce(refreshed, F.lit(False))
    mark = lambda df, kind: df.select(F.col(key), kind.alias("_kind"), F.struct(*base.columns).alias("_row"))
    rows = mark(base, F.when(old, "old").otherwise("kept")).unionByName(mark(fresh.select(*base.columns), F.lit("fresh")))
    n = lambda kind: F.count_if(F.col("_kind") == kind).alias(f"_{kind}")
    grouped = rows.groupBy(key).agg(n("old"), n("kept"), n("fresh"), F.max_by("_row", F.when(F.col("_kind") != "old", 1)).alias("_row"))
    seen = Observation()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    observed = grouped.observe(
        seen, total("_old").alias("old"), total("_kept").alias("kept"), total("_fresh").alias("fresh"), F.count_if((F.col("_kept") + F.col("_fresh") > 1) | (F.col("_old") > 1) | F.col(key).isNull()).alias("repeated"),
        F.count_if((F.col("_fresh") > 0) & (F.col("_old") == 0)).alias("new"), F.count_if((F.col("_old") > 0) & (F.col("_fresh") == 0)).alias("removed"),
    )
    name = f"{path.rstrip('/').rsplit('/', 1)[-1]}-{uuid.uuid4().hex[:12]}"
    target = f"{path.rstrip('/').rsplit('/', 1)[0]}/{name}"
    observed.where(F.col("_kept") + F.col("_fresh") > 0).select("_row.*").sortWithinPartitions(key).write.option("compression", "gzip").json(target)
    found = {k: int(v or 0) for k, v in seen.get.items()} or dict.fromkeys(("old", "kept", "fresh", "repeated", "new", "removed"), 0)
    given = {"base": found["old"] + found["kept"], "base_refreshed": found["old"], "fresh": found["fresh"]}
    if found["repeated"] or any(given[k] != v for k, v in expected.items()):
        raise ValueError(f"no snapshot: {found['repeated']} ids repeat; counted {given}, expected {expected}")
    said = {"data": name, "records": found["kept"] + found["fresh"], "new": found["new"], "removed": found["removed"], **given}
    _create(spark, manifest, said)
    return said


def read_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a snapshot whose manifest is there, and as many as it says."""
    said = json.loads("".join(r.value for r in spark.read.text(f"{path.rstrip('/')}.json").collect()))
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(f"{path.rstrip('/').rsplit('/', 1)[0]}/{said['data']}")
    if (n := rows.count()) != said["records"]:
        raise ValueError(f"{path}: {n} records where the manifest has {said['records']}")
    return rows


def publication_violations(spark: SparkSession, scope: dict, marker: dict, sums: DataFrame, files: DataFrame, metadata: dict, documents: DataFrame, pages: DataFrame, members: DataFrame, attachments: DataFrame) -> DataFrame:
    """(check, what, problem) of a publication, along the chain of proof; no row if all holds.

    marker: the fields of ``scope`` must be its own, it must be complete, and its tranche must be the scope's. checksums: ``sums`` (path,
    size, hash) against ``files``. counts: ``metadata`` document_count, page_count, attachment_count. pages (document_sha256, page_number): keys once, well-formed, of
    published documents; every document (document_sha256, size_bytes, record_ids) has pages from 1 without a gap. members (name, size, hash): one ``<sha256>.pdf`` per
    document with its bytes, and no other. attachments (record_id, document_sha256): each leads to a published document that lists the record, and
    every listed record has one."""
    out = []
    say = lambda check, df, what, problem: out.append(df.select(F.lit(check).alias("check"), what.cast("string").alias("what"), problem.alias("problem")))
    tranche = f"data/{scope['house']}/parliament-{scope['parliament']}/session-{scope['session']}/"
    wrong = [(k, "not this scope's") for k in sorted(scope) if marker.get(k) != scope[k]]
    wrong += [("complete", "not complete")] if marker.get("complete") is not True else []
    wrong += [("tranche", "not this scope's")] if not str(marker.get("tranche", "")).startswith(tranche) else []
    say("marker", spark.createDataFrame(wrong, "what string, problem string"), F.col("what"), F.col("problem"))
    say("checksums", integrity.compare_files(sums, files).where("state <> 'same'"), F.col("path"), F.col("state"))
    for name, df in (("document_count", documents), ("page_count", pages), ("attachment_count", attachments)):
        n = df.agg(F.count("*").alias("n")).where(F.col("n") != F.lit(metadata.get(name, -1)))
        say("counts", n, F.lit(name), F.concat(F.col("n").cast("string"), F.lit(f" where {metadata.get(name)} are published")))
    page = F.concat_ws("/", F.coalesce("document_sha256", F.lit("")), F.coalesce(F.col("page_number").cast("string"), F.lit("")))
    keyed = pages.groupBy("document_sha256", "page_number").agg(F.count("*").alias("n"))
    say("pages", keyed.where("n > 1"), page, F.lit("repeated"))
    formed = F.coalesce(F.col("document_sha256").rlike("^[0-9a-f]{64}$") & (F.col("page_number") >= 1), F.lit(False))
    say("pages", keyed.where(~formed), page, F.lit("malformed"))
    known = documents.select("document_sha256", F.lit(True).alias("known"))
    per = keyed.groupBy("document_sha256").agg(F.count("*").alias("n"), F.max("page_number").alias("last"), F.min("page_number").alias("first")).join(known, "document_sha256", "full")
    say("pages", per.where("known IS NULL"), F.col("document_sha256"), F.lit("not a published document"))
    say("pages", per.where("known AND (n IS NULL OR first <> 1 OR last <> n)"), F.col("document_sha256"), F.lit("pages missing"))
    held = members.select(F.regexp_extract("name", r"([^/]*)\.pdf$", 1).alias("document_sha256"), "name", F.col("size").alias("got_size"), F.col("hash").alias("got_hash"))
    member = documents.select("document_sha256", "size_bytes").join(held, "document_sha256", "full")
    state = F.when(F.col("name").isNull(), "missing").when(F.col("size_bytes").isNull(), "unexpected").when((F.col("got_size") != F.col("size_bytes")) | (F.col("got_hash") != F.col("document_sha256")), "other bytes")
    say("members", member.withColumn("state", state).where("state IS NOT NULL"), F.coalesce("name", "document_sha256"), F.col("state"))
    say("members", held.groupBy("name").agg(F.count("*").alias("n")).where("n > 1"), F.col("name"), F.lit("repeated"))
    listed = documents.select("document_sha256", F.explode("record_ids").alias("record_id")).withColumn("listed", F.lit(True))
    mapped = attachments.select("record_id", "document_sha256").distinct().withColumn("attached", F.lit(True)).join(listed, ["record_id", "document_sha256"], "full").join(known, "document_sha256", "left")
    problem = F.when(F.col("attached").isNull(), "record without attachment").when(F.col("known").isNull(), "not a published document").when(F.col("listed").isNull(), "document doesn't list the record")
    say("attachments", mapped.withColumn("problem", problem).where("problem IS NOT NULL"), F.col("record_id"), F.col("problem"))
    return reduce(DataFrame.unionByName, out)
