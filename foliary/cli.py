"""Commands over a store: ``python -m foliary.cli --store DIR COMMAND ...``; each prints one JSON object or writes a table."""

from __future__ import annotations

import argparse
import importlib
import importlib.util
import json
import time
from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from foliary.operators import acquire, adjudicate, archive, publish, workflow
from foliary.operators.store import Store
from foliary.schemas import TABLES
from foliary.sources import documents, snapshots
from foliary.sources.http_json import NumberedJson, PagedJson


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="foliary")
    p.add_argument("--store", required=True)
    c = p.add_subparsers(dest="command", required=True)
    c.add_parser("init")
    c.add_parser("ingest").add_argument("path")
    c.add_parser("ingest-manifest").add_argument("path")
    for name in ("acquire-census", "download"):
        x = c.add_parser(name)
        x.add_argument("--batch", type=int, default=1000)
        x.add_argument("--seconds", type=float, default=0, help="stop before the next batch after so many")
        x.add_argument("--retry-failed", action="store_true")
        x.add_argument("--least-free", type=int, default=0, help="bytes that must be free")
    x = c.add_parser("process")
    x.add_argument("--extractor", required=True, help="module:attribute of a page extractor")
    x.add_argument("--config")
    c.add_parser("status")
    for name in ("scope-status", "prepare-publication", "verify-publication"):
        x = c.add_parser(name)
        if name != "verify-publication":
            x.add_argument("--house", required=True)
            x.add_argument("--parliament", default="")
            x.add_argument("--session", required=True)
        if name != "scope-status":
            x.add_argument("path")
            x.add_argument("--policy", choices=["local", "model"], default="local")
    x = c.add_parser("export-jsonl")
    x.add_argument("path")
    x.add_argument("--accepted-only", action="store_true")
    x.add_argument("--with-adjudications", action="store_true")
    x = c.add_parser("import-census")
    x.add_argument("path")
    for option in ("source", "house", "parliament", "session", "expected-sha256"):
        x.add_argument(f"--{option}")
    x.add_argument("--offset", type=int, default=0)
    x.add_argument("--limit", type=int, default=0)
    x = c.add_parser("census-repository")
    x.add_argument("url")
    x.add_argument("--page-size", type=int, default=100)
    x.add_argument("--pages", type=int, default=0)
    x = c.add_parser("census-modern")
    x.add_argument("url")
    x.add_argument("--scope", action="append", default=[], help="parliament/session; may be repeated")
    x.add_argument("--retry-failed", action="store_true")
    x.add_argument("--page-size", type=int, default=100)
    c.add_parser("census-questions").add_argument("path")
    c.add_parser("export-census").add_argument("path")
    c.add_parser("census-status")
    c.add_parser("estimate-storage")
    x = c.add_parser("adjudicate")
    x.add_argument("--client", required=True, help="module:attribute of a model client")
    x.add_argument("--models", required=True, help="in the order they are tried, with commas")
    x.add_argument("--pages", choices=["review", "ocr", "all"], default="review")
    x.add_argument("--instruction", default="")
    x.add_argument("--limit-pages", type=int)
    x.add_argument("--ceiling", type=Decimal, default=Decimal(0))
    x.add_argument("--reserve", type=Decimal, default=Decimal(0), help="the most that one call can cost")
    x.add_argument("--force", action="store_true", help="pages that a model has answered too")
    x = c.add_parser("archive-save")
    x.add_argument("archive")
    x.add_argument("path")
    x = c.add_parser("archive-restore")
    x.add_argument("archive")
    x.add_argument("path")
    c.add_parser("doctor")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("foliary").getOrCreate()
    store = Store(spark, a.store)
    out = run(a, store)
    print(json.dumps(out, default=str, sort_keys=True))
    return out


def run(a: argparse.Namespace, store: Store) -> dict:
    if a.command == "init":
        for name in TABLES:
            if not store.version(name):
                store.replace(name, store.read(name))
        return {"tables": sorted(TABLES)}
    if a.command == "ingest":
        rejected = [r.asDict() for r in documents.not_originals(store.spark, a.path).orderBy("path").collect()]
        return {"documents": workflow.ingest(store, a.path).count()} | ({"rejected": rejected} if rejected else {})
    if a.command == "ingest-manifest":
        return {"entries": acquire.ingest_manifest(store, a.path), "documents": store.read("documents").count()}
    if a.command in ("acquire-census", "download"):
        deadline = time.time() + a.seconds if a.seconds else None
        return acquire.drain(store, a.batch, deadline, a.retry_failed, a.least_free)
    if a.command == "process":
        module, _, name = a.extractor.partition(":")
        config = {}
        if a.config:
            with open(a.config) as f:
                config = snapshots.load_config(f.read()).extraction
        return {"processed": workflow.process(store, getattr(importlib.import_module(module), name), config)}
    if a.command == "status":
        return workflow.status(store)
    if a.command == "scope-status":
        s = workflow.scope_status(store, a.house, a.parliament, a.session)
        return s | workflow.verdict(store.spark, s)
    if a.command == "export-jsonl":
        publish.write_json_lines(workflow.export_pages(store, a.accepted_only, a.with_adjudications), a.path)
        return {"written": a.path}
    if a.command == "import-census":
        rows = snapshots.import_snapshot(store.spark, a.path, a.source, a.house, a.parliament, a.session, a.offset, a.limit, a.expected_sha256)
        store.upsert("census_records", rows.withColumn("acquisition_status", F.coalesce("acquisition_status", F.lit("discovered"))))
        return {"records": store.read("census_records").count()}
    if a.command == "census-repository":
        store.spark.dataSource.register(PagedJson)
        return {"run": workflow.census_repository(store, a.url, a.page_size, a.pages)}
    if a.command == "census-modern":
        store.spark.dataSource.register(NumberedJson)
        scopes = workflow.failed_scopes(store) if a.retry_failed else [tuple(x.split("/")) for x in a.scope]
        return workflow.census_modern(store, a.url, scopes, a.page_size)
    if a.command == "census-questions":
        return {"records": workflow.census_questions(store, a.path)}
    if a.command == "export-census":
        snapshots.export_snapshot(store.read("census_records"), a.path)
        return {"written": a.path}
    if a.command == "census-status":
        r = store.read("census_records")
        groups = r.groupBy("source_type", "house", "acquisition_status").agg(F.count("*").alias("n")).orderBy("source_type", "house", "acquisition_status")
        recent = store.read("census_runs").orderBy(F.desc("id")).limit(10)
        scopes = store.read("census_scopes").join(recent.select(F.col("id").alias("run_id")), "run_id", "left_semi").groupBy("run_id", "status").agg(F.count("*").alias("n"))
        totals = r.agg(F.count("*").alias("records"), F.count_distinct("source_url").alias("urls"), F.count_if(F.col("source_url") == "").alias("without_url"))
        return {"groups": [g.asDict() for g in groups.collect()], "runs": [g.asDict() for g in recent.collect()], "scopes": [g.asDict() for g in scopes.collect()], **totals.first().asDict()}
    if a.command == "estimate-storage":
        d = store.read("documents").where("size_bytes > 0").agg(F.count("*").alias("samples"), F.min("size_bytes").alias("least"), F.median("size_bytes").alias("middle"), F.avg("size_bytes").alias("mean"), F.max("size_bytes").alias("most")).first().asDict()
        return d | {"projected": (d["mean"] or 0) * store.read("census_records").count()}
    if a.command == "prepare-publication":
        return workflow.prepare_publication(store, a.path, a.house, a.parliament, a.session, a.policy).first().asDict()
    if a.command == "verify-publication":
        return {"problems": [r.asDict() for r in workflow.verify_publication(store, a.path).collect()]}
    if a.command == "adjudicate":
        module, _, name = a.client.partition(":")
        models = [m.strip() for m in a.models.split(",") if m.strip()]
        requests = adjudicate.page_requests(store, a.pages, a.instruction, a.limit_pages, models, a.force)
        return adjudicate.adjudicate(store, getattr(importlib.import_module(module), name), requests, models, adjudicate.Budget(a.ceiling, a.reserve))
    if a.command == "archive-save":
        return archive.RawArchive(store.spark, a.archive).save(archive.folder(store.spark, a.path))
    if a.command == "archive-restore":
        return archive.RawArchive(store.spark, a.archive).restore(a.path)
    if a.command == "doctor":
        return doctor(store)
    raise ValueError(a.command)


def doctor(store: Store) -> dict:
    """What this installation has: versions, optional libraries, the shared folder, and the store's tables by their versions."""
    context = store.spark.sparkContext
    folder = store.spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    found = {name: importlib.util.find_spec(name) is not None for name in ("pyarrow", "pandas", "numpy", "zstandard")}
    tables = {name: store.version(name) for name in TABLES}
    local = context.master == "local" or context.master.startswith("local[")
    problems = [f"{name} is missing" for name, there in found.items() if not there] + ([] if folder or local else ["spark.checkpoint.dir is not set"])
    return {"spark": store.spark.version, "java": context._jvm.System.getProperty("java.version"), "master": context.master, "shared_folder": folder, "libraries": found, "tables": tables, "problems": problems}


if __name__ == "__main__":
    main()
