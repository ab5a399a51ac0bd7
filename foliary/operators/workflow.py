"""The engine's work on a store: ingest, process, status, export, publication. All plans are joins and aggregations of tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.functions import rules
from foliary.functions import text as X
from foliary.operators import integrity, publish, staging, versions
from foliary.operators.store import Conflict, Store
from foliary.sources import documents as originals_source
from foliary.sources import payloads


def in_scope(house: str, parliament: str, session: str) -> Column:
    """Scope of census records; a null parliament counts as empty."""
    return (F.col("house") == house) & (F.coalesce("parliament_number", F.lit("")) == parliament) & (F.col("session") == session)


def latest_runs(store: Store) -> DataFrame:
    """(document_sha256, run_id) of each document's latest complete run."""
    return store.read("runs").where("status = 'complete'").groupBy("document_sha256").agg(F.max("id").alias("run_id"))


def current_pages(store: Store) -> DataFrame:
    return store.read("pages").join(latest_runs(store), "run_id")


def ingest(store: Store, path: str) -> DataFrame:
    """Register the PDF files under a path; the same bytes are one document with several sources. Returns the new state; what
    isn't a PDF is in ``documents.not_originals``."""
    files = originals_source.originals(store.spark, path)
    originals_source.store(files, f"{store.root}/originals")
    rows = files.select("sha256", "size_bytes", F.lit("application/pdf").alias("media_type"), F.col("path").alias("raw_path"), F.current_timestamp().alias("created_at"))
    store.insert_or_ignore("documents", rows)
    store.insert_or_ignore("sources", files.select(F.col("sha256").alias("document_sha256"), F.col("path").alias("source_uri"), F.element_at(F.split("path", "/"), -1).alias("original_name"), F.current_timestamp().alias("acquired_at"), F.lit("{}").alias("metadata_json")))
    return store.read("documents")


def pending(store: Store, config_json: str) -> DataFrame:
    """Documents without a complete run under exactly this configuration."""
    done = store.read("runs").where((F.col("status") == "complete") & (F.col("config_json") == config_json)).select(F.col("document_sha256").alias("sha256"))
    return store.read("documents").join(done, "sha256", "left_anti")


def process(store: Store, extractor: originals_source.PageExtractor, config: dict, routing: rules.RoutingRules = rules.RoutingRules(), validation: rules.ValidationRules = rules.ValidationRules()) -> int:
    """Extract, route and validate the pages of pending documents; a document with a failed page has a failed run. Run ids are claimed by
    rows of state running before any work begins, so that two calls at once take different ones; the end of a run is a further row:
    complete, failed (with its error), or interrupted."""
    config_json = json.dumps(config, sort_keys=True, ensure_ascii=False)
    todo = _claim_runs(store, config_json)
    state = lambda status, error: store.append("runs", todo.select(F.col("run_id").alias("id"), F.col("sha256").alias("document_sha256"), F.lit(status).alias("status"), F.lit(config_json).alias("config_json"), F.current_timestamp().alias("finished_at"), F.lit(error).cast("string").alias("error")))
    try:
        _process(store, extractor, todo, config_json, routing, validation)
    except KeyboardInterrupt:
        state("interrupted", None)
        raise
    except Exception as error:
        state("failed", f"{type(error).__name__}: {error}"[:2000])
        raise
    return todo.count()


def _claim_runs(store: Store, config_json: str, attempts: int = 20) -> DataFrame:
    """(sha256, run_id) of the pending documents, staged; their runs stand in the store as running."""
    for n in range(attempts):
        at = store.version("runs")
        base = store.read("runs").agg(F.max("id")).first()[0] or 0
        todo = integrity.positions(pending(store, config_json).select("sha256"), ["sha256"]).select("sha256", (F.col("position") + 1 + base).alias("run_id"))
        todo = staging.stage(todo, "runs")
        try:
            store.append_to("runs", todo.select(F.col("run_id").alias("id"), F.col("sha256").alias("document_sha256"), F.lit("running").alias("status"), F.lit(config_json).alias("config_json"), F.current_timestamp().alias("started_at")), at)
            return todo
        except Conflict:
            if n + 1 == attempts:
                raise


def current_runs(store: Store) -> DataFrame:
    """Runs in their newest state: running ones have no later row."""
    order = F.when(F.col("status") == "running", 0).otherwise(1)
    newest = store.read("runs").groupBy("id").agg(F.max_by(F.struct("document_sha256", "status", "config_json", "finished_at", "error"), order).alias("x"), F.min("started_at").alias("started_at"))
    return newest.select("id", "x.document_sha256", "x.status", "x.config_json", "started_at", "x.finished_at", "x.error")


def _process(store: Store, extractor: originals_source.PageExtractor, todo: DataFrame, config_json: str, routing: rules.RoutingRules, validation: rules.ValidationRules) -> None:
    files = store.spark.read.parquet(f"{store.root}/originals").select("sha256", "content").join(todo.select("sha256"), "sha256", "left_semi")
    routed = lambda p: p.withColumn("route", rules.route(rules.route_reasons(F.col("text"), F.col("reasons"), F.col("full_page_image"), routing)))
    work = f"{store.root}/work/{uuid.uuid4().hex}"
    originals_source.two_pass(files, extractor, routed).write.mode("overwrite").parquet(work)
    pages = store.spark.read.parquet(work).join(todo.withColumnRenamed("sha256", "document_sha256"), "document_sha256")
    found = rules.page_flags(F.col("selected_text"), F.col("selected_markdown"), F.col("route"), F.col("confidence"), F.col("native_text"), validation)
    good = pages.where("error IS NULL").withColumn("flags", found)
    store.append("pages", good.select(
        "run_id", "page_number", "route", F.lit("plugin").alias("engine"), F.col("selected_text").alias("text"), F.col("selected_markdown").alias("markdown"), F.length("selected_text").alias("text_chars"), F.col("confidence").alias("mean_confidence"),
        rules.page_status(F.col("flags")).alias("validation_status"), "flags",
    ))
    failed = pages.where("error IS NOT NULL").groupBy("run_id").agg(F.min("error").alias("error"))
    store.append("runs", todo.join(failed, "run_id", "left").select(F.col("run_id").alias("id"), F.col("sha256").alias("document_sha256"), F.when(F.col("error").isNull(), "complete").otherwise("failed").alias("status"), F.lit(config_json).alias("config_json"), F.current_timestamp().alias("finished_at"), "error"))


def status(store: Store) -> dict:
    """Counts of the whole store, one pass per table."""
    out = {"documents": store.read("documents").count(), "sources": store.read("sources").count()}
    out |= {f"runs_{r.status}": r.n for r in current_runs(store).groupBy("status").agg(F.count("*").alias("n")).collect()}
    out |= current_pages(store).agg(F.count("*").alias("pages"), F.count_if(F.col("route") == "ocr").alias("ocr_pages"), F.count_if(F.col("validation_status") == "review").alias("review_pages")).first().asDict()
    out |= store.read("adjudications").agg(F.count("*").alias("adjudications"), F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("reported_cost").cast("double"), F.lit(0.0)).alias("cost")).first().asDict()
    return out


def scope_status(store: Store, house: str, parliament: str, session: str) -> dict:
    """A scope's counts. The census state is looked up by strict equality, as records and scopes may spell it differently."""
    records = store.read("census_records").where(in_scope(house, parliament, session))
    order = F.when(F.col("status") == "pending", 0).when(F.col("status") == "running", 1).otherwise(2)  # states of one run are rows
    census = store.read("census_scopes").where((F.col("house") == house) & (F.col("parliament_number") == parliament) & (F.col("session") == session)).agg(F.max_by("status", F.struct("run_id", order)).alias("s")).first().s
    html = F.lower("source_url").contains(".htm") & F.lower("last_error").contains("not a pdf:") & (F.col("acquisition_status") == "failed")
    counts = records.agg(F.count("*").alias("records"), *(F.count_if(F.col("acquisition_status") == s).alias(s) for s in ("discovered", "downloaded", "failed")), F.count_if(html).alias("unsupported_html")).first().asDict()
    docs = records.where("document_sha256 IS NOT NULL").select("document_sha256").distinct().join(store.read("documents").withColumnRenamed("sha256", "document_sha256"), "document_sha256").join(latest_runs(store), "document_sha256", "left")
    counts |= docs.agg(F.count("*").alias("acquired_documents"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("raw_bytes"), F.count("run_id").alias("processed_documents")).first().asDict()
    a = store.read("adjudications").groupBy("run_id", "page_number").agg(F.count_if(F.col("provider") == "openrouter").alias("first"), F.count_if(F.col("provider") == "nvidia").alias("second"))
    pages = store.read("pages").join(docs.select("run_id"), "run_id").join(a, ["run_id", "page_number"], "left")
    counts |= pages.agg(F.count("*").alias("pages"), F.count_if(F.col("route") == "ocr").alias("ocr_pages"), F.count_if(F.col("validation_status") == "review").alias("review_pages"), F.count_if(F.col("first") > 0).alias("adjudicated_pages"), F.coalesce(F.sum("second"), F.lit(0)).alias("second_adjudications")).first().asDict()
    return {"census_status": census, **counts}


def verdict(spark, s: dict, path: str = "", limited: bool = False) -> dict:
    """Skip reason, readiness and completeness of a scope's status."""
    s = {k: v for k, v in s.items() if k == "census_status" or isinstance(v, int) and not isinstance(v, bool)}
    row = spark.createDataFrame([s], "census_status string, " + ", ".join(f"{k} long" for k in s if k != "census_status"))
    c = {k: F.col(k) for k in s}
    return row.select(rules.skip_reason(c).alias("skip_reason"), rules.publication_ready(c, limited).alias("publication_ready"), rules.session_complete(c, path).alias("session_complete")).first().asDict()


def export_pages(store: Store, accepted_only: bool = False, with_adjudications: bool = False) -> DataFrame:
    """Current pages in four modes: all or accepted ones, with the newest adjudication of any provider or without."""
    pages = current_pages(store)
    if with_adjudications:
        newest = versions.latest(store.read("adjudications").select("run_id", "page_number", "id", "provider", "model", F.col("text").alias("adjudicated_markdown"), "total_tokens", "reported_cost"), ["run_id", "page_number"], "id")
        pages = pages.join(newest, ["run_id", "page_number"], "left")
        source = F.when(F.col("id").isNotNull(), F.to_json(F.struct(F.lit("openrouter_adjudication").alias("type"), "model", "reported_cost", "total_tokens"))).otherwise(F.to_json(F.struct(F.lit("engine").alias("type"), "engine")))
        pages = pages.withColumn("canonical_source", source)
    if accepted_only:
        keep = F.col("validation_status") == "accepted"
        pages = pages.where(keep | F.col("id").isNotNull() if with_adjudications else keep)
    return pages


def canonical_pages(store: Store, policy: str = "local") -> tuple[DataFrame, DataFrame]:
    """(pages with canonical text and source, violations). The preferred provider's newest adjudication comes first."""
    order = [F.when(F.col("provider") == "openrouter", 0).otherwise(1), -F.col("id")]
    a = store.read("adjudications").select("run_id", "page_number", "id", "provider", F.col("text").alias("model_text"), "image_pixels", "image_dark_pixels", "image_dark_pixel_cutoff", "visually_blank")
    joined = current_pages(store).join(versions.best(a, ["run_id", "page_number"], order), ["run_id", "page_number"], "left")
    metrics = tuple(F.col(c) for c in ("image_pixels", "image_dark_pixels", "image_dark_pixel_cutoff", "visually_blank"))
    measured = F.col("image_pixels").isNotNull()
    has, evidence, ok = F.col("id").isNotNull(), rules.verified_blank(F.lit(True), *metrics), ~measured | rules.valid_metrics(*metrics)
    local = F.when(X.local_content_empty(F.col("text"), F.col("markdown")), "").otherwise(F.col("markdown"))
    text, source = rules.canonical(local, F.col("model_text"), has, evidence, policy)
    found = rules.canonical_violations(F.col("model_text"), has, evidence, ok, policy)
    pages = joined.select("document_sha256", "run_id", "page_number", "route", "validation_status", text.alias("canonical_markdown"), source.alias("canonical_source"), found.alias("violations"))
    return pages.drop("violations"), pages.where(F.size("violations") > 0).select("document_sha256", "page_number", "violations")


def prepare_publication(store: Store, path: str, house: str, parliament: str, session: str, policy: str = "local") -> DataFrame:
    """Document and page tables, manifest and checksums of a scope. Violations stop it before anything is written."""
    records = store.read("census_records").where(in_scope(house, parliament, session) & F.col("document_sha256").isNotNull())
    pages, wrong = canonical_pages(store, policy)
    scoped = records.select("document_sha256").distinct()
    integrity.require_none(wrong.join(scoped, "document_sha256", "left_semi"), "pages without a canonical text")
    pages = pages.join(scoped, "document_sha256", "left_semi")
    grouped = F.array_sort(F.collect_list(F.struct("record_id", "source_url", "title", "document_date", "document_number", "document_subtype", "source_type")))
    by_document = records.groupBy("document_sha256").agg(grouped.alias("r"))
    first = lambda c: F.col("r")[0][c]
    named = by_document.select("document_sha256", F.transform("r", lambda x: x["record_id"]).alias("record_ids"), F.transform("r", lambda x: x["source_url"]).alias("source_urls"), X.document_slug(first("document_date"), first("document_number"), first("record_id"), first("title"), first("document_subtype"), first("source_type"), F.col("document_sha256")).alias("slug"))
    texts = publish.document_text(pages, ["document_sha256"], "page_number", "canonical_markdown")
    documents = named.join(texts, "document_sha256").join(store.read("documents").select(F.col("sha256").alias("document_sha256"), "size_bytes"), "document_sha256")
    publish.write_tables(documents, pages, path)
    publish.write_json_lines(documents.select("document_sha256", "slug", "record_ids", "source_urls"), f"{path}/manifest.jsonl")
    sums = publish.checksums(store.spark, path).where(~F.col("path").contains("SHA256SUMS"))
    sums.coalesce(1).write.mode("overwrite").json(f"{path}-SHA256SUMS")
    return publish.publication_counts(documents, pages)


def verify_publication(store: Store, path: str) -> DataFrame:
    """Files that differ from the checksums, and pages whose document is missing."""
    expected = store.spark.read.schema("path string, size long, hash string").json(f"{path}-SHA256SUMS")
    files = publish.verify(store.spark, path, expected).select(F.col("path").alias("what"), F.col("state").alias("problem"))
    d = store.spark.read.parquet(f"{path}/documents.parquet").select("document_sha256")
    orphans = store.spark.read.parquet(f"{path}/pages.parquet").join(d, "document_sha256", "left_anti").select(F.col("document_sha256").alias("what"), F.lit("page without document").alias("problem"))
    return files.unionByName(orphans)


def census_repository(store: Store, url: str, size: int = 100, pages: int = 0, source: str = "paged_json") -> int:
    """Records of a paged repository search, upserted; scopes of the run are complete, as a bad page fails it. Returns the run."""
    run = (store.read("census_runs").agg(F.max("id")).first()[0] or 0) + 1
    hits = staging.stage(store.spark.read.format(source).option("url", url).option("pagesize", size).option("pages", pages).load(), "hits")
    items = staging.stage(payloads.repository_items(hits), "items")
    integrity.require_none(items.where("problem IS NOT NULL").select("item_id", "problem"), "hits that can't be records")
    rows = items.drop("item_id", "problem", "handle", "original_session").withColumn("source_type", F.lit("questions_answers")).withColumn("acquisition_status", F.lit("discovered"))
    rows = rows.withColumn("raw", F.lit(None).cast("string"))
    store.upsert("census_records", rows)
    store.append("census_runs", store.spark.createDataFrame([(run, source, "complete")], "id long, source string, status string"))
    store.append("census_scopes", items.select(F.lit(run).cast("long").alias("run_id"), "house", "parliament_number", "session", F.lit("complete").alias("status")).distinct())
    return run


def _next_run(store: Store) -> int:
    return (store.read("census_runs").agg(F.max("id")).first()[0] or 0) + 1


def scope_state(store: Store, run: int, house: str, parliament: str, session: str, status: str) -> None:
    """A scope's next state is a row: pending, running, then complete, failed or interrupted; the newest counts."""
    store.append("census_scopes", store.spark.createDataFrame([(run, house, parliament, session, status)], "run_id long, house string, parliament_number string, session string, status string"))


def census_modern(store: Store, url: str, scopes: list[tuple[str, str]], size: int = 100, source: str = "numbered_json", page_url: str | None = None) -> dict:
    """Questions of (parliament, session) scopes of the modern interface, upserted scope by scope. A scope that fails is marked so
    with its error and the others go on; an interruption marks its scope and ends the run. Returns run, status and errors."""
    run, errors = _next_run(store), {}
    state = lambda status: store.append("census_runs", store.spark.createDataFrame([(run, source, status)], "id long, source string, status string"))
    state("running")
    for parliament, session in scopes:
        mark = lambda status, p=parliament, s=session: scope_state(store, run, "lok_sabha", p, s, status)
        mark("running")
        try:
            asked = {"loksabhaNo": parliament, "sessionNumber": session, "locale": "en"}
            params = json.dumps(asked)
            hits = staging.stage(store.spark.read.format(source).option("url", url).option("params", params).option("pagesize", size).load(), "hits")
            found = payloads.modern_questions(hits, parliament, session, url, asked, size, page_url)
            integrity.require_none(found.where("problem IS NOT NULL").select("position", "problem"), "rows that can't be records")
            integrity.require_none(integrity.duplicates(found, ["record_id"]), "questions that repeat")
            store.upsert("census_records", found.drop("position", "problem").withColumn("acquisition_status", F.lit("discovered")))
        except KeyboardInterrupt:
            mark("interrupted")
            state("interrupted")
            raise
        except Exception as error:
            errors[f"{parliament}/{session}"] = f"{type(error).__name__}: {error}"
            mark("failed")
        else:
            mark("complete")
    state("failed" if errors else "complete")
    return {"run": run, "status": "failed" if errors else "complete", "errors": errors}


def failed_scopes(store: Store) -> list[tuple[str, str]]:
    """(parliament, session) of the scopes whose newest run did not end well: what a retry takes up."""
    newest = store.read("census_scopes").groupBy("house", "parliament_number", "session").agg(F.max("run_id").alias("run_id"))
    states = store.read("census_scopes").join(newest, ["house", "parliament_number", "session", "run_id"])
    ended = states.groupBy("house", "parliament_number", "session").agg(F.bool_or(F.col("status") == "complete").alias("ok"))
    return sorted((r.parliament_number, r.session) for r in ended.where("NOT ok").collect())


def census_questions(store: Store, path: str) -> int:
    """Question rows of a JSON payload (one array or one object a line), grouped to records and upserted."""
    fields = "qslno string, files string, shri string, name string, qtitle string, qtype string, ans_date string, qno double, min_name string, ses_no string"
    rows = store.spark.read.schema(fields).json(path).withColumn("ordinal", F.monotonically_increasing_id())
    found = payloads.question_rows(staging.stage(rows, "question-rows")).drop("ordinal")
    store.upsert("census_records", found.withColumn("source_type", F.lit("questions_answers")).withColumn("acquisition_status", F.lit("discovered")))
    return store.read("census_records").count()
