"""Acquisition: manifests and census records become originals of the store, in batches, until nothing is left or time is up."""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.operators import integrity
from foliary.operators.staging import stage
from foliary.operators.store import Store
from foliary.sources import documents, http_json, snapshots


def register(store: Store, found: DataFrame) -> None:
    """Originals, documents and sources of fetched rows without an error."""
    good = found.where("error IS NULL")
    documents.store(good.select("sha256", "size_bytes", "content"), f"{store.root}/originals")
    once = good.dropDuplicates(["sha256"])
    store.insert_or_ignore("documents", once.select("sha256", "size_bytes", F.lit("application/pdf").alias("media_type"), F.col("url").alias("raw_path"), F.current_timestamp().alias("created_at")))
    sources = good.dropDuplicates(["sha256", "url"])
    store.insert_or_ignore("sources", sources.select(F.col("sha256").alias("document_sha256"), F.col("url").alias("source_uri"), F.element_at(F.split("url", "/"), -1).alias("original_name"), F.current_timestamp().alias("acquired_at"), F.lit("{}").alias("metadata_json")))


def ingest_manifest(store: Store, path: str, **fetching) -> int:
    """All entries of a manifest: local files (beside the manifest) first, else downloads. What is good is registered; then
    entries that failed raise. Returns the number of entries."""
    entries = snapshots.manifest(store.spark, path)
    folder = os.path.dirname(path)
    file = F.when(F.col("file").startswith("/") | F.col("file").contains("://"), F.col("file")).otherwise(F.concat(F.lit(f"{folder}/"), F.col("file")))
    found = stage(documents.fetched(entries.withColumn("file", file), **fetching), "fetched")
    register(store, found)
    integrity.require_none(found.where("error IS NOT NULL").select("url", "error"), "manifest entries that could not be had")
    return found.count()


def waiting(store: Store, retry_failed: bool = False) -> DataFrame:
    """Census records still to be acquired: those never tried, or the failed ones alone."""
    status = "failed" if retry_failed else "discovered"
    return store.read("census_records").where((F.coalesce("acquisition_status", F.lit("discovered")) == status) & (F.coalesce("source_url", F.lit("")) != ""))


def acquire(store: Store, batch: DataFrame, **fetching) -> dict[str, int]:
    """Download the records of ``batch`` (record_id, source_url), each URL once, and write down what became of them."""
    urls = batch.select(F.lit(None).cast("string").alias("file"), F.col("source_url").alias("url"), F.lit(None).cast("string").alias("sha256")).distinct()
    found = stage(documents.fetched(urls, **fetching), "fetched")
    register(store, found)
    outcome = batch.select("record_id", "source_url").join(found.select(F.col("url").alias("source_url"), "sha256", "error"), "source_url")
    outcome = stage(outcome.select("record_id", "sha256", "error"), "outcome")
    failed = F.col("error").isNotNull()
    # only what this batch has learnt is written; readers take a record's newest outcome
    number = F.lit(store.version("outcomes") + 1).cast("long")
    state = F.when(failed, "failed").otherwise("downloaded")
    was = store.read("census_records").select("record_id", F.col("document_sha256").alias("was")).join(F.broadcast(outcome.select("record_id")), "record_id", "left_semi")
    rows = outcome.join(was, "record_id").select("record_id", F.when(failed, F.col("was")).otherwise(F.col("sha256")).alias("document_sha256"), state.alias("acquisition_status"), F.col("error").alias("last_error"), number.alias("n"))
    store.append("outcomes", rows)
    counts = outcome.agg(F.count("*").alias("tried"), F.count_if(failed).alias("failed")).first()
    return {"tried": counts.tried, "failed": counts.failed}


def room(store: Store) -> int:
    """Bytes that are free where the store lies."""
    _, fs = store._files()
    return fs.getStatus().getRemaining()


def drain(store: Store, batch_size: int = 1000, deadline: float | None = None, retry_failed: bool = False, least_free: int = 0, clock: Callable[[], float] = time.time, opener: Callable[[str, float], bytes] = http_json.open_url, **fetching) -> dict:
    """Batches of waiting records in the order of their ids until none is left, ``deadline`` (of ``clock``) has passed or less
    than ``least_free`` bytes are free. Each batch is durable when the next begins; a later call goes on where this one ended.
    Failed records are tried again by ``retry_failed`` alone, each once per call."""
    done, last = {"batches": 0, "tried": 0, "failed": 0, "stopped": "empty"}, ""
    while True:
        if deadline is not None and clock() >= deadline:
            return done | {"stopped": "deadline"}
        if least_free and room(store) < least_free:
            return done | {"stopped": "disk"}
        batch = stage(waiting(store, retry_failed).where(F.col("record_id") > last).select("record_id", "source_url").orderBy("record_id").limit(batch_size), "batch")
        last_id = batch.agg(F.max("record_id")).first()[0]
        if last_id is None:
            return done
        last = last_id
        counts = acquire(store, batch, opener=opener, **fetching)
        done["batches"] += 1
        for k, n in counts.items():
            done[k] += n
