"""Reports and readable sinks: what a run or a scope comes to, as rows, and as small text files for people and schedulers.

Aggregates are computed by Spark; only their few rows reach the driver."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.sources import files


def write_text(path: str, text: str) -> str:
    """One small file, moved to its name when it is whole. Returns its SHA-256."""
    with files.Writing(path, "report") as out:
        out.write(text.encode())
    return out.digest.hexdigest()


def as_json(value) -> str:
    return json.dumps(plain(value), ensure_ascii=False, sort_keys=True, indent=2) + "\n"


def plain(value):
    """JSON value of any object: mappings by their keys as text, sequences and sets as lists, objects by their attributes, all
    else as text."""
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, (set, frozenset)):
        return sorted((plain(v) for v in value), key=str)
    own = getattr(value, "__dict__", None)
    return {k: plain(v) for k, v in own.items() if not k.startswith("_")} if own is not None else str(value)


def run_manifest(pages: DataFrame) -> DataFrame:
    """Per run: pages, native and OCR pages, and the numbers of the pages to review, in order."""
    review = F.array_sort(F.collect_list(F.when(F.col("validation_status") == "review", F.col("page_number"))))
    return pages.groupBy("run_id").agg(F.count("*").alias("pages"), F.count_if(F.col("route") == "native").alias("native_pages"), F.count_if(F.col("route") == "ocr").alias("ocr_pages"), review.alias("review_pages"))


def write_csv_summary(rows: DataFrame, path: str, seconds: tuple[str, ...] = ()) -> None:
    """CSV with a header; columns named in ``seconds`` have 4 decimals."""
    shown = rows.select(*(F.format_string("%.4f", F.col(c)).alias(c) if c in seconds else F.col(c) for c in rows.columns))
    shown.write.mode("overwrite").option("header", True).csv(path)


def metadata(counts: dict, **more) -> dict:
    """Content of a publication's metadata file: counts and what the caller knows of it."""
    return {"counts": counts, **more}


def write_card(path: str, title: str, counts: dict, notes: list[str] = ()) -> None:
    """metadata.json and README.md beside published tables."""
    write_text(f"{path}/metadata.json", as_json(metadata(counts, title=title, notes=list(notes))))
    table = "".join(f"| {k} | {v} |\n" for k, v in sorted(counts.items()))
    write_text(f"{path}/README.md", f"# {title}\n\n| what | count |\n|---|---|\n{table}" + "".join(f"\n{n}\n" for n in notes))


def write_readable(documents: DataFrame, path: str) -> DataFrame:
    """A folder per document (slug) with document.md and metadata.json, written by the tasks. Columns slug, text and any others.
    Returns slug, hash of the text, lazily: count or stage it to write."""
    fields = documents.schema.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.to_dict("records"):
                digest = write_text(f"{path}/{row['slug']}/document.md", row["text"] or "")
                write_text(f"{path}/{row['slug']}/metadata.json", as_json({k: v.tolist() if hasattr(v, "tolist") else v for k, v in row.items() if k != "text"}))
                rows.append((row["slug"], digest))
            yield pd.DataFrame(rows, columns=["slug", "hash"])

    return documents.select(*fields).mapInPandas(run, "slug string, hash string")


def verification(tasks: DataFrame) -> DataFrame:
    """Per model of checked pages (model, agrees, error, tokens): tasks, errors, agreements and their share of those without."""
    ok = F.col("error").isNull()
    agreed = F.count_if(ok & F.col("agrees"))
    return tasks.groupBy("model").agg(F.count("*").alias("tasks"), F.count_if(~ok).alias("errors"), agreed.alias("agreed"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).withColumn("share", F.try_divide("agreed", F.col("tasks") - F.col("errors")))


def write_verification(tasks: DataFrame, path: str) -> dict:
    """report.json, tasks as JSON lines, and a Markdown table."""
    rows = [r.asDict() for r in verification(tasks).orderBy("model").collect()]
    tasks.write.mode("overwrite").json(f"{path}/tasks.jsonl")
    write_text(f"{path}/report.json", as_json({"models": rows}))
    lines = "".join(f"| {r['model']} | {r['tasks']} | {r['errors']} | {r['agreed']} |\n" for r in rows)
    write_text(f"{path}/report.md", f"| model | tasks | errors | agreed |\n|---|---|---|---|\n{lines}")
    return {"models": rows}


def write_audit(report: dict, folder: str) -> str:
    """A report under the name of its own hash; what is read back must have it. Returns the path."""
    text = as_json(report)
    name = f"{folder}/audit-{hashlib.sha256(text.encode()).hexdigest()}.json"
    write_text(name, text)
    with files.open_stream(name) as stream:
        if hashlib.sha256(stream.read()).hexdigest() not in name:
            raise ValueError(f"{name} reads back differently")
    return name


def matrix(scopes: list[dict]) -> str:
    """Lines for a scheduler: the scopes as one JSON object, and their number."""
    return f"matrix={json.dumps({'include': scopes}, ensure_ascii=False, separators=(',', ':'))}\ncount={len(scopes)}\n"


def marker_kind(skip_reason: Column, complete: Column, ready: Column) -> Column:
    """Which marker a scope's state earns, null for none."""
    return F.when(skip_reason.isNotNull(), "skipped").when(complete, "session-complete").when(ready, "snapshot-complete")


def request_digest(payload: dict) -> str:
    """SHA-256 of a request's compact JSON with its keys in the given order."""
    return hashlib.sha256(json.dumps(payload, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def model_folder(name: Column) -> Column:
    """A model's name as a folder's."""
    return F.regexp_replace(name, "[^a-zA-Z0-9._-]+", "__")


def raw_count(index: dict) -> int:
    """Number of originals that a raw index names, in either of its versions: entries by hash, or a list of files."""
    return len(index["originals"]) if "originals" in index else sum(str(f).endswith(".pdf") for f in index.get("files", []))

