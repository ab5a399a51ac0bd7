"""A record's primary file chosen anew from the ledger of its attachments, with a rule for what the names leave open."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.functions import text as X
from foliary.operators import integrity
from foliary.operators.staging import stage
from foliary.operators.store import Store
from foliary.operators.workflow import in_scope


def reselection(records: DataFrame, attachments: DataFrame) -> DataFrame:
    """record_id, selected, candidate, outcome. records: record_id, document_sha256 (the choice so far); attachments: record_id, position,
    name, document_sha256.

    The candidate is the first English file, else the first that isn't Hindi, else the first. Outcomes: ``kept`` (the candidate is
    the choice), ``changed`` (the candidate is labelled English, or the choice Hindi), ``ambiguous`` (neither: the choice stays),
    ``no ledger`` (no attachment with a document), ``absent`` (the choice isn't among the attachments). One aggregation; where a document
    is attached twice its first position counts, and of equal ones the least language. A null choice is absent; null positions come first, null names have no language."""
    own = records.select("record_id", F.col("document_sha256").alias("selected")).dropDuplicates(["record_id"])
    files = attachments.select("record_id", "position", F.col("document_sha256").alias("file"), X.language_hint(F.coalesce("name", F.lit("")), F.array().cast("array<string>")).alias("hint"))
    x = own.join(files, "record_id", "left")
    place = [F.col("position"), F.col("file"), F.col("hint")]
    rank = F.struct(F.when(F.col("hint") == "en", 0).when(F.col("hint") != "hi", 1).otherwise(2).alias("r"), *place)
    there, chosen = F.col("file").isNotNull(), F.col("file") == F.col("selected")
    # ranks where the condition fails are null, and rows of a null rank are never picked
    best = F.min_by(F.struct("file", "hint"), F.when(there, rank)).alias("c")
    current = F.min_by(F.struct("file", "hint"), F.when(chosen, F.struct(*place))).alias("s")
    g = x.groupBy("record_id").agg(F.any_value("selected").alias("selected"), best, current)
    outcome = (
        F.when(F.col("c").isNull(), "no ledger").when(F.col("s").isNull(), "absent").when(F.col("c.file") == F.col("selected"), "kept")
        .when((F.col("c.hint") == "en") | (F.col("s.hint") == "hi"), "changed").otherwise("ambiguous")
    )
    return g.select("record_id", "selected", F.col("c.file").alias("candidate"), outcome.alias("outcome"))


def reselect_primary(store: Store, house: str, parliament: str, session: str) -> dict[str, int]:
    """Choose anew for the downloaded records of a scope that have attachments. Changes are written as newer outcomes of the records, to exactly
    the version that was read (a Conflict if another writer came between); documents and earlier runs stay. A choice that is absent from its
    ledger raises before anything is written."""
    base = store.version("outcomes")
    records = store.read("census_records").where(in_scope(house, parliament, session) & (F.col("acquisition_status") == "downloaded"))
    found = stage(reselection(records, store.read("attachments")), "reselection")
    integrity.require_none(found.where("outcome = 'absent'"), "chosen files that aren't among the attachments")
    counts = {r["outcome"]: r["count"] for r in found.groupBy("outcome").count().collect()}
    if counts.get("changed"):
        number = F.lit(base + 1).cast("long")
        rows = found.where("outcome = 'changed'").select("record_id", F.col("candidate").alias("document_sha256"), F.lit("downloaded").alias("acquisition_status"), F.lit(None).cast("string").alias("last_error"), number.alias("n"))
        store.append_to("outcomes", rows, base)
    inspected = sum(counts.get(k, 0) for k in ("kept", "changed", "ambiguous"))
    return {"inspected": inspected, "changed": counts.get("changed", 0), "ambiguous": counts.get("ambiguous", 0), "missing_ledgers": counts.get("no ledger", 0)}
