"""Source payloads as DataFrames: sessions, question rows, repository items, their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.functions import text as X

_VALUES = "array<struct<value:string>>"
ITEM = f"struct<uuid:string,id:string,name:string,handle:string,metadata:map<string,{_VALUES}>>"
HIT = f"struct<_embedded:struct<indexableObject:{ITEM}>>"
SESSIONS = "array<struct<loksabha:int,sessions:array<struct<sessionNo:int>>>>"


def sessions(payload: DataFrame, column: str = "value") -> DataFrame:
    """(parliament, session) of an inventory payload, distinct, as numbers in order."""
    x = payload.select(F.explode(F.from_json(column, SESSIONS)).alias("p")).select(F.col("p.loksabha").alias("parliament"), F.explode("p.sessions.sessionNo").alias("session"))
    return x.distinct().orderBy("parliament", "session")


def latest_session(found: DataFrame) -> DataFrame:
    return found.agg(F.max(F.struct("parliament", "session")).alias("x")).select("x.*")


def session_list(found: DataFrame, ordinal: str, session: str = "session") -> DataFrame:
    """(session, ordinal) as text in the interface's own order, rows without one left out."""
    return found.where(F.col(session).isNotNull()).select(F.col(session).cast("string").alias("session"), ordinal).orderBy(ordinal)


MODERN_ROW = "struct<quesNo:string,type:string,sessionNo:string,date:string,subjects:string,ministry:string,member:array<string>,questionsFilePath:string>"


def modern_questions(items: DataFrame, parliament: str, session: str, url: str | None = None, params: dict | None = None, size: int | None = None, page_url: str | None = None) -> DataFrame:
    """Records of the modern interface's rows (position, item: JSON text), rows without a URL too, as evidence; ``problem`` names
    rows without a number. Where they came from stays with them: the interface's address, the parameters of the request (with the page that a
    position from 0 lies on, if ``size`` is given), and the page that shows them to readers."""
    r = F.from_json("item", MODERN_ROW)
    own = lambda c: X.stripped(F.coalesce(F.col(f"r.{c}"), F.lit("")))
    kind = F.upper(X.stripped(F.coalesce(F.nullif(F.col("r.type"), F.lit("")), F.lit("unknown"))))
    members = F.filter(F.transform(F.coalesce("r.member", F.array().cast("array<string>")), X.stripped), lambda m: m != "")
    return items.withColumn("r", r).select(
        "position", F.concat(F.lit(f"ls_l{parliament}_s{session}_q"), own("quesNo"), F.lit("_"), F.lower(kind), F.lit("_en")).alias("record_id"), F.lit("questions_answers").alias("source_type"), F.lit("lok_sabha").alias("house"), F.lit(parliament).alias("parliament_number"),
        F.coalesce(F.nullif(F.col("r.sessionNo"), F.lit("")), F.lit(session)).alias("session"), own("quesNo").alias("document_number"), kind.alias("document_subtype"), X.parse_date(own("date")).alias("document_date"), own("subjects").alias("title"), own("ministry").alias("ministry"),
        members.alias("members"), F.lit("en").alias("language"), own("questionsFilePath").alias("source_url"), F.col("item").alias("raw"), F.when(own("quesNo") == "", "no number").alias("problem"),
        F.lit(url).cast("string").alias("api_url"), _asked(params, size).alias("api_params"), F.lit(page_url).cast("string").alias("official_page_url"),
    )


def _asked(params: dict | None, size: int | None) -> Column:
    if params is None:
        return F.lit(None).cast("map<string,string>")
    pairs = [x for k, v in params.items() for x in (F.lit(str(k)), F.lit(str(v)))]
    if size:
        pairs += [F.lit("pageSize"), F.lit(str(size)), F.lit("pageNo"), (F.floor(F.col("position") / size) + 1).cast("string")]
    return F.create_map(*pairs)


def first_session(found: DataFrame, ordinal: str, session: str = "session") -> DataFrame:
    """First session in the interface's own order, rows without one left out."""
    return found.where(F.col(session).isNotNull()).agg(F.min_by(session, ordinal).alias("session"))


def question_rows(rows: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Rows of one question (by its list number, else its file) as one record: fields of the first, all members in order."""
    url, number = X.stripped(F.coalesce("files", F.lit(""))), X.stripped(F.coalesce(F.col("qslno").cast("string"), F.lit("")))
    part = lambda c: F.nullif(X.stripped(F.coalesce(c, F.lit(""))), F.lit(""))
    own = rows.withColumn("source_url", url).where("source_url <> ''").withColumn("key", F.when(number == "", F.col("source_url")).otherwise(number)).withColumn("member", F.concat_ws(" ", part("shri"), part("name")))
    members = F.array_distinct(F.filter(F.transform(F.array_sort(F.collect_list(F.struct(ordinal, "member"))), lambda x: x["member"]), lambda m: m != ""))
    first = F.min_by(F.struct("source_url", "qtitle", "qtype", "ans_date", "qno", "min_name", "ses_no"), ordinal)
    x = own.groupBy("key").agg(first.alias("r"), members.alias("members"), F.min(ordinal).alias("ordinal"))
    text = lambda c: X.stripped(F.coalesce(F.col(f"r.{c}").cast("string"), F.lit("")))
    return x.select(
        F.concat(F.lit("rs_qsl"), "key", F.lit("_en")).alias("record_id"), F.lit("rajya_sabha").alias("house"), F.lit("").alias("parliament_number"), text("ses_no").alias("session"),
        F.coalesce(X.question_number(F.col("r.qno")), F.lit("")).alias("document_number"), F.upper(F.when(text("qtype") == "", "unknown").otherwise(text("qtype"))).alias("document_subtype"), X.parse_date(text("ans_date")).alias("document_date"),
        text("qtitle").alias("title"), text("min_name").alias("ministry"), "members", F.lit("en").alias("language"), F.col("r.source_url").alias("source_url"), "ordinal",
    )


def _values(metadata: Column, key: str) -> Column:
    return F.filter(F.transform(F.coalesce(F.try_element_at(metadata, F.lit(key)), F.array().cast(_VALUES)), lambda x: X.stripped(F.coalesce(x["value"], F.lit("")))), lambda x: x != "")


def repository_items(hits: DataFrame, column: str = "item", base: str = "https://repository.example") -> DataFrame:
    """Search hits as records: first metadata values that aren't blank, address fallbacks, repaired session labels.

    ``problem`` is null, or names a hit without an id or an id that repeats: callers decide whether that is an error."""
    x = hits.select("*", F.from_json(column, HIT).alias("h")).select("*", F.col("h._embedded.indexableObject").alias("i")).drop("h")
    m = F.col("i.metadata")
    one = lambda key: F.coalesce(F.get(_values(m, key), F.lit(0)), F.lit(""))
    item = X.stripped(F.coalesce(F.nullif("i.uuid", F.lit("")), F.col("i.id"), F.lit("")))
    handle = X.stripped(F.coalesce("i.handle", F.lit("")))
    api = F.concat(F.lit(f"{base}/server/api/core/items/"), item)
    address = F.when(one("dc.identifier.uri") != "", one("dc.identifier.uri")).when(handle != "", F.concat(F.lit(f"{base}/handle/"), handle)).otherwise(api)
    members, original = _values(m, "dc.contributor.members"), one("dc.identifier.sessionnumber")
    session = X.normal_session(original, members)
    out = x.select(
        item.alias("item_id"), F.concat(F.lit("elibrary_ls_question_"), item).alias("record_id"), F.lit("lok_sabha").alias("house"), one("dc.identifier.loksabhanumber").alias("parliament_number"), session.alias("session"),
        F.when(session != original, original).alias("original_session"), one("dc.identifier.questionnumber").alias("document_number"), F.upper(one("dc.identifier.questiontype")).alias("document_subtype"), one("dc.date.issued").alias("document_date"),
        F.when(one("dc.title") != "", one("dc.title")).otherwise(X.stripped(F.coalesce("i.name", F.lit("")))).alias("title"), one("dc.relation.ministry").alias("ministry"), members.alias("members"), X.language_of(_values(m, "dc.language.iso")).alias("language"),
        address.alias("source_url"), api.alias("api_url"), handle.alias("handle"),
    )
    seen = out.groupBy("item_id").agg(F.count("*").alias("_n"))
    return out.join(seen, "item_id").withColumn("problem", F.when(F.col("item_id") == "", "no id").when(F.col("_n") > 1, "repeated id")).drop("_n")


def primary_files(files: DataFrame) -> DataFrame:
    """Per record its primary file: the first English one, else the first that isn't Hindi, else the first.

    Columns record_id, position, name, labels (array) and any others."""
    hint = X.language_hint(F.col("name"), F.col("labels"))
    rank = F.struct(F.when(F.col("hint") == "en", 0).when(F.col("hint") != "hi", 1).otherwise(2).alias("r"), F.col("position"))
    others = [c for c in files.columns if c != "record_id"]
    x = files.withColumn("hint", hint).groupBy("record_id").agg(F.min_by(F.struct(*others, "hint"), rank).alias("f"))
    return x.select("record_id", "f.*")


def file_problems(bundles: DataFrame) -> DataFrame:
    """Records whose inventory isn't one ORIGINAL bundle of unique files with a PDF among them. Columns record_id, bundle,
    bitstream_id, name, mime, and bundle_id if bundles of one name are to be told apart."""
    pdf = F.lower("name").endswith(".pdf") | (F.lower("mime") == "application/pdf")
    which = F.col("bundle_id") if "bundle_id" in bundles.columns else F.col("bundle")
    x = bundles.where("bundle = 'ORIGINAL'").groupBy("record_id").agg(F.count_distinct(which).alias("bundles"), F.count("*").alias("n"), F.count_distinct("bitstream_id").alias("ids"), F.count_if(pdf).alias("pdfs"))
    all_ids = bundles.select("record_id").distinct().join(x, "record_id", "left")
    problem = F.when(F.col("n").isNull(), "no original bundle").when(F.col("bundles") > 1, "several original bundles").when(F.col("n") != F.col("ids"), "repeated file id").when(F.col("pdfs") == 0, "no pdf")
    return all_ids.select("record_id", problem.alias("problem")).where("problem IS NOT NULL")
