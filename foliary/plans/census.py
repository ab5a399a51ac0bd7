"""Queries over census records: scope status, queues, ledgers, shards, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliary.functions import rules
from foliary.operators import attachments, integrity, sampling, staging, versions
from foliary.plans.catalog import query
from foliary.plans.frames import RECORDS, attempts, records, runs, t

_LATEST = """latest AS (SELECT l_orderkey AS document, max(l_linenumber) AS run FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
 per_doc AS (SELECT document, count(*) AS pages, count(*) FILTER (WHERE l_returnflag = 'R') AS review
   FROM lineitem JOIN latest ON l_orderkey = document AND l_linenumber = run WHERE l_linestatus = 'F' GROUP BY 1)"""


def latest_pages(spark, sf):
    """Per document its latest complete run, that run's pages and pages to review. Lines are dealt by document once, which serves
    both aggregations and the join; a document has few lines, so that nothing is lost without a partial aggregation."""
    per_run = runs(spark, sf).select("document", "run", "flag").repartition("document").groupBy("document", "run").agg(F.count("*").alias("pages"), F.count_if(F.col("flag") == "R").alias("review"))
    return versions.latest(per_run, ["document"], "run")


@query(f"""WITH records AS ({RECORDS}), {_LATEST}
SELECT house, session, count(*) AS records, count(*) FILTER (WHERE status = 'downloaded') AS downloaded, count(p.document) AS processed,
  CAST(coalesce(sum(pages), 0) AS BIGINT) AS pages, CAST(coalesce(sum(review), 0) AS BIGINT) AS review_pages,
  CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS raw_total
FROM records r LEFT JOIN per_doc p ON r.document = p.document GROUP BY 1, 2""")
def scope_status(spark, sf):
    return scope_metrics(records(spark, sf).join(latest_pages(spark, sf), "document", "left"))


def scope_metrics(joined):
    return joined.groupBy("house", "session").agg(
        F.count("*").alias("records"), F.count_if(F.col("status") == "downloaded").alias("downloaded"), F.count("run").alias("processed"),
        F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), F.coalesce(F.sum("review"), F.lit(0)).alias("review_pages"),
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("raw_total"),
    )


@query(f"""WITH records AS ({RECORDS}), {_LATEST}, s AS (
SELECT house, session, count(*) AS records, count(*) FILTER (WHERE status = 'downloaded') AS downloaded, count(*) FILTER (WHERE status = 'failed') AS failed,
  count(*) FILTER (WHERE status = 'discovered') AS discovered, count(CASE WHEN status = 'downloaded' THEN p.document END) AS processed,
  CAST(coalesce(sum(pages), 0) AS BIGINT) AS pages, CAST(coalesce(sum(review), 0) AS BIGINT) AS review
FROM records r LEFT JOIN per_doc p ON r.document = p.document GROUP BY 1, 2)
SELECT house, session, CASE WHEN records = 0 THEN 'no records' WHEN downloaded = 0 AND failed = records THEN 'all originals are HTML' END AS skip_reason,
  downloaded > 0 AND processed = downloaded AND pages > 0 AND review = pages AS ready_limited,
  downloaded > 0 AND processed = downloaded AND discovered = 0 AND downloaded + failed = records AND pages > 0 AND review = pages AS complete FROM s""")
def completeness_verdict(spark, sf):
    s = records(spark, sf).join(latest_pages(spark, sf), "document", "left").groupBy("house", "session").agg(
        F.count("*").alias("records"), *(F.count_if(F.col("status") == x).alias(x) for x in ("downloaded", "failed", "discovered")),
        F.count(F.when(F.col("status") == "downloaded", F.col("run"))).alias("processed"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), F.coalesce(F.sum("review"), F.lit(0)).alias("adjudicated_pages"),
    )
    c = {x: F.col(x) for x in ("records", "downloaded", "failed", "discovered", "pages", "adjudicated_pages")} | {"census_status": F.lit("complete"), "acquired_documents": F.col("downloaded"), "processed_documents": F.col("processed"), "unsupported_html": F.col("failed")}
    return s.select("house", "session", rules.skip_reason(c).alias("skip_reason"), rules.publication_ready(c, limited=True).alias("ready_limited"), rules.session_complete(c, "tranche").alias("complete"))


@query(f"SELECT house, session, status, count(*) AS n FROM ({RECORDS}) GROUP BY 1, 2, 3")
def census_status_groups(spark, sf):
    return records(spark, sf).groupBy("house", "session", "status").agg(F.count("*").alias("n"))


@query("""SELECT count(*) AS n_records, count(DISTINCT o_custkey) AS sources, CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 0) AS BIGINT) AS downloaded,
 CAST(sum(CASE WHEN o_orderstatus = 'no such' THEN 1 END) AS BIGINT) AS empty_sum FROM orders""")
def census_totals(spark, sf):
    return t(spark, sf, "orders").agg(F.count("*").alias("n_records"), F.count_distinct("o_custkey").alias("sources"), F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)), F.lit(0)).alias("downloaded"), F.sum(F.when(F.col("o_orderstatus") == "no such", 1)).alias("empty_sum"))


@query("""WITH recent AS (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 10)
SELECT l_orderkey AS run, l_linestatus AS status, count(*) AS scopes FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM recent) GROUP BY 1, 2""")
def recent_scope_status(spark, sf):
    recent = t(spark, sf, "orders").orderBy(F.desc("o_orderkey")).limit(10).select(F.col("o_orderkey").alias("l_orderkey"))
    return t(spark, sf, "lineitem").join(recent, "l_orderkey", "left_semi").groupBy(F.col("l_orderkey").alias("run"), F.col("l_linestatus").alias("status")).agg(F.count("*").alias("scopes"))


@query("""SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM documents WHERE lang = 'en') AS english, (SELECT count(*) FROM labels) AS labelled,
 (SELECT count(*) FROM labels WHERE quality = 0) AS review, (SELECT count(DISTINCT conv_id) FROM conversations) AS pages, (SELECT count(*) FROM conversations WHERE role = 'assistant') AS attempts,
 (SELECT CAST(coalesce(sum(n_chars), 0) AS BIGINT) FROM documents) AS chars""")
def status_panel(spark, sf):
    d = t(spark, sf, "documents").agg(F.count("*").alias("documents"), F.count_if(F.col("lang") == "en").alias("english"), F.coalesce(F.sum("n_chars"), F.lit(0)).alias("chars"))
    n = t(spark, sf, "labels").agg(F.count("*").alias("labelled"), F.count_if(F.col("quality") == 0).alias("review"))
    c = t(spark, sf, "conversations").agg(F.count_distinct("conv_id").alias("pages"), F.count_if(F.col("role") == "assistant").alias("attempts"))
    return d.withColumn("k", F.lit(1)).join(n.withColumn("k", F.lit(1)), "k").join(c.withColumn("k", F.lit(1)), "k").drop("k")  # one row each


@query(f"SELECT status, count(*) AS n FROM ({RECORDS}) GROUP BY 1")
def acquisition_histogram(spark, sf):
    return records(spark, sf).groupBy("status").agg(F.count("*").alias("n"))


@query("""SELECT count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS downloaded_sources, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem)) AS documents_with_pages FROM orders""")
def distinct_downloaded(spark, sf):
    a = t(spark, sf, "orders").agg(F.count_distinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("downloaded_sources")).withColumn("k", F.lit(1))
    b = t(spark, sf, "lineitem").select("l_orderkey").distinct().agg(F.count("*").alias("documents_with_pages")).withColumn("k", F.lit(1))
    return a.join(b, "k").drop("k")


@query("""WITH files AS (SELECT l_orderkey AS document, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'N') AS selected FROM lineitem GROUP BY 1)
SELECT count(*) AS items, count(f.document) AS inventoried, count(*) FILTER (WHERE coalesce(selected, 0) > 0) AS with_selected, CAST(coalesce(sum(n), 0) AS BIGINT) AS files,
 CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS additional, count(*) - count(f.document) AS missing, count(*) > 0 AND count(f.document) = count(*) AS complete
FROM orders o LEFT JOIN files f ON o_orderkey = f.document WHERE o_orderstatus = 'F'""")
def attachment_coverage(spark, sf):
    files = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "N").alias("selected"))
    items = t(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey").join(files, "o_orderkey", "left")
    return items.agg(F.count("*").alias("items"), F.count("n").alias("inventoried"), F.count_if(F.coalesce("selected", F.lit(0)) > 0).alias("with_selected"), F.coalesce(F.sum("n"), F.lit(0)).alias("files"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("additional"), (F.count("*") - F.count("n")).alias("missing"), ((F.count("*") > 0) & (F.count("n") == F.count("*"))).alias("complete"))


@query("""SELECT event_type, count(*) FILTER (WHERE v IS NULL) AS unknown, count(*) FILTER (WHERE v = 0) AS free, count(*) FILTER (WHERE v <> 0) AS charged, CAST(coalesce(sum(v), 0) AS DOUBLE) AS total
FROM (SELECT event_type, CASE WHEN value < 5 THEN NULL WHEN value < 20 THEN 0 ELSE CAST(floor(value) AS DECIMAL(18,2)) END AS v FROM events) GROUP BY 1""")
def cost_classes(spark, sf):
    v = F.when(F.col("value") < 5, F.lit(None)).when(F.col("value") < 20, F.lit(0)).otherwise(F.floor("value")).cast("decimal(18,2)")
    return t(spark, sf, "events").select("event_type", v.alias("v")).groupBy("event_type").agg(F.count_if(F.col("v").isNull()).alias("unknown"), F.count_if(F.col("v") == 0).alias("free"), F.count_if(F.col("v") != 0).alias("charged"), F.coalesce(F.sum("v").cast("double"), F.lit(0.0)).alias("total"))


@query("""WITH d AS (SELECT n_chars FROM documents WHERE n_chars > 0)
SELECT count(*) AS samples, min(n_chars) AS least, median(n_chars) AS middle, CAST(sum(n_chars) AS DOUBLE) / count(*) AS mean, max(n_chars) AS most, CAST(sum(n_chars) AS DOUBLE) / count(*) * (SELECT count(*) FROM orders) AS projected FROM d""")
def storage_estimate(spark, sf):
    d = t(spark, sf, "documents").where("n_chars > 0").agg(F.count("*").alias("samples"), F.min("n_chars").alias("least"), F.median("n_chars").alias("middle"), (F.sum("n_chars").cast("double") / F.count("*")).alias("mean"), F.max("n_chars").alias("most"))
    n = t(spark, sf, "orders").agg(F.count("*").alias("n"))
    return d.withColumn("k", F.lit(1)).join(n.withColumn("k", F.lit(1)), "k").select("samples", "least", "middle", "mean", "most", (F.col("mean") * F.col("n")).alias("projected"))


def _parliament(day):
    """Null, empty or a number by the month: so both null rules show."""
    return F.when(F.month(day) % 3 == 0, F.lit(None)).when(F.month(day) % 3 == 1, F.lit("")).otherwise(F.month(day).cast("string"))


_PARLIAMENT = "CASE month(o_orderdate) % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(month(o_orderdate) AS VARCHAR) END"


@query(f"SELECT o_orderkey, {_PARLIAMENT} AS parliament FROM orders WHERE coalesce({_PARLIAMENT}, '') = ''")
def scope_filter_null_safe(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", _parliament(F.col("o_orderdate")).alias("parliament")).where(F.coalesce("parliament", F.lit("")) == "")


@query(f"SELECT o_orderkey, {_PARLIAMENT} AS parliament FROM orders WHERE {_PARLIAMENT} = ''")
def scope_filter_strict(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", _parliament(F.col("o_orderdate")).alias("parliament")).where(F.col("parliament") == "")


@query(f"""SELECT document, house, session, price FROM ({RECORDS}) WHERE status IN ('discovered', 'failed') AND house = 'NATION_3' AND price BETWEEN 1000 AND 400000
ORDER BY CASE WHEN status = 'failed' THEN 0 ELSE 1 END, price DESC, document LIMIT 50""")
def acquire_queue(spark, sf):
    """A bounded batch of the queue is the feature."""
    q = records(spark, sf).where(F.col("status").isin("discovered", "failed") & versions.conjunction(house="NATION_3", session=None) & F.col("price").between(1000, 400000))
    return q.orderBy(F.when(F.col("status") == "failed", 0).otherwise(1), F.desc("price"), "document").limit(50).select("document", "house", "session", "price")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 100 AND o_orderstatus <> 'F' ORDER BY o_orderkey LIMIT 100")
def keyset_page(spark, sf):
    return t(spark, sf, "orders").where("o_orderkey > 100 AND o_orderstatus <> 'F'").orderBy("o_orderkey").limit(100).select("o_orderkey", "o_orderstatus")


@query("""WITH d AS (SELECT DISTINCT sha256(text) AS digest FROM documents), p AS (SELECT DISTINCT substr(digest, 1, 2) AS prefix FROM d)
SELECT prefix, CASE WHEN count(*) = 1 THEN 'unique' ELSE 'ambiguous' END AS state, CASE WHEN count(*) = 1 THEN min(digest) END AS digest FROM p JOIN d ON substr(digest, 1, 2) = prefix GROUP BY 1""")
def prefix_lookup(spark, sf):
    d = t(spark, sf, "documents").select(F.sha2("text", 256).alias("digest")).distinct().withColumn("prefix", F.substring("digest", 1, 2))
    return d.groupBy("prefix").agg(F.when(F.count("*") == 1, "unique").otherwise("ambiguous").alias("state"), F.when(F.count("*") == 1, F.min("digest")).alias("digest"))


@query("""SELECT conv_id, turn, role, n FROM (SELECT conv_id, turn, role, row_number() OVER (ORDER BY conv_id, turn) - 1 AS n FROM conversations WHERE role = 'user') WHERE n >= 20 AND n < 120""")
def import_slice(spark, sf):
    """Offset and limit of an ordered snapshot are the feature; positions are numbered in range partitions."""
    numbered = integrity.positions(t(spark, sf, "conversations").where("role = 'user'").select("conv_id", "turn", "role"), ["conv_id", "turn"], "n")
    return numbered.where((F.col("n") >= 20) & (F.col("n") < 120))


@query("SELECT page_id, url FROM pages WHERE lower(url) LIKE '%/fr/%' AND html ILIKE '%<!DOCTYPE%' AND url NOT LIKE '%.pdf'")
def unsupported_html(spark, sf):
    return t(spark, sf, "pages").where(F.lower("url").contains("/fr/") & F.lower("html").contains("<!doctype") & ~F.col("url").endswith(".pdf")).select("page_id", "url")


@query("""WITH e AS (SELECT o_orderkey AS path, CAST(floor(o_totalprice) AS BIGINT) AS size, md5(CAST(o_custkey AS VARCHAR)) AS hash FROM orders WHERE o_orderkey % 7 <> 1),
a AS (SELECT o_orderkey AS path, CAST(floor(o_totalprice) AS BIGINT) + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS size, md5(CAST(o_custkey + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS VARCHAR)) AS hash FROM orders WHERE o_orderkey % 7 <> 2)
SELECT coalesce(e.path, a.path) AS path, CASE WHEN a.path IS NULL THEN 'missing' WHEN e.path IS NULL THEN 'unexpected' WHEN e.size <> a.size THEN 'size' WHEN e.hash <> a.hash THEN 'hash' ELSE 'same' END AS state
FROM e FULL JOIN a ON e.path = a.path""")
def file_set_compare(spark, sf):
    """Two inventories that differ by rule: here the predicates are the planted differences, not a subset of the rows."""
    k, o = F.col("o_orderkey"), t(spark, sf, "orders")
    size = F.floor("o_totalprice").cast("long")
    e = o.where(k % 7 != 1).select(k.alias("path"), size.alias("size"), F.md5(F.col("o_custkey").cast("string")).alias("hash"))
    a = o.where(k % 7 != 2).select(k.alias("path"), (size + F.when(k % 11 == 0, 1).otherwise(0)).alias("size"), F.md5((F.col("o_custkey") + F.when(k % 13 == 0, 1).otherwise(0)).cast("string")).alias("hash"))
    return integrity.compare_files(e, a)


@query("""SELECT o_orderkey AS id, 'removed' AS state FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT DISTINCT l_orderkey, 'new' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def new_removed_ids(spark, sf):
    """Both sides are counted per id in one pass; a removed id comes as often as the old side has it, a new one once."""
    old, new = t(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"))
    both = old.withColumn("old", F.lit(True)).unionByName(new.withColumn("old", F.lit(False)))
    sides = staging.spread(both, "id", rows=both.count()).groupBy("id").agg(F.count_if("old").cast("int").alias("n_old"), F.count_if(~F.col("old")).alias("n_new"))
    times = F.when(F.col("n_new") == 0, F.array_repeat(F.lit("removed"), F.col("n_old"))).when(F.col("n_old") == 0, F.array(F.lit("new")))
    return sides.select("id", F.explode(times).alias("state"))


@query("""SELECT document, source, status FROM (SELECT o_orderkey AS document, 'base' AS source, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT DISTINCT l_orderkey, 'refresh', l_linestatus FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') AND l_linestatus = 'F')""")
def snapshot_union(spark, sf):
    o = t(spark, sf, "orders")
    base = o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("document"), F.lit("base").alias("source"), F.col("o_orderstatus").alias("status"))
    again = o.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("document"))
    fresh = t(spark, sf, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("document"), F.lit("refresh").alias("source"), F.col("l_linestatus").alias("status")).join(again, "document", "left_semi").distinct()
    return base.unionByName(fresh)


@query("""SELECT conv_id, turn AS start, previous_end FROM (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS previous_end FROM conversations WHERE role <> 'assistant' OR turn % 4 = 2)
WHERE previous_end IS NOT NULL AND previous_end + 1 <> turn""")
def contiguity_check(spark, sf):
    shards = t(spark, sf, "conversations").where("role <> 'assistant' OR turn % 4 = 2").select("conv_id", F.col("turn").alias("start"), F.col("turn").alias("end"))
    return integrity.gaps(shards, ["conv_id"], "start", "end").select("conv_id", "start", "previous_end")


@query("""SELECT user_id, event_id, value, previous FROM (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events) WHERE value < previous""")
def monotonic_check(spark, sf):
    return integrity.descents(t(spark, sf, "events").select("user_id", "event_id", "value"), ["user_id"], "event_id", "value")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return integrity.duplicates(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""WITH n AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) AS position, text FROM documents)
SELECT CAST(floor(position / 100) AS BIGINT) AS shard, min(doc_id) AS first_id, max(doc_id) AS last_id, count(*) AS n, sha256(string_agg(sha256(text) || chr(10), '' ORDER BY doc_id)) AS digest FROM n GROUP BY 1""")
def shard_assignment(spark, sf):
    numbered = integrity.positions(t(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("digest")), ["doc_id"])
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "digest"))), lambda x: F.concat(x["digest"], F.lit("\n"))), "")
    return numbered.groupBy(integrity.chunk(F.col("position"), 100).alias("shard")).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n"), F.sha2(lines, 256).alias("digest"))


@query("""WITH incoming AS (SELECT o_orderkey + 5 AS id, upper(o_orderpriority) AS title, 'discovered' AS status FROM orders WHERE o_orderstatus = 'O'), old AS (SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS status FROM orders)
SELECT coalesce(o.id, i.id) AS id, CASE WHEN i.id IS NOT NULL THEN i.title ELSE o.title END AS title, CASE WHEN o.id IS NOT NULL THEN o.status ELSE i.status END AS status FROM old o FULL JOIN incoming i ON o.id = i.id""")
def census_upsert(spark, sf):
    o = t(spark, sf, "orders")
    old = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("status"))
    new = o.where("o_orderstatus = 'O'").select((F.col("o_orderkey") + 5).alias("id"), F.upper("o_orderpriority").alias("title"), F.lit("discovered").alias("status"))
    return versions.upsert(old, new, "id", ["status"])


@query("""SELECT o_custkey AS source, 'old' AS origin FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') UNION ALL
SELECT DISTINCT c_custkey, 'new' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def insert_or_ignore(spark, sf):
    old = t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("source")).distinct().withColumn("origin", F.lit("old"))
    return versions.insert_or_ignore(old, t(spark, sf, "customer").select(F.col("c_custkey").alias("source"), F.lit("new").alias("origin")), ["source"])


@query("""SELECT p.p_partkey AS id, p.p_brand AS old_value, q.v AS new_value FROM part p JOIN (SELECT p_partkey, CASE WHEN p_size > 45 THEN p_type ELSE p_brand END AS v FROM part) q ON p.p_partkey = q.p_partkey WHERE p.p_brand IS DISTINCT FROM q.v""")
def ledger_guard(spark, sf):
    p = t(spark, sf, "part")
    return versions.conflicts(p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("v")), p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 45, F.col("p_type")).otherwise(F.col("p_brand")).alias("v")), ["id"], "v")


@query(f"""WITH records AS ({RECORDS}), {_LATEST}, done AS (SELECT DISTINCT house, session FROM records WHERE status = 'downloaded' AND price > 499000)
SELECT house, session, count(*) AS n FROM records r WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.house = r.house AND d.session = r.session) GROUP BY 1, 2 ORDER BY n DESC, house, session LIMIT 40""")
def scope_planner(spark, sf):
    """The matrix of next scopes is bounded by its use."""
    r = records(spark, sf)
    done = r.where("status = 'downloaded' AND price > 499000").select("house", "session").distinct()
    return r.join(done, ["house", "session"], "left_anti").groupBy("house", "session").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "house", "session").limit(40)


@query("""WITH f AS (SELECT l_orderkey AS document, l_linenumber AS position, l_partkey AS file, CASE l_returnflag WHEN 'A' THEN 'en' WHEN 'R' THEN 'hi' ELSE 'und' END AS hint FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY document ORDER BY CASE hint WHEN 'en' THEN 0 WHEN 'und' THEN 1 ELSE 2 END, position, file) AS k, min(position) OVER (PARTITION BY document) AS first_position FROM f)
SELECT document, position, file, hint, position <> first_position AS changed FROM r WHERE k = 1""")
def attachment_reselection(spark, sf):
    f = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("position"), F.col("l_partkey").alias("file"), F.when(F.col("l_returnflag") == "A", "en").when(F.col("l_returnflag") == "R", "hi").otherwise("und").alias("hint"))
    rank = F.struct(F.when(F.col("hint") == "en", 0).when(F.col("hint") == "und", 1).otherwise(2), "position", "file")
    best = f.groupBy("document").agg(F.min_by(F.struct("position", "file", "hint"), rank).alias("x"), F.min("position").alias("first_position"))
    return best.select("document", "x.position", "x.file", "x.hint", (F.col("x.position") != F.col("first_position")).alias("changed"))


# lines are a record's files; their names say a language or none, and the choice so far is the file at one of five places, or none
_FILES = """f AS (SELECT l_orderkey AS record, l_linenumber AS position, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS file,
 CASE WHEN l_suppkey % 5 = 0 THEN 'en' WHEN l_suppkey % 5 < 3 THEN 'hi' ELSE 'und' END AS hint FROM lineitem),
r AS (SELECT o_orderkey AS record, CAST(o_orderkey AS VARCHAR) || '-' || CAST(1 + o_custkey % 5 AS VARCHAR) AS selected FROM orders)"""


@query(f"""WITH {_FILES}, c AS (SELECT *, row_number() OVER (PARTITION BY record ORDER BY CASE hint WHEN 'en' THEN 0 WHEN 'und' THEN 1 ELSE 2 END, position) AS k FROM f),
s AS (SELECT *, row_number() OVER (PARTITION BY record, file ORDER BY position, hint) AS k FROM f)
SELECT r.record, r.selected, c.file AS candidate, CASE WHEN c.file IS NULL THEN 'no ledger' WHEN s.file IS NULL THEN 'absent' WHEN c.file = r.selected THEN 'kept'
 WHEN c.hint = 'en' OR s.hint = 'hi' THEN 'changed' ELSE 'ambiguous' END AS outcome
FROM r LEFT JOIN c ON c.record = r.record AND c.k = 1 LEFT JOIN s ON s.record = r.record AND s.file = r.selected AND s.k = 1""")
def primary_reselection(spark, sf):
    """Every record's primary file chosen anew; ambiguous names leave the choice as it was."""
    o, l = t(spark, sf, "orders"), t(spark, sf, "lineitem")  # noqa: E741
    text = lambda c: F.col(c).cast("string")
    chosen = o.select(text("o_orderkey").alias("record_id"), F.concat(text("o_orderkey"), F.lit("-"), (1 + F.col("o_custkey") % 5).cast("string")).alias("document_sha256"))
    name = F.when(F.col("l_suppkey") % 5 == 0, "answer_English.pdf").when(F.col("l_suppkey") % 5 < 3, "answer-hin.pdf").otherwise("answer.pdf")
    files = l.select(text("l_orderkey").alias("record_id"), F.col("l_linenumber").alias("position"), name.alias("name"), F.concat(text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("document_sha256"))
    return attachments.reselection(chosen, files).select(F.col("record_id").cast("long").alias("record"), "selected", "candidate", "outcome")


@query("SELECT count(*) AS n_rows, count(DISTINCT conv_id * 1000 + turn) AS n_keys, count(*) = count(DISTINCT conv_id * 1000 + turn) AS proven FROM conversations")
def unique_count_proof(spark, sf):
    return integrity.unique_count(t(spark, sf, "conversations"), ["conv_id", "turn"])


@query("""WITH c AS (SELECT house, session, status, count(*) AS n FROM (""" + RECORDS + """) GROUP BY 1, 2, 3)
SELECT CASE WHEN grouping(house) = 0 THEN 'house' ELSE 'status' END AS kind, coalesce(house, status) AS name, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY GROUPING SETS ((house), (status))""")
def status_marginals(spark, sf):
    c = records(spark, sf).groupBy("house", "status").agg(F.count("*").alias("n"))
    g = c.groupingSets([[F.col("house")], [F.col("status")]], "house", "status").agg(F.sum("n").alias("n"), F.grouping("house").alias("g"))
    return g.select(F.when(F.col("g") == 0, "house").otherwise("status").alias("kind"), F.coalesce("house", "status").alias("name"), "n")


@query("""WITH d AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS position, count(*) OVER () AS total FROM documents)
SELECT doc_id, n_chars FROM d WHERE position IN (SELECT CAST(round_even(i * (total - 1) / 11.0, 0) AS BIGINT) FROM range(12) r(i))""")
def even_sample(spark, sf):
    """A sampling operator: twelve documents evenly spaced."""
    d = t(spark, sf, "documents").select("doc_id", "n_chars")
    return integrity.positions(d, ["doc_id"]).where(F.col("position").isin(sampling.even_positions(d.count(), 12))).drop("position")


@query("SELECT doc_id, lang FROM documents ORDER BY md5('17|' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100")
def seeded_sample(spark, sf):
    """A sampling operator: a hundred documents by seeded rank."""
    return sampling.seeded(t(spark, sf, "documents").select("doc_id", "lang"), 100, 17, "doc_id")


@query("""WITH r AS (SELECT doc_id, lang, n_chars, text, md5('5|' || CAST(doc_id AS VARCHAR)) AS k FROM documents), base AS (SELECT doc_id FROM r ORDER BY k, doc_id LIMIT 30),
tables AS (SELECT doc_id FROM r WHERE text LIKE '%|%' AND doc_id NOT IN (SELECT doc_id FROM base) ORDER BY k, doc_id LIMIT 10),
digits AS (SELECT doc_id FROM r WHERE regexp_matches(text, '[0-9]') AND doc_id NOT IN (SELECT doc_id FROM base) AND doc_id NOT IN (SELECT doc_id FROM tables) ORDER BY k, doc_id LIMIT 10)
SELECT doc_id, 'random_baseline' AS stratum FROM base UNION ALL SELECT doc_id, 'layout' FROM tables UNION ALL SELECT doc_id, 'numeric' FROM digits""")
def stratified_sample(spark, sf):
    """A sampling operator: strata of stated size, none overlapping."""
    d = t(spark, sf, "documents").select("doc_id", "text")
    return sampling.stratified(d, "doc_id", [("random_baseline", F.lit(True), 30), ("layout", F.col("text").contains("|"), 10), ("numeric", F.col("text").rlike("[0-9]"), 10)], 5).select("doc_id", "stratum")


@query("""WITH c AS (SELECT conv_id AS page, turn AS attempt, role AS provider FROM conversations)
SELECT provider, page, attempt FROM (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY page, attempt) AS k FROM c) WHERE k <= 3""")
def first_of_group(spark, sf):
    """Top rows of each provider are the feature."""
    return sampling.per_group(attempts(spark, sf).drop("text"), ["provider"], 3, [F.col("page"), F.col("attempt")]).select("provider", "page", "attempt")
