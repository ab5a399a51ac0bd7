"""Queries on progress, costs and agreement: run states, guards, coverage of transcripts, repeated scans, reuse."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliary.functions import text as X
from foliary.operators import audits
from foliary.plans.catalog import query
from foliary.plans.frames import RECORDS, attempts, records, t


@query("""SELECT user_id AS run, arg_max(event_type, event_id) AS state, count(*) AS transitions, min(ts) AS started_at, max(ts) AS finished_at FROM events GROUP BY 1""")
def run_states(spark, sf):
    """State transitions are appended; the current state is the last one."""
    return t(spark, sf, "events").groupBy(F.col("user_id").alias("run")).agg(F.max_by("event_type", "event_id").alias("state"), F.count("*").alias("transitions"), F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"))


@query("""WITH a AS (SELECT l_orderkey AS id, md5(string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey)) AS digest FROM lineitem WHERE l_orderkey % 17 <> 3 GROUP BY 1),
b AS (SELECT l_orderkey AS id, md5(string_agg(CAST(CASE WHEN l_orderkey % 19 = 4 THEN l_partkey + 1 ELSE l_partkey END AS VARCHAR), ',' ORDER BY l_partkey)) AS digest FROM lineitem GROUP BY 1)
SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'second only' WHEN b.id IS NULL THEN 'first only' ELSE 'differs' END AS state FROM a FULL JOIN b ON a.id = b.id WHERE a.digest IS DISTINCT FROM b.digest""")
def two_pass_agreement(spark, sf):
    """Two scans of a source must agree; lost and changed items are planted by rule."""
    k, l = F.col("l_orderkey"), t(spark, sf, "lineitem")  # noqa: E741
    digest = lambda rows, value: rows.groupBy(k.alias("id")).agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_partkey", value.alias("v")))), lambda x: x["v"].cast("string")), ",")).alias("digest"))
    a = digest(l.where(k % 17 != 3), F.col("l_partkey")).withColumnRenamed("digest", "first")
    b = digest(l, F.when(k % 19 == 4, F.col("l_partkey") + 1).otherwise(F.col("l_partkey"))).withColumnRenamed("digest", "second")
    state = F.when(F.col("first").isNull(), "second only").when(F.col("second").isNull(), "first only").otherwise("differs")
    return a.join(b, "id", "full").where(~F.col("first").eqNullSafe(F.col("second"))).select("id", state.alias("state"))


@query("""WITH s AS (SELECT user_id, event_id, CAST(floor(value) AS BIGINT) AS cost, CAST(sum(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS spent FROM events)
SELECT user_id, event_id, spent FROM s WHERE spent > 2000 AND spent - cost <= 2000""")
def cost_guard(spark, sf):
    """The call at which each user's spending passes the ceiling."""
    cost = F.floor("value").cast("long")
    s = t(spark, sf, "events").select("user_id", "event_id", cost.alias("cost"), F.sum(cost).over(Window.partitionBy("user_id").orderBy("event_id")).alias("spent"))
    return s.where((F.col("spent") > 2000) & (F.col("spent") - F.col("cost") <= 2000)).select("user_id", "event_id", "spent")


@query("SELECT conv_id, count(*) AS pages, count(*) > 4 AS refused FROM conversations GROUP BY 1")
def page_ceiling(spark, sf):
    return t(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("pages"), (F.count("*") > 4).alias("refused"))


@query("""WITH c AS (SELECT conv_id AS page, turn AS attempt, role AS provider, length(text) AS chars FROM conversations)
SELECT page, attempt, chars FROM c u WHERE provider = 'user' AND chars BETWEEN 60 AND 6000 AND NOT EXISTS (SELECT 1 FROM c a WHERE a.page = u.page AND a.provider = 'system')
ORDER BY CASE WHEN page % 3 = 0 THEN 0 WHEN page % 3 = 2 THEN 1 ELSE 2 END, chars DESC, page, attempt LIMIT 24""")
def benchmark_candidates(spark, sf):
    """A bounded set of pages for a throughput benchmark is the feature."""
    c = attempts(spark, sf).select("page", "attempt", "provider", F.length("text").cast("long").alias("chars"))
    rank = F.when(F.col("page") % 3 == 0, 0).when(F.col("page") % 3 == 2, 1).otherwise(2)
    seen = c.where("provider = 'system'").select("page")
    return c.where((F.col("provider") == "user") & F.col("chars").between(60, 6000)).join(seen, "page", "left_anti").orderBy(rank, F.desc("chars"), "page", "attempt").limit(24).select("page", "attempt", "chars")


@query("""WITH u AS (SELECT conv_id, turn FROM conversations WHERE role = 'user'), a AS (SELECT conv_id, turn - 1 AS turn, text FROM conversations WHERE role = 'assistant')
SELECT count(*) AS expected, count(*) FILTER (WHERE a.turn IS NULL) AS missing, count(*) FILTER (WHERE a.turn IS NOT NULL AND length(a.text) < 30) AS short, count(*) FILTER (WHERE length(a.text) >= 30) AS verified FROM u LEFT JOIN a ON u.conv_id = a.conv_id AND u.turn = a.turn""")
def transcript_counts(spark, sf):
    c = attempts(spark, sf)
    answers = c.where("provider = 'assistant'").select("page", (F.col("attempt") - 1).alias("attempt"), F.length("text").alias("n"))
    x = c.where("provider = 'user'").select("page", "attempt").join(answers, ["page", "attempt"], "left")
    return x.agg(F.count("*").alias("expected"), F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("n") < 30).alias("short"), F.count_if(F.col("n") >= 30).alias("verified"))


@query("""SELECT event_type, count(*) FILTER (WHERE value < 80) AS successes, median(value) AS middle, max(value) AS most, count(*) FILTER (WHERE value >= 80) AS failures FROM events GROUP BY 1""")
def concurrency_stats(spark, sf):
    return t(spark, sf, "events").groupBy("event_type").agg(F.count_if(F.col("value") < 80).alias("successes"), F.median("value").alias("middle"), F.max("value").alias("most"), F.count_if(F.col("value") >= 80).alias("failures"))


@query("""SELECT p_brand AS model, CAST(sum(p_size) AS BIGINT) AS tokens, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS cost, count(*) AS calls FROM part GROUP BY 1""")
def model_totals(spark, sf):
    return t(spark, sf, "part").groupBy(F.col("p_brand").alias("model")).agg(F.sum(F.col("p_size").cast("long")).alias("tokens"), F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("double").alias("cost"), F.count("*").alias("calls"))


@query("""SELECT doc_id, CASE WHEN l.quality = 1 AND d.source <> 'src0' THEN 'reuse' WHEN l.quality IS NULL THEN 'unmeasured' ELSE 'again' END AS decision FROM documents d LEFT JOIN labels l USING (doc_id)""")
def reuse_decision(spark, sf):
    """Whether a layer made under the same settings can be taken over."""
    d = t(spark, sf, "documents").select("doc_id", "source").join(t(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return d.select("doc_id", F.when((F.col("quality") == 1) & (F.col("source") != "src0"), "reuse").when(F.col("quality").isNull(), "unmeasured").otherwise("again").alias("decision"))


@query(f"SELECT DISTINCT lower(house) || '-p-s' || session AS scope, lower(house) AS house_part, session AS session_part FROM ({RECORDS})")
def scope_keys(spark, sf):
    key = F.concat(F.lower("house"), F.lit("-p-s"), F.col("session"))
    pattern = r"^([a-z_0-9]+)-p([^-]*)-s(.+)$"
    return records(spark, sf).select(key.alias("scope")).distinct().select("scope", F.regexp_extract("scope", pattern, 1).alias("house_part"), F.regexp_extract("scope", pattern, 3).alias("session_part"))


@query("""SELECT label, count(*) AS n, count(c) AS measured, sum(CAST(c AS DECIMAL(18,6)))::DOUBLE / count(c) AS mean FROM (SELECT label, CASE WHEN vec_id % 4 <> 0 THEN round(CAST(embedding[1] AS DOUBLE) * 1000) / 1000 END AS c FROM embeddings) GROUP BY 1""")
def mean_confidence(spark, sf):
    """A mean of the values that are there; null where none is."""
    c = F.when(F.col("vec_id") % 4 != 0, F.round(F.element_at("embedding", 1).cast("double") * 1000) / 1000).cast("decimal(18,6)")
    return t(spark, sf, "embeddings").select("label", c.alias("c")).groupBy("label").agg(F.count("*").alias("n"), F.count("c").alias("measured"), (F.sum("c").cast("double") / F.count("c")).alias("mean"))


@query("""WITH k AS (SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders), known AS (SELECT id FROM k WHERE id % 3 <> 0 AND position >= 2000)
SELECT CAST(k.position // 1000 AS BIGINT) AS page, count(*) AS items, count(known.id) AS overlap, count(*) - count(known.id) AS fresh FROM k LEFT JOIN known ON k.id = known.id GROUP BY 1""")
def prefix_append(spark, sf):
    """Pages of a source in its order: how many items are known, how many are new."""
    from foliary.operators.integrity import positions

    k = positions(t(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), ["id"])
    known = k.where("id % 3 <> 0 AND position >= 2000").select("id", F.lit(1).alias("known"))
    return k.join(known, "id", "left").groupBy(F.floor(F.col("position") / 1000).cast("long").alias("page")).agg(F.count("*").alias("items"), F.count("known").alias("overlap"), (F.count("*") - F.count("known")).alias("fresh"))


@query("""SELECT user_id, event_type, min(event_id) AS first_event, count(*) AS repeats FROM events GROUP BY 1, 2""")
def event_dedup(spark, sf):
    """What deduplication within a watermark keeps, over the whole log."""
    return t(spark, sf, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_event"), F.count("*").alias("repeats"))


@query("""SELECT conv_id, max(turn) AS last_turn, CAST(sum(CASE WHEN role = 'user' THEN length(text) ELSE 0 END) AS BIGINT) AS user_chars, bool_and(length(text) > 0) AS all_filled FROM conversations GROUP BY 1""")
def page_progress(spark, sf):
    c = t(spark, sf, "conversations")
    return c.groupBy("conv_id").agg(F.max("turn").alias("last_turn"), F.sum(F.when(F.col("role") == "user", F.length("text")).otherwise(0)).alias("user_chars"), F.bool_and(~X.is_blank(F.col("text"))).alias("all_filled"))


@query("""WITH c AS (SELECT conv_id AS document, turn // 3 AS run, turn % 3 AS page, turn, role, CASE WHEN conv_id % 9 = 4 THEN 'elsewhere/' WHEN conv_id % 2 = 0 THEN '/srv/data/artifacts/' ELSE 'data/artifacts/' END || 'd' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn // 3 AS VARCHAR) || '/attempt-' || CAST(turn AS VARCHAR) || '/response.json' AS response FROM conversations),
l AS (SELECT document, max(run) AS run FROM c WHERE document % 4 <> 3 GROUP BY 1),
e AS (SELECT DISTINCT CASE WHEN contains(response, 'data/artifacts/') THEN regexp_replace(substr(response, strpos(response, 'data/artifacts/')), '[^/]*$', 'adjudicated.md') ELSE response END AS path, contains(response, 'data/artifacts/') AS inside FROM (
  SELECT (SELECT arg_max(a.response, a.turn) FROM c a WHERE a.document = p.document AND a.run = p.run AND a.page = p.page AND a.role = 'assistant') AS response FROM c p JOIN l ON p.document = l.document AND p.run = l.run) WHERE response IS NOT NULL),
t AS (SELECT DISTINCT 'data/artifacts/d' || CAST(document AS VARCHAR) || '/' || CAST(run AS VARCHAR) || '/attempt-' || CAST(turn AS VARCHAR) || '/adjudicated.md' AS path FROM c WHERE role = 'assistant' AND document % 5 <> 1)
SELECT coalesce(e.path, t.path) AS path, CASE WHEN e.path IS NULL THEN 'unexpected' WHEN NOT inside THEN 'outside' WHEN t.path IS NULL THEN 'missing' ELSE 'present' END AS state FROM e FULL JOIN t ON e.path = t.path""")
def transcript_paths(spark, sf):
    """Turns as pages of runs (three a run), assistant turns as answers; a scope of documents, some of whose transcripts are missing, and
    responses that lie elsewhere, by rule."""
    c, d, n = t(spark, sf, "conversations").drop("text"), F.col("conv_id"), F.col("turn")
    run, text = F.floor(n / 3).cast("long"), lambda x: x.cast("string")
    folder = F.concat(F.lit("d"), text(d), F.lit("/"), text(run), F.lit("/attempt-"), text(n), F.lit("/"))
    root = F.when(d % 9 == 4, "elsewhere/").when(d % 2 == 0, "/srv/data/artifacts/").otherwise("data/artifacts/")
    ids = (d * 1_000_000 + run).alias("run_id")  # a document's runs in order
    runs = c.select((d * 1_000_000 + run).alias("id"), d.alias("document"), F.lit("complete").alias("status")).distinct()
    pages = c.select(ids, (n % 3).alias("page_number"))
    answers = c.select(n.alias("id"), ids, (n % 3).alias("page_number"), F.col("role").alias("provider"), F.concat(root, folder, F.lit("response.json")).alias("response_path"))
    listing = c.where((F.col("role") == "assistant") & (d % 5 != 1)).select(F.concat(F.lit("data/artifacts/"), folder, F.lit("adjudicated.md")).alias("path"))
    return audits.transcript_paths(c.where(d % 4 != 3).select(d.alias("document")), runs, pages, answers, listing, "assistant")
