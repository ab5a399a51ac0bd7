"""Queries over versioned pages and their adjudications (conversations: page, attempt, provider)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliary.functions import rules
from foliary.operators import adjudicate, integrity, versions
from foliary.plans.catalog import query
from foliary.plans.frames import attempts, runs, t

_C = "c AS (SELECT conv_id AS page, turn AS attempt, role AS provider, text FROM conversations)"
_LAST = "l AS (SELECT page, max(attempt) AS attempt FROM c GROUP BY 1)"


@query("""SELECT l.l_orderkey AS document, m.run, count(*) AS pages FROM lineitem l JOIN (SELECT l_orderkey, max(l_linenumber) AS run FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) m
ON l.l_orderkey = m.l_orderkey AND l.l_linenumber = m.run WHERE l.l_linestatus = 'F' GROUP BY 1, 2""")
def latest_run(spark, sf):
    return versions.latest(runs(spark, sf).groupBy("document", "run").agg(F.count("*").alias("pages")), ["document"], "run").select("document", "run", "pages")


@query(f"WITH {_C}, {_LAST} SELECT c.page, c.attempt, c.provider, sha256(c.text) AS digest FROM c JOIN l ON c.page = l.page AND c.attempt = l.attempt")
def latest_adjudication(spark, sf):
    return versions.latest(attempts(spark, sf).withColumn("digest", F.sha2("text", 256)).drop("text"), ["page"], "attempt").select("page", "attempt", "provider", "digest")


@query(f"WITH {_C} SELECT page, attempt, provider FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY (provider = 'assistant') DESC, attempt DESC) AS k FROM c) WHERE k = 1")
def priority_adjudication(spark, sf):
    order = [F.when(F.col("provider") == "assistant", 0).otherwise(1), -F.col("attempt")]
    return versions.best(attempts(spark, sf).drop("text"), ["page"], order).select("page", "attempt", "provider")


@query(f"WITH {_C} SELECT p.page, (SELECT max(c.attempt) FROM c WHERE c.page = p.page AND c.provider = 'assistant') AS attempt FROM (SELECT DISTINCT page FROM c) p")
def provider_adjudication(spark, sf):
    c = attempts(spark, sf).select("page", "attempt", "provider")
    return c.groupBy("page").agg(F.max(F.when(F.col("provider") == "assistant", F.col("attempt"))).alias("attempt"))


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def pending_extraction(spark, sf):
    done = t(spark, sf, "labels").where("quality = 1").select("doc_id")
    return t(spark, sf, "documents").select("doc_id").join(done, "doc_id", "left_anti")


@query(f"WITH {_C} SELECT page, attempt FROM c u WHERE provider = 'user' AND NOT EXISTS (SELECT 1 FROM c a WHERE a.page = u.page AND a.attempt = u.attempt + 1 AND a.provider = 'assistant')")
def unadjudicated_pages(spark, sf):
    c = attempts(spark, sf).drop("text")
    answered = c.where("provider = 'assistant'").select("page", (F.col("attempt") - 1).alias("attempt"))
    return c.where("provider = 'user'").select("page", "attempt").join(answered, ["page", "attempt"], "left_anti")


_EXPORT = f"""WITH {_C}, {_LAST}, a AS (SELECT c.page, c.attempt, c.provider FROM c JOIN l ON c.page = l.page AND c.attempt = l.attempt),
p AS (SELECT d.doc_id, d.lang, l.quality, CASE WHEN l.quality = 1 THEN 'accepted' ELSE 'review' END AS status FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT p.doc_id, p.status, a.attempt, a.provider, CASE WHEN a.page IS NULL THEN 'engine' ELSE 'adjudication' END AS canonical_source FROM p LEFT JOIN a ON p.doc_id = a.page"""


def _export(spark, sf):
    quality = t(spark, sf, "labels").select("doc_id", "quality")
    pages = t(spark, sf, "documents").select("doc_id").join(quality, "doc_id", "left").select("doc_id", F.when(F.col("quality") == 1, "accepted").otherwise("review").alias("status"))
    child = attempts(spark, sf).select(F.col("page").alias("doc_id"), "attempt", "provider")
    joined = versions.with_latest_child(pages, child, ["doc_id"], "attempt")
    return joined.select("doc_id", "status", "attempt", "provider", F.when(F.col("attempt").isNull(), "engine").otherwise("adjudication").alias("canonical_source"))


@query(_EXPORT)
def export_all(spark, sf):
    return _export(spark, sf)


@query(_EXPORT + " WHERE p.status = 'accepted'")
def export_accepted(spark, sf):
    return _export(spark, sf).where("status = 'accepted'")


@query(_EXPORT + " WHERE p.status = 'accepted' OR a.page IS NOT NULL")
def export_canonical(spark, sf):
    return _export(spark, sf).where("status = 'accepted' OR attempt IS NOT NULL")


@query("""WITH c AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS model FROM conversations GROUP BY 1)
SELECT d.doc_id, d.source, l.quality, CASE WHEN c.model IS NULL THEN 'native' ELSE 'model' END AS layer, length(coalesce(c.model, d.text)) AS chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN c ON d.doc_id = c.conv_id""")
def multi_layer_join(spark, sf):
    c = attempts(spark, sf).groupBy(F.col("page").alias("doc_id")).agg(_joined("attempt", "text", " ").alias("model"))
    d = t(spark, sf, "documents").select("doc_id", "source", "text").join(t(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left").join(c, "doc_id", "left")
    return d.select("doc_id", "source", "quality", F.when(F.col("model").isNull(), "native").otherwise("model").alias("layer"), F.length(F.coalesce("model", "text")).cast("long").alias("chars"))


def _joined(order: str, text: str, separator: str):
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.coalesce(text, F.lit("")).alias("x")))), lambda r: r["x"]), separator)


@query(f"WITH {_C} SELECT page, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY attempt) AS markdown, count(*) AS pages FROM c GROUP BY 1")
def document_markdown(spark, sf):
    return attempts(spark, sf).groupBy("page").agg(_joined("attempt", "text", "\n\n").alias("markdown"), F.count("*").alias("pages"))


@query(f"""WITH {_C} SELECT page, count(*) AS n, count(*) FILTER (WHERE provider = 'user') AS native, count(*) FILTER (WHERE provider = 'assistant') AS ocr,
CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS chars, string_agg(CASE WHEN provider <> 'assistant' THEN CAST(attempt AS VARCHAR) END, ',' ORDER BY attempt) AS review_pages FROM c GROUP BY 1""")
def document_rollup(spark, sf):
    review = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("provider") != "assistant", F.col("attempt")))), lambda x: x.cast("string")), ",")
    return attempts(spark, sf).groupBy("page").agg(F.count("*").alias("n"), F.count_if(F.col("provider") == "user").alias("native"), F.count_if(F.col("provider") == "assistant").alias("ocr"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"), F.nullif(review, F.lit("")).alias("review_pages"))


@query(f"""WITH {_C}, p AS (SELECT page, attempt FROM c u WHERE provider = 'user' AND NOT EXISTS (SELECT 1 FROM c a WHERE a.page = u.page AND a.attempt = u.attempt + 1 AND a.provider = 'assistant' AND a.page % 3 = 0)),
n AS (SELECT page, attempt, row_number() OVER (ORDER BY page, attempt) AS k, count(*) OVER (PARTITION BY page) AS document_pages FROM p)
SELECT page, attempt, document_pages, document_pages > count(*) OVER (PARTITION BY page) AS cut FROM n WHERE k <= 100""")
def greedy_page_budget(spark, sf):
    """A budget of 100 pages over all documents in order, after those that are reviewed (answered, where three divides the id) are
    dropped; the last document is cut where the budget ends. The budget is the feature."""
    c = attempts(spark, sf).drop("text")
    reviewed = c.where("provider = 'assistant' AND page % 3 = 0").select("page", (F.col("attempt") - 1).alias("attempt"))
    return adjudicate.take_pages(c.where("provider = 'user'").join(reviewed, ["page", "attempt"], "left_anti").select("page", "attempt"), "page", "attempt", 100)


@query(f"""WITH {_C}, r AS (SELECT page, attempt, length(text) AS reserve, sha256('reader' || chr(31) || text) AS request_sha256 FROM c WHERE provider = 'user'),
s AS (SELECT DISTINCT request_sha256 FROM r WHERE page % 4 = 0),
n AS (SELECT r.*, s.request_sha256 IS NOT NULL AS known, row_number() OVER (PARTITION BY r.request_sha256 ORDER BY page, attempt) AS nth FROM r LEFT JOIN s USING (request_sha256)),
t AS (SELECT *, 500 + CAST(sum(CASE WHEN known OR nth > 1 THEN 0 ELSE reserve END) OVER (ORDER BY page, attempt) AS BIGINT) AS reserved FROM n)
SELECT page, attempt, request_sha256, reserved, CASE WHEN known THEN 'stored' WHEN nth > 1 THEN 'repeated' WHEN reserved <= 9000 THEN 'call' ELSE 'over budget' END AS state FROM t""")
def adjudication_plan(spark, sf):
    """User turns as requests in order, their lengths as reserves, under a ceiling of 9,000 of which 500 are spent; answers to those of
    every fourth conversation are stored already."""
    r = attempts(spark, sf).where("provider = 'user'").select("page", "attempt", F.length("text").cast("long").alias("reserve"), adjudicate.request_digest("reader", F.col("text")).alias("request_sha256"))
    return adjudicate.plan(r, ["page", "attempt"], r.where("page % 4 = 0"), 9000, 500).drop("reserve")


@query("""SELECT doc_id, CASE WHEN l.quality = 0 OR d.text LIKE '%|%' THEN 'selected' ELSE 'skipped' END AS review_or_table, d.doc_id IN (1, 2, 3, 5, 8, 13) AS listed, coalesce(l.quality = 0, false) AS review
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def page_selection_modes(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", F.col("text").contains("|").alias("table")).join(t(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    review = F.coalesce(F.col("quality") == 0, F.lit(False))
    return d.select("doc_id", F.when(review | F.col("table"), "selected").otherwise("skipped").alias("review_or_table"), F.col("doc_id").isin(1, 2, 3, 5, 8, 13).alias("listed"), review.alias("review"))


@query("""WITH m AS (SELECT conv_id, max_by(text, turn) AS model FROM conversations WHERE role = 'assistant' GROUP BY 1),
x AS (SELECT d.doc_id, d.text, m.conv_id IS NOT NULL AS has_model, CASE WHEN d.doc_id % 5 = 0 THEN '' ELSE m.model END AS model, d.doc_id % 10 = 0 AS blank, d.doc_id % 15 <> 0 AS ok, CASE WHEN d.doc_id % 2 = 0 THEN 'model' ELSE 'local' END AS policy FROM documents d LEFT JOIN m ON d.doc_id = m.conv_id)
SELECT doc_id, CASE WHEN has_model AND blank THEN 'visual:verified-blank' WHEN policy = 'model' AND has_model THEN 'model' ELSE 'local' END AS source,
 length(CASE WHEN has_model AND blank THEN '' WHEN policy = 'model' AND has_model THEN coalesce(model, '') ELSE text END) AS chars,
 concat_ws(',', CASE WHEN has_model AND NOT ok THEN 'invalid-metrics' END, CASE WHEN policy = 'model' AND has_model AND model = '' AND NOT blank THEN 'unproven-empty-model-text' END) AS violations FROM x""")
def canonical_selection(spark, sf):
    """Blank and invalid evidence are planted by rule on doc_id; every document has a row."""
    m = attempts(spark, sf).where("provider = 'assistant'").groupBy(F.col("page").alias("doc_id")).agg(F.max_by("text", "attempt").alias("answer"))
    i = F.col("doc_id")
    x = t(spark, sf, "documents").select("doc_id", "text").join(m, "doc_id", "left").withColumn("has_model", F.col("answer").isNotNull())
    x = x.withColumn("model", F.when(i % 5 == 0, "").otherwise(F.col("answer"))).withColumn("blank", i % 10 == 0).withColumn("ok", i % 15 != 0).withColumn("policy", F.when(i % 2 == 0, "model").otherwise("local"))
    text, source = rules.canonical(F.col("text"), F.col("model"), F.col("has_model"), F.col("blank"), F.col("policy"))
    found = rules.canonical_violations(F.col("model"), F.col("has_model"), F.col("blank"), F.col("ok"), F.col("policy"))
    return x.select("doc_id", source.alias("source"), F.length(text).cast("long").alias("chars"), F.array_join(found, ",").alias("violations"))


@query("SELECT role AS model, count(*) AS calls, count(*) FILTER (WHERE length(text) < 40) AS short, CAST(sum(length(text)) AS BIGINT) AS chars, median(length(text)) AS middle, CAST(max(length(text)) AS BIGINT) AS most FROM conversations GROUP BY 1")
def model_rates(spark, sf):
    n = F.length("text").cast("long")
    return t(spark, sf, "conversations").groupBy(F.col("role").alias("model")).agg(F.count("*").alias("calls"), F.count_if(n < 40).alias("short"), F.sum(n).alias("chars"), F.median(n).alias("middle"), F.max(n).alias("most"))


@query("""WITH n AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM conversations)
SELECT conv_id, CAST(floor(k / 2) AS BIGINT) AS chunk, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS n FROM n GROUP BY 1, 2""")
def chunk_numbering(spark, sf):
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    return t(spark, sf, "conversations").select("conv_id", "turn", integrity.chunk(k, 2).alias("chunk")).groupBy("conv_id", "chunk").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count("*").alias("n"))
