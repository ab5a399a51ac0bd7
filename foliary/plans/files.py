"""Queries that go through files: archives, JSON lines, checksums. They write to a folder of their own in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliary.functions import text as X
from foliary.operators import archive, integrity, layers, proofs, publish, staging
from foliary.operators.staging import new_path
from foliary.plans.catalog import query
from foliary.plans.frames import t
from foliary.sources import documents, payloads, snapshots


@query("SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, min(sha256(text)) AS least_digest FROM documents GROUP BY 1")
def json_lines_round_trip(spark, sf):
    """Documents to gzip JSON lines and back."""
    path = new_path(spark, "files")
    publish.write_json_lines(t(spark, sf, "documents").select("doc_id", "text", "source", "n_chars"), path)
    back = spark.read.schema("doc_id long, text string, source string, n_chars long").json(path)
    return back.groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.min(F.sha2("text", 256)).alias("least_digest"))


@query("SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS size, sha256(html) AS hash, true AS as_listed FROM pages")
def bundle_verify(spark, sf):
    """Pages as archives: written by the tasks, then read back by member, each archive against the hash that its writer gave."""
    name = F.lpad(F.col("page_id").cast("string"), 12, "0")
    pages = t(spark, sf, "pages").select(name.alias("key"), F.concat(name, F.lit(".html")).alias("name"), F.encode("html", "utf-8").alias("content"))
    path = new_path(spark, "bundle")
    written = publish.write_tar_shards(pages, path)
    wanted = written.select(F.element_at(F.split("path", "/"), -1).alias("path"), "size", "hash")
    same = integrity.compare_files(wanted, publish.checksums(spark, path)).select(F.col("path").alias("shard"), (F.col("state") == "same").alias("as_listed"))
    members = documents.archive_members(spark, path).withColumn("shard", F.element_at(F.split("archive", "/"), -1))
    read = members.select(F.regexp_extract("name", "([0-9]+)[.]html$", 1).cast("long").alias("page_id"), "size", F.sha2("content", 256).alias("hash"), "shard")
    return read.join(F.broadcast(same), "shard").drop("shard")


@query("SELECT doc_id, source, sha256(text) AS digest FROM documents")
def zstd_lines(spark, sf):
    """Documents as zstd JSON lines and back."""
    path = new_path(spark, "lines")
    publish.write_zstd_lines(t(spark, sf, "documents").select("doc_id", "text", "source"), path, lines_per_block=400)
    back = publish.read_zstd_lines(spark, path, "doc_id long, source string, text string")
    return back.select("doc_id", "source", F.sha2("text", 256).alias("digest"))


@query("""SELECT 'rs_qsl' || CAST(l_orderkey AS VARCHAR) || '_en' AS record_id, count(DISTINCT l_suppkey) AS members, CAST(min(l_linenumber) AS VARCHAR) AS document_number FROM lineitem GROUP BY l_orderkey""")
def question_grouping(spark, sf):
    """Lines as question rows: an order is a question, suppliers its members, the first line its number."""
    l = t(spark, sf, "lineitem")  # noqa: E741
    rows = l.select(
        (F.col("l_linenumber").cast("long") * 100000 + F.col("l_suppkey")).alias("ordinal"), F.col("l_orderkey").alias("qslno"), F.lit(" file.pdf ").alias("files"), F.lit("Member").alias("shri"), F.concat(F.col("l_suppkey").cast("string"), F.lit(" ")).alias("name"),
        F.lit("t").alias("qtitle"), F.lit("starred").alias("qtype"), F.lit("2.4.2026").alias("ans_date"), F.col("l_linenumber").cast("double").alias("qno"), F.lit("m").alias("min_name"), F.lit(5).alias("ses_no"),
    )
    return payloads.question_rows(rows).select("record_id", F.size("members").cast("long").alias("members"), "document_number")


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN 'https://repository.example/handle/h' || CAST(page_id AS VARCHAR) ELSE 'https://repository.example/server/api/core/items/' || CAST(page_id AS VARCHAR) END AS source_url,
CASE WHEN page_id % 2 = 0 THEN 'en' ELSE 'und' END AS language, CASE WHEN page_id % 5 = 0 THEN 'XII' ELSE 'Ram XII' END AS session, CASE WHEN page_id % 5 = 0 THEN 'RamXII' END AS original_session FROM pages""")
def repository_records(spark, sf):
    """Search hits as JSON text, parsed into records."""
    i = F.col("page_id")
    value = lambda *xs: F.array(*(F.struct(x.alias("value")) for x in xs))
    metadata = F.struct(
        value(F.when(i % 3 == 0, F.col("url")).otherwise(" ")).alias("dc.identifier.uri"), value(F.lit(" "), F.lit("Ram")).alias("dc.contributor.members"), value(F.when(i % 5 == 0, "RamXII").otherwise("Ram XII")).alias("dc.identifier.sessionnumber"),
        value(F.when(i % 2 == 0, "English").otherwise("Original")).alias("dc.language.iso"),
    )
    item = F.struct(i.cast("string").alias("uuid"), F.when(i % 3 == 1, F.concat(F.lit("h"), i.cast("string"))).alias("handle"), metadata.alias("metadata"))
    hits = t(spark, sf, "pages").select(F.to_json(F.struct(F.struct(item.alias("indexableObject")).alias("_embedded"))).alias("item"))
    return payloads.repository_items(hits).select(F.col("item_id").cast("long").alias("page_id"), "source_url", "language", "session", "original_session")


@query("SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1)) AS host, regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1) AS file_name FROM pages")
def url_parts(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.lower(F.regexp_extract("url", "^[a-z]+://([^/:?#]*)", 1)).alias("host"), F.regexp_extract("url", "([^/?#]*)(?:[?#].*)?$", 1).alias("file_name"))


@query("SELECT doc_id, sha1(encode('blob ' || CAST(octet_length(encode(text)) AS VARCHAR)) || '\\x00'::BLOB || encode(text)) AS blob_id, sha256(encode(CAST(doc_id AS VARCHAR)) || '\\x00'::BLOB || encode(source)) AS identity FROM documents")
def content_identities(spark, sf):
    return t(spark, sf, "documents").select("doc_id", publish.git_blob_id(F.encode("text", "utf-8")).alias("blob_id"), F.sha2(F.concat(F.encode(F.col("doc_id").cast("string"), "utf-8"), F.lit(b"\0"), F.encode("source", "utf-8")), 256).alias("identity"))


@query("SELECT CAST(p_partkey AS BIGINT) AS id, p_size > 0 AND 100.0 * (p_size - p_size % 7) / p_size >= 90 AS keep FROM part")
def optimised_copies(spark, sf):
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("original_bytes"), (F.col("p_size") % 7).alias("optimised_bytes"))
    return publish.keep_optimised(p, 90.0).select("id", "keep")


@query("""SELECT doc_id, '2026-02-0' || CAST(doc_id % 9 + 1 AS VARCHAR) || '_Q' || CASE WHEN doc_id % 2 = 0 THEN '5' ELSE CAST(doc_id AS VARCHAR) END || '_' ||
 (CASE WHEN s = '' THEN 'document' ELSE rtrim(substr(s, 1, 70), '-') END) || '__' || substr(sha256(text), 1, 8) AS slug FROM (SELECT *, trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM documents)""")
def document_slugs(spark, sf):
    i = F.col("doc_id")
    day = F.concat(F.lit("2026-02-0"), (i % 9 + 1).cast("string"))
    number = F.when(i % 2 == 0, "5").otherwise("")
    return t(spark, sf, "documents").select("doc_id", X.document_slug(day, number, F.concat(F.lit("rec_"), i.cast("string")), F.col("text"), F.lit("x"), F.lit("questions_answers"), F.sha2("text", 256)).alias("slug"))


@query("SELECT house, session, count(*) AS n FROM (SELECT n_name AS house, c_mktsegment AS session FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1, 2")
def snapshot_import(spark, sf):
    """Customers as a census snapshot: exported as gzip JSON lines, imported with all its checks."""
    c = t(spark, sf, "customer").join(t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    path = new_path(spark, "files")
    snapshots.export_snapshot(c.select(F.concat(F.lit("elibrary_"), F.col("c_custkey").cast("string")).alias("record_id"), F.col("n_name").alias("house"), F.col("c_mktsegment").alias("session")), path)
    return snapshots.import_snapshot(spark, path, source="elibrary").groupBy("house", "session").agg(F.count("*").alias("n"))


_POSITIONS = "(SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, CAST(doc_id AS VARCHAR) AS key, CAST(n_chars AS BIGINT) AS chars FROM documents)"


def _layer(spark, sf):
    """A layer over all documents, stopped in the middle of a shard and resumed; and its inventory."""
    d = t(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("key"), F.col("n_chars").cast("long").alias("chars"))
    inventory = staging.stage(integrity.positions(d, ["doc_id"]), "inventory")
    layer, total = layers.Layer(spark, new_path(spark, "layer"), "chars", "chars long"), inventory.count()
    layer.add(inventory.where("position < 150"), total)
    layer.add(inventory.where(F.col("position") >= layer.next_position()), total)
    return layer, inventory


@query(f"SELECT position, key, chars, position // 100 AS shard FROM {_POSITIONS}")
def layer_resume(spark, sf):
    layer, inventory = _layer(spark, sf)
    return layer.read(inventory)


@query(f"SELECT position // 100 AS shard, min(position) AS first, max(position) AS last, count(*) AS n_rows, 'chars' AS layer FROM {_POSITIONS} GROUP BY 1, 5")
def shard_verify(spark, sf):
    """The manifest that the layer's readers hold its shards against."""
    return _layer(spark, sf)[0].manifest().drop("digest", "origins")


@query("""WITH p AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, lang, source FROM documents),
c AS (SELECT position // 100 AS shard, lang AS origin, count(*) AS n FROM p GROUP BY 1, 2)
SELECT shard, string_agg(origin || ':' || CAST(n AS VARCHAR), ',' ORDER BY origin) AS origins, CAST(sum(n) AS BIGINT) AS n_rows FROM c GROUP BY 1""")
def layer_origins(spark, sf):
    """A layer of all documents whose rows name their language as origin, read back and held against its manifest; the counts of origins
    are those of the rows read."""
    d = t(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("key"), F.col("lang").alias("origin"))
    inventory = staging.stage(integrity.positions(d, ["doc_id"]), "inventory")
    layer = layers.Layer(spark, new_path(spark, "layer"), "origins", "origin string", origin="origin")
    layer.add(inventory, inventory.count())
    return layers.digests(layer.read(inventory), "origins", "origin").select("shard", "origins", "n_rows")


@query("""SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, CAST(octet_length(encode(text)) AS BIGINT) AS size, sha256(text) AS hash, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS generation, 'kept' AS state FROM documents""")
def raw_increment(spark, sf):
    """Documents as files, archived in two generations (those whose id three divides come in the second); sizes and hashes are those of
    the bytes read back from the packs, the state that of a third save, which would add nothing."""
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    content = F.encode("text", "utf-8")
    d = t(spark, sf, "documents").select("doc_id", path.alias("path"), F.octet_length(content).cast("long").alias("size"), F.sha2(content, 256).alias("hash"), content.alias("content"))
    kept = archive.RawArchive(spark, new_path(spark, "raw"))
    kept.save(d.where("doc_id % 3 <> 0").drop("doc_id"), pack_bytes=1 << 20)
    kept.save(d.drop("doc_id"), pack_bytes=1 << 20)
    state = archive.compare(d, kept.index()).select("path", "state")
    return kept.members().drop("pack").join(kept.index().select("path", "generation"), "path").join(state, "path")


@query("""WITH n AS (SELECT doc_id, n_chars, length(text) AS chars, row_number() OVER (ORDER BY doc_id) - 1 AS position, count(*) OVER () AS total FROM documents)
SELECT position, doc_id, CAST(n_chars AS BIGINT) AS n_chars, CASE WHEN position < total * 2 // 3 THEN chars END AS read_chars FROM n""")
def positional_merge(spark, sf):
    """All documents and a layer that has come to two thirds of them, zipped by position."""
    d = staging.stage(t(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.length("text").cast("long").alias("chars")), "documents")
    layer = integrity.positions(d.select("doc_id", "chars"), ["doc_id"]).where(F.col("position") < d.count() * 2 // 3).drop("position")
    rows = proofs.require_merge(d.select("doc_id", "n_chars"), layer, ["doc_id"])
    return rows.select("position", "doc_id", "left.n_chars", F.col("right.chars").alias("read_chars"))


@query("""WITH b AS (SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS record_id, o_orderstatus AS status FROM orders WHERE o_orderkey % 7 <> 1),
f AS (SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS record_id, 'fresh' AS status FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 11 <> 2)
SELECT record_id, status FROM b WHERE status <> 'F' UNION ALL SELECT record_id, status FROM f""")
def snapshot_assembly(spark, sf):
    """Orders as a census whose source F is refreshed: some ids of it are new and some are gone; read back from the claimed snapshot."""
    k, o = F.col("o_orderkey"), t(spark, sf, "orders")
    record = F.concat(F.lit("r"), k.cast("string")).alias("record_id")
    base = o.where(k % 7 != 1).select(record, F.col("o_orderstatus").alias("status"))
    fresh = o.where((F.col("o_orderstatus") == "F") & (k % 11 != 2)).select(record, F.lit("fresh").alias("status"))
    counts = base.agg(F.count("*").alias("base"), F.count_if(F.col("status") == "F").alias("base_refreshed")).first().asDict() | {"fresh": fresh.count()}
    path = new_path(spark, "snapshot")
    proofs.assemble_snapshot(base, fresh, F.col("status") == "F", path, counts)
    return proofs.read_snapshot(spark, path, "record_id string, status string")


@query("""WITH d AS (SELECT sha256(text) AS h, min(doc_id) AS k, list('r' || CAST(doc_id AS VARCHAR)) AS records, octet_length(encode(any_value(text))) AS size FROM documents GROUP BY 1),
x AS (SELECT doc_id, sha256(text) AS h FROM documents)
SELECT 'counts' AS "check", 'page_count' AS what, CAST((SELECT count(*) FROM d) + (SELECT count(*) FROM d WHERE k % 89 = 3) AS VARCHAR) || ' where ' || CAST((SELECT count(*) FROM d) AS VARCHAR) || ' are published' AS problem WHERE (SELECT count(*) FROM d WHERE k % 89 = 3) > 0
UNION ALL SELECT 'pages', h || '/1', 'repeated' FROM d WHERE k % 89 = 3
UNION ALL SELECT 'members', h || '.pdf', 'other bytes' FROM d WHERE k % 83 = 7 AND k % 101 <> 11
UNION ALL SELECT 'members', h, 'missing' FROM d WHERE k % 101 = 11
UNION ALL SELECT 'attachments', 'r' || CAST(doc_id AS VARCHAR), 'record without attachment' FROM x WHERE doc_id % 97 = 5 OR doc_id % 79 = 13
UNION ALL SELECT 'attachments', 'r' || CAST(doc_id AS VARCHAR), 'not a published document' FROM x WHERE doc_id % 79 = 13""")
def publication_violations(spark, sf):
    """Documents as a publication (tables, archives, checksums, attachments), written and read back. Pages that repeat, members with other
    bytes or none, and attachments that are lost or, which goes first, lead elsewhere are planted by rule; whole texts are published."""
    d, k = t(spark, sf, "documents"), F.col("k")
    digest, content, record = F.sha2("text", 256), F.encode("text", "utf-8"), F.concat(F.lit("r"), F.col("doc_id").cast("string"))
    docs = staging.stage(d.groupBy(digest.alias("document_sha256")).agg(F.min("doc_id").alias("k"), F.collect_list(record).alias("record_ids"), F.any_value(content).alias("content")), "published")
    path, scope = new_path(spark, "publication"), {"house": "h", "parliament": "1", "session": "2"}
    pages = docs.select("document_sha256", F.lit(1).alias("page_number"), "k")
    pages.unionByName(pages.where(k % 89 == 3)).drop("k").write.parquet(f"{path}/pages.parquet")
    docs.select("document_sha256", F.octet_length("content").cast("long").alias("size_bytes"), "record_ids").write.parquet(f"{path}/documents.parquet")
    name = F.concat(F.col("document_sha256"), F.lit(".pdf"))
    publish.write_tar_shards(docs.where(k % 101 != 11).select(name.alias("key"), name.alias("name"), F.when(k % 83 == 7, F.concat("content", F.lit(b"!"))).otherwise(F.col("content")).alias("content")), f"{path}/archives")
    sums = staging.stage(publish.checksums(spark, path), "sums")
    i = F.col("doc_id")
    attachments = d.where((i % 97 != 5) | (i % 79 == 13)).select(record.alias("record_id"), F.when(i % 79 == 13, F.sha2(record, 256)).otherwise(digest).alias("document_sha256"))
    members = documents.archive_members(spark, f"{path}/archives").select("name", "size", F.sha2("content", 256).alias("hash"))
    counts = {"document_count": docs.count(), "page_count": docs.count(), "attachment_count": attachments.count()}
    marker = scope | {"complete": True, "tranche": "data/h/parliament-1/session-2/x"}
    read = lambda name: spark.read.parquet(f"{path}/{name}.parquet")
    return proofs.publication_violations(spark, scope, marker, sums, publish.checksums(spark, path), counts, read("documents"), read("pages"), staging.stage(members, "members"), attachments)
