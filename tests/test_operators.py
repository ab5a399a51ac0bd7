"""Versions, integrity, samples, publication, streams and sources."""

import hashlib
import io
import json
import os
import tarfile
import urllib.error

import pytest
from pyspark.sql import functions as F

from foliary.operators import integrity, publish, sampling, versions
from foliary.sources import documents, http_json, payloads, snapshots
from foliary.streaming import events


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_and_priority(spark):
    a = spark.createDataFrame([(1, 1, "openrouter"), (1, 2, "other"), (2, 5, "other"), (3, None, "other")], "page int, id int, provider string")
    assert rows(versions.latest(a, ["page"], "id")) == [(1, 2, "other"), (2, 5, "other")]
    order = [F.when(F.col("provider") == "openrouter", 0).otherwise(1), -F.col("id")]
    assert rows(versions.best(a.where("id IS NOT NULL"), ["page"], order)) == [(1, 1, "openrouter"), (2, 5, "other")]
    parents = spark.createDataFrame([(1,), (9,)], "page int")
    assert rows(versions.with_latest_child(parents, a, ["page"], "id").na.fill(-1).na.fill("")) == [(1, 2, "other"), (9, -1, "")]


def test_upsert_is_idempotent_and_keeps_states(spark):
    old = spark.createDataFrame([("a", "t1", "downloaded"), ("b", "t2", "failed")], "id string, title string, status string")
    new = spark.createDataFrame([("a", "T1", "discovered"), ("c", "T3", "discovered")], "id string, title string, status string")
    once = versions.upsert(old, new, "id", ["status"])
    assert rows(once) == [("a", "T1", "downloaded"), ("b", "t2", "failed"), ("c", "T3", "discovered")]
    assert rows(versions.upsert(once, new, "id", ["status"])) == rows(once)
    assert rows(versions.insert_or_ignore(old, new, ["id"])) == [("a", "t1", "downloaded"), ("b", "t2", "failed"), ("c", "T3", "discovered")]
    assert rows(versions.conflicts(old, new, ["id"], "title")) == [("a", "t1", "T1")]


def test_integrity(spark):
    s = spark.createDataFrame([("x", 0, 9), ("x", 10, 19), ("x", 21, 30), ("y", 5, 6)], "g string, a int, b int")
    assert [r.a for r in integrity.gaps(s, ["g"], "a", "b").collect()] == [21]
    assert rows(integrity.duplicates(s, ["g"])) == [("x", 3)]
    assert rows(integrity.unique_count(s, ["g", "a"])) == [(4, 4, True)]
    with pytest.raises(ValueError, match="gap"):
        integrity.require_none(integrity.gaps(s, ["g"], "a", "b"), "gap")
    e = spark.createDataFrame([("p", 1, "h"), ("q", 1, "h"), ("r", 1, "h"), ("s", 1, "h")], "path string, size long, hash string")
    a = spark.createDataFrame([("p", 1, "h"), ("q", 2, "h"), ("r", 1, "i"), ("t", 1, "h")], "path string, size long, hash string")
    assert rows(integrity.compare_files(e, a)) == [("p", "same"), ("q", "size"), ("r", "hash"), ("s", "missing"), ("t", "unexpected")]
    n = spark.range(0, 5000, 1, 7).withColumn("v", F.col("id") * 3 % 5003).withColumn("wide", F.repeat(F.lit("x"), 300))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")  # so that ranges aren't merged to one
    got = integrity.positions(n, ["v"]).orderBy("v").collect()
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert [r.position for r in got] == list(range(5000))


def test_samples(spark):
    d = spark.range(100).withColumn("t", F.col("id") % 4 == 0)
    s = sampling.stratified(d, "id", [("base", F.lit(True), 12), ("quarter", F.col("t"), 6), ("fill", F.lit(True), 6)], 7)
    got = s.collect()
    assert len(got) == 24 and len({r.id for r in got}) == 24 and sum(r.stratum == "base" for r in got) == 12
    assert rows(s) == rows(sampling.stratified(d.repartition(5), "id", [("base", F.lit(True), 12), ("quarter", F.col("t"), 6), ("fill", F.lit(True), 6)], 7))
    assert sampling.even_positions(10, 4) == [0, 3, 6, 9] and sampling.even_positions(3, 5) == [0, 1, 2] and sampling.even_positions(0, 3) == [] and sampling.even_positions(9, 1) == [0]


def test_publication(spark, tmp_path):
    pages = spark.createDataFrame([("d", 2, "two"), ("d", 1, "one"), ("d", 3, None)], "doc string, page int, text string")
    assert rows(publish.document_text(pages, ["doc"], "page", "text")) == [("d", "one\n\ntwo\n\n", 3)]
    members = spark.createDataFrame([(f"k{i:03}", f"k{i:03}.txt", f"text {i}".encode()) for i in range(40)], "key string, name string, content binary")
    shards = publish.write_tar_shards(members, str(tmp_path / "tar")).collect()
    names = []
    for r in sorted(shards):
        with tarfile.open(r.path) as tar:
            names += [m.name for m in tar]
            assert all(m.mtime == 0 and m.uid == 0 for m in tar) and r.size == os.path.getsize(r.path)
    assert names == sorted(names) and len(names) == 40 and not [f for f in os.listdir(tmp_path / "tar") if f.endswith(".tmp")]
    assert {r.hash for r in publish.write_tar_shards(members.repartition(3), str(tmp_path / "tar2")).collect()} == {r.hash for r in shards}
    written = publish.write_zstd_lines(members.select("key", "name"), str(tmp_path / "lines"), lines_per_block=15)
    assert written.agg(F.sum("lines")).first()[0] == 40
    assert [r.key for r in publish.read_zstd_lines(spark, str(tmp_path / "lines"), "key string, name string").orderBy("key").collect()] == sorted(f"k{i:03}" for i in range(40))
    folder = tmp_path / "bundle"
    folder.mkdir()
    (folder / "a.txt").write_text("a")
    expected = publish.checksums(spark, str(folder))
    expected = spark.createDataFrame(expected.collect(), expected.schema)
    assert publish.verify(spark, str(folder), expected).count() == 0
    (folder / "a.txt").write_text("b")
    (folder / "c.txt").write_text("c")
    assert rows(publish.verify(spark, str(folder), expected)) == [("a.txt", "hash"), ("c.txt", "unexpected")]
    assert spark.range(1).select(publish.git_blob_id(F.lit(b"hello\n")).alias("x")).first().x == "ce013625030ba8dba906f756967f9e9ca394464a"
    publish.write_tables(pages, pages, str(tmp_path / "tables"))
    publish.duckdb_snapshot(str(tmp_path / "tables"), str(tmp_path / "x.duckdb"))
    assert len(publish.tranche_id({"b": b"1", "a": b"2"})) == 20


def test_requests_retry_and_give_up():
    calls, waits = [], []

    def opener(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.URLError("down")
        return b'{"a": 1}'

    assert http_json.request_json("http://x", {"q": "a b"}, opener=opener, sleep=waits.append) == {"a": 1}
    assert calls[0] == "http://x?q=a+b" and waits == [1, 2]
    with pytest.raises(RuntimeError):
        http_json.request_json("http://x", opener=lambda u, t: b"{", sleep=waits.append)
    gone = lambda u, t: (_ for _ in ()).throw(urllib.error.HTTPError(u, 404, "gone", {}, None))
    with pytest.raises(RuntimeError):
        http_json.download("http://x", opener=gone, sleep=lambda s: pytest.fail("no second try"))
    assert http_json.retry_after("7", 0, 1) == 7 and http_json.retry_after(None, 0, 3) == 3 and http_json.retry_after("x", 0, 4) == 4
    assert http_json.retry_after("Thu, 01 Jan 1970 00:01:00 GMT", 30, 1) == 30


def test_paged_source(spark):
    class Fake(http_json.PagedJson):
        @staticmethod
        def opener(url, timeout):
            import urllib.parse

            n = int(urllib.parse.parse_qs(urllib.parse.urlparse(url).query)["page"][0])
            ids = range(n * 10, min(25, n * 10 + 10))
            return json.dumps({"page": {"number": n, "size": 10, "totalElements": 25, "totalPages": 3}, "items": [{"id": i} for i in ids]}).encode()

        @classmethod
        def name(cls):
            return "fake_paged"

    reader = Fake({"url": "http://x", "pagesize": "10"}).reader(None)
    parts = reader.partitions()
    got = [r for p in parts for r in reader.read(p)]
    assert len(parts) == 3 and [r[0] for r in got] == list(range(25)) and json.loads(got[24][2]) == {"id": 24}
    with pytest.raises(RuntimeError, match="totals changed"):
        http_json.check_page({"page": {"number": 1, "size": 10, "totalElements": 26, "totalPages": 3}}, 1, 10, 25, 3)
    with pytest.raises(ValueError):
        http_json.check_page({}, 0, 101, None, None)


def test_payloads(spark):
    s = spark.createDataFrame([(json.dumps([{"loksabha": 18, "sessions": [{"sessionNo": 10}, {"sessionNo": 9}]}, {"loksabha": 17, "sessions": [{"sessionNo": 9}, {"sessionNo": 9}]}]),)], "value string")
    found = payloads.sessions(s)
    assert [tuple(r) for r in found.collect()] == [(17, 9), (18, 9), (18, 10)] and rows(payloads.latest_session(found)) == [(18, 10)]
    q = "ordinal int, qslno string, files string, shri string, name string, qtitle string, qtype string, ans_date string, qno double, min_name string, ses_no int"
    data = [(1, "7", "u ", "Shri", "A", "t", "starred", "02.04.2026", 4455.0, "m", 5), (2, "7", "v", "Smt", "B", "x", "", "", 1.0, "", 5), (3, "7", "v", "Shri", "A", "x", "", "", 1.0, "", 5), (4, "8", " ", "S", "C", "x", "", "", 1.0, "", 5), (5, None, "w", None, "D", "x", None, None, None, None, 5)]
    got = {r.record_id: r for r in payloads.question_rows(spark.createDataFrame(data, q)).collect()}
    assert set(got) == {"rs_qsl7_en", "rs_qslw_en"}
    assert got["rs_qsl7_en"].members == ["Shri A", "Smt B"] and got["rs_qsl7_en"].document_number == "4455" and got["rs_qsl7_en"].document_date == "2026-04-02" and got["rs_qsl7_en"].document_subtype == "STARRED"
    assert got["rs_qslw_en"].members == ["D"] and got["rs_qslw_en"].document_subtype == "UNKNOWN"
    hit = lambda i, **m: json.dumps({"_embedded": {"indexableObject": {"uuid": i, "handle": "", "metadata": {k: [{"value": x} for x in v] for k, v in m.items()}}}})
    items = payloads.repository_items(spark.createDataFrame([(hit("a", **{"dc.title": ["", " T "]}),), (hit("b"),), (hit("b"),), (hit(""),)], "item string")).collect()
    assert sorted((r.item_id, r.problem or "", r.title) for r in items) == [("", "no id", ""), ("a", "", "T"), ("b", "repeated id", ""), ("b", "repeated id", "")]
    f = spark.createDataFrame([("r", 0, "a_hindi.pdf", []), ("r", 1, "b_english.pdf", []), ("s", 0, "x.pdf", ["Hindi"]), ("s", 1, "y.pdf", [])], "record_id string, position int, name string, labels array<string>")
    assert [(r.record_id, r.position) for r in payloads.primary_files(f).orderBy("record_id").collect()] == [("r", 1), ("s", 1)]
    b = spark.createDataFrame([("r", "ORIGINAL", "1", "a.pdf", None), ("s", "TEXT", "1", "a.txt", None), ("t", "ORIGINAL", "1", "a.doc", "text/plain"), ("u", "ORIGINAL", "1", "a", "application/pdf"), ("u", "ORIGINAL", "1", "b", "application/pdf")], "record_id string, bundle string, bitstream_id string, name string, mime string")
    assert rows(payloads.file_problems(b)) == [("s", "no original bundle"), ("t", "no pdf"), ("u", "repeated file id")]


def test_snapshots(spark, tmp_path):
    path = tmp_path / "census.jsonl"
    path.write_text("".join(json.dumps({"record_id": i, "house": "h", "session": s}) + "\n" for i, s in (("elibrary_2", "1"), ("m1", "1"), ("elibrary_1", "2"))))
    digest = snapshots.file_digest(spark, str(path))
    assert {r.record_id for r in snapshots.import_snapshot(spark, str(path), expected_sha256=digest).collect()} == {"elibrary_1", "elibrary_2", "m1"}
    assert [r.record_id for r in snapshots.import_snapshot(spark, str(path), offset=1, limit=1).collect()] == ["elibrary_2"]
    assert {r.record_id for r in snapshots.import_snapshot(spark, str(path), source="modern").collect()} == {"m1"}
    with pytest.raises(ValueError, match="SHA-256"):
        snapshots.import_snapshot(spark, str(path), expected_sha256="0")
    with path.open("a") as f:
        f.write('{"record_id": "m1"}\n')
    with pytest.raises(ValueError, match="repeat"):
        snapshots.import_snapshot(spark, str(path))
    path.write_text("{broken\n")
    with pytest.raises(Exception, match=r"(?i)malformed"):
        snapshots.import_snapshot(spark, str(path)).collect()
    assert snapshots.last_json('log {"x": 1}\n{"a": {\n"b": 1}}\n{"c": 2}') == {"c": 2}
    assert snapshots.load_config("[routing]\nleast_characters = 9\nnew_key = 1\n[extraction]\ndpi = 200").routing == {"least_characters": 9}
    with pytest.raises(ValueError):
        snapshots.load_config("[validation]\nnew_key = 1")


def fake_extractor():
    class FakeExtractor:
        """Pages are lines of the file after its magic; OCR reads them in capitals."""

        def page_count(self, content):
            return len(content.split(b"\n")) - 1

        def pages(self, content, numbers, ocr):
            for i, line in enumerate(content.decode().split("\n")[1:], 1):
                if line == "lost":
                    return
                yield {"page_number": i, "text": line.upper() if ocr else line, "markdown": line, "mean_confidence": 0.9 if ocr else None, "reasons": [], "full_page_image": False}

    return FakeExtractor()  # a class of a function goes to executors by value


def test_originals_and_extraction(spark, tmp_path):
    for name, data in (("a.pdf", "%PDF-1\nlong native line\n"), ("b.pdf", "%PDF-1\nlong native line\n"), ("c.pdf", "not one"), ("d.pdf", "%PDF-1\nx\nlost")):
        (tmp_path / name).write_text(data)
    files = documents.originals(spark, str(tmp_path))
    assert files.count() == 3 and [r.error for r in documents.not_originals(spark, str(tmp_path)).collect()] == ["not a PDF"]
    store = str(tmp_path / "store")
    documents.store(files, store)
    documents.store(files, store)
    assert spark.read.parquet(store).count() == 2
    one = files.dropDuplicates(["sha256"])
    routed = lambda pages: pages.withColumn("route", F.when(F.col("text") == "", "ocr").otherwise("native"))
    got = documents.two_pass(one, fake_extractor(), routed).orderBy("page_number").collect()
    assert sorted((r.page_number, r.route, r.selected_text, (r.error or "")[:18]) for r in got if r.error) == [(0, "native", None, "ValueError: 1 of 2")]
    assert sorted((r.page_number, r.route, r.confidence) for r in got if not r.error) == [(1, "native", None), (2, "ocr", 0.9)]


def test_archives(spark, tmp_path):
    import zstandard

    data = io.BytesIO()
    with tarfile.open(fileobj=data, mode="w") as tar:
        for name in ("a.txt", "b.txt"):
            info = tarfile.TarInfo(name)
            info.size = 3
            tar.addfile(info, io.BytesIO(b"xyz"))
    (tmp_path / "x.tar.zst").write_bytes(zstandard.ZstdCompressor().compress(data.getvalue()))
    assert sorted((r.name, bytes(r.content)) for r in documents.archive_members(spark, str(tmp_path)).collect()) == [("a.txt", b"xyz"), ("b.txt", b"xyz")]
    with pytest.raises(Exception, match="has 3 bytes"):
        documents.archive_members(spark, str(tmp_path), 2).collect()
    index = snapshots.archive_index(spark, str(tmp_path)).collect()
    assert [(r.size, r.hash) for r in index] == [(os.path.getsize(tmp_path / "x.tar.zst"), hashlib.sha256((tmp_path / "x.tar.zst").read_bytes()).hexdigest())]


def test_event_streams(spark, tmp_path):
    log = [("2024-01-01 00:10:00", "page", "a", 1.5), ("2024-01-01 00:50:00", "page", "b", 2.5), ("2024-01-01 05:00:00", "page", "a", 1.0), ("2024-01-01 00:20:00", "page", "late", 9.0)]
    path = tmp_path / "log"
    for i, (ts, event, document, seconds) in enumerate(log):
        path.mkdir(exist_ok=True)
        (path / f"{i}.json").write_text(json.dumps({"ts": ts, "event": event, "document": document, "seconds": seconds}) + "\n")
    batch = events.read_log(spark, str(path))
    assert sorted((str(r.start), r.n) for r in events.windowed(batch, "ts", "event", "seconds", "1 hour").collect()) == [("2024-01-01 00:00:00", 3), ("2024-01-01 05:00:00", 1)]
    stream = events.windowed(events.stream_log(spark, str(path), 1), "ts", "event", "seconds", "1 hour", "30 minutes")
    out = str(tmp_path / "out")
    events.to_table(stream, out, str(tmp_path / "cp")).awaitTermination()
    assert [(str(r.start), r.n) for r in spark.read.parquet(out).collect()] in ([("2024-01-01 00:00:00", 2)], [("2024-01-01 00:00:00", 3)])
    seen = []
    events.drain(events.stream_log(spark, str(path), 2), str(tmp_path / "cp2"), lambda df, i: seen.append(df.count())).awaitTermination()
    assert sum(seen) == 4
    assert sorted((r.document, r.n) for r in events.sessions(batch, "ts", "document", "6 hours").collect()) == [("a", 2), ("b", 1), ("late", 1)]
    assert events.once_each(batch, "ts", "document").count() == 3
    events.append_log(batch, str(tmp_path / "copy"))
    assert events.read_log(spark, str(tmp_path / "copy")).count() == 4
