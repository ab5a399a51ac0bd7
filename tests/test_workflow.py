"""The store and its commands from empty tables to a verified publication."""

import hashlib
import json
import os
import shutil
import sys
import types

import pytest
from pyspark.sql import functions as F

from foliary import cli
from foliary.functions import arrow_udfs
from foliary.operators import acquire, layers, reports, workflow
from foliary.operators.store import Conflict, Store


def extractor():
    class Lines:
        def page_count(self, content):
            return len(content.split(b"\n")) - 1

        def pages(self, content, numbers, ocr):
            for i, line in enumerate(content.decode().split("\n")[1:], 1):
                text = f"read by ocr, page {i}" if ocr else line
                yield {"page_number": i, "text": text, "markdown": text, "mean_confidence": 0.5 if ocr else None, "reasons": [], "full_page_image": False}

    return Lines()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    files = tmp_path_factory.mktemp("files")
    (files / "a.pdf").write_text("%PDF-1\nA long line of native text, longer than forty characters.\n")
    (files / "b.pdf").write_text("%PDF-1\nAnother long line of native text, with 1,234 and more words in it.")
    (files / "same.pdf").write_text((files / "b.pdf").read_text())
    sys.modules["own_extractor"] = types.SimpleNamespace(lines=extractor())
    run = lambda *a: cli.main(["--store", str(root / "s"), *a], spark)
    assert "pages" in run("init")["tables"] and run("init")
    assert run("ingest", str(files)) == {"documents": 2} and run("ingest", str(files)) == {"documents": 2}
    assert run("process", "--extractor", "own_extractor:lines") == {"processed": 2}
    assert run("process", "--extractor", "own_extractor:lines") == {"processed": 0}
    s = Store(spark, str(root / "s"))
    shas = {r.original_name: r.document_sha256 for r in s.read("sources").collect()}
    census = root / "census.jsonl"
    census.write_text("".join(json.dumps({"record_id": f"r{i}", "source_type": "questions_answers", "house": "h", "session": "1", "title": f"Title {i}", "document_number": str(i), "document_date": "2026-01-02", "source_url": "http://x/a.htm"}) + "\n" for i in range(3)))
    assert run("import-census", str(census)) == {"records": 3}
    records = s.read("census_records")
    sha = F.when(F.col("record_id") == "r0", shas["a.pdf"]).when(F.col("record_id") == "r1", shas["b.pdf"])
    state = F.when(F.col("record_id") == "r2", "failed").otherwise("downloaded")
    s.replace("census_records", records.withColumn("document_sha256", sha).withColumn("acquisition_status", state).withColumn("last_error", F.when(F.col("record_id") == "r2", "Not a PDF: html")))
    assert run("import-census", str(census)) == {"records": 3}
    s.append("census_scopes", spark.createDataFrame([(1, "h", "", "1", "running"), (2, "h", "", "1", "complete")], "run_id long, house string, parliament_number string, session string, status string"))
    return s, run, shas, root


def test_sources_and_states(store):
    s, run, shas, _ = store
    assert len(shas) == 3 and shas["b.pdf"] == shas["same.pdf"]
    assert {r.record_id: r.acquisition_status for r in s.read("census_records").collect()} == {"r0": "downloaded", "r1": "downloaded", "r2": "failed"}
    got = run("status")
    assert (got["documents"], got["sources"], got["runs_complete"], got["pages"], got["ocr_pages"], got["review_pages"]) == (2, 3, 2, 3, 1, 1)
    assert run("census-status")["records"] == 3 and run("estimate-storage")["samples"] == 2


def test_scope_and_adjudications(spark, store):
    s, run, shas, root = store
    first = run("scope-status", "--house", "h", "--session", "1")
    assert first["census_status"] == "complete" and (first["records"], first["unsupported_html"], first["pages"], first["adjudicated_pages"]) == (3, 1, 3, 0) and not first["publication_ready"]
    pages = workflow.current_pages(s).select("run_id", "page_number").orderBy("run_id", "page_number").collect()
    rows = []
    for i, p in enumerate(pages):
        rows.append((10 + i, p.run_id, p.page_number, "openrouter", f"model {i}", 5))
        rows.append((90 + i, p.run_id, p.page_number, "nvidia", f"second {i}", 7))
    s.append("adjudications", spark.createDataFrame(rows, "id long, run_id long, page_number int, provider string, text string, total_tokens long"))
    done = run("scope-status", "--house", "h", "--session", "1")
    assert done["publication_ready"] and done["second_adjudications"] == 3 and done["adjudicated_pages"] == 3
    assert not workflow.verdict(spark, done)["session_complete"] and workflow.verdict(spark, done, "tranche")["session_complete"]
    newest = {r.adjudicated_markdown for r in workflow.export_pages(s, with_adjudications=True).collect()}
    assert newest == {"second 0", "second 1", "second 2"}
    assert workflow.export_pages(s, accepted_only=True).count() == 2 and workflow.export_pages(s, True, True).count() == 3
    preferred, wrong = workflow.canonical_pages(s, "model")
    assert {r.canonical_markdown for r in preferred.collect()} == {"model 0", "model 1", "model 2"} and wrong.count() == 0
    run("export-jsonl", str(root / "pages"), "--with-adjudications")
    assert spark.read.json(str(root / "pages")).count() == 3


def test_publication(spark, store):
    s, run, _, root = store
    path = str(root / "bundle")
    assert run("prepare-publication", path, "--house", "h", "--session", "1")["documents"] == 2
    assert run("verify-publication", path) == {"problems": []}
    d = {r.slug: r for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    assert any(x.startswith("2026-01-02_Q0_title-0__") for x in d)
    with open(f"{path}/extra.txt", "w") as f:
        f.write("x")
    assert [p["problem"] for p in run("verify-publication", path)["problems"]] == ["unexpected"]


def test_a_changed_configuration_is_pending_again(spark, store):
    s, run, _, root = store
    assert workflow.pending(s, "{}").count() == 0 and workflow.pending(s, '{"dpi": 300}').count() == 2


def test_two_writers(spark, tmp_path):
    schema = "id long, source string, status string"
    a, b = Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "s"))
    one = lambda i: spark.createDataFrame([(i, "s", "complete")], schema)
    a.append("census_runs", one(1))
    base = a.version("census_runs")
    b.append("census_runs", one(2))  # follows the version that a has read
    with pytest.raises(Conflict):
        a.replace("census_runs", one(9), base)
    read = lambda: sorted(r.id for r in a.read("census_runs").collect())
    assert read() == [1, 2]
    folders = lambda: len(a._state("census_runs")[1])
    a.append("census_runs", one(3))
    assert read() == [1, 2, 3] and folders() == 3
    a.compact("census_runs")
    assert read() == [1, 2, 3] and folders() == 1
    # a writer that has claimed a version and was lost: others wait for it, then pass it over
    marker = tmp_path / "s" / "census_runs" / "current" / "5"
    marker.touch()
    with pytest.raises(Conflict):
        a.replace("census_runs", one(4))
    assert read() == [1, 2, 3]
    os.utime(marker, (1, 1))
    a.append("census_runs", one(5))
    assert read() == [1, 2, 3, 5] and a.version("census_runs") == 6


def test_manifests_and_acquisition(spark, tmp_path):
    (tmp_path / "local.pdf").write_text("%PDF-1 local")
    good = hashlib.sha256(b"%PDF-1 local").hexdigest()

    def opener():
        calls = {}

        def open_(url, timeout):
            import http.client

            calls[url] = calls.get(url, 0) + 1
            if "cut" in url and calls[url] == 1:
                raise http.client.IncompleteRead(b"%PD")
            if "gone" in url:
                raise OSError("no route")
            return b"<html>" if url.endswith(".htm") else b"%PDF-1 " + url.encode()

        return open_

    quiet = {"opener": opener(), "attempts": 2, "pause": lambda s: None}
    s = Store(spark, str(tmp_path / "s"))
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps({"samples": [{"file": "local.pdf", "sha256": good}, {"url": "http://x/cut.pdf"}, {"file": "none.pdf", "url": "http://x/b.pdf"}]}))
    assert acquire.ingest_manifest(s, str(path), **quiet) == 3 and s.read("documents").count() == 3
    path.write_text(json.dumps({"documents": [{"file": "local.pdf", "sha256": "0" * 64}, {"file": "none.pdf"}, {"url": "http://x/a.htm"}, {"url": "http://x/c.pdf"}]}))
    with pytest.raises(ValueError, match="could not be had") as error:
        acquire.ingest_manifest(s, str(path), **quiet)
    assert all(x in str(error.value) for x in ("SHA-256 is", "none.pdf", "Not a PDF")) and s.read("documents").count() == 4
    urls = ["http://x/1.pdf", "http://x/2.pdf", "http://x/1.pdf", "http://x/a.htm", "http://x/gone.pdf", ""]
    s.replace("census_records", spark.createDataFrame([(f"r{i}", u, "discovered") for i, u in enumerate(urls)], "record_id string, source_url string, acquisition_status string"))
    assert acquire.drain(s, 2, deadline=0.0, clock=lambda: 1.0) == {"batches": 0, "tried": 0, "failed": 0, "stopped": "deadline"}
    assert acquire.drain(s, 2, least_free=1 << 62)["stopped"] == "disk"
    assert acquire.drain(s, 2, **quiet) == {"batches": 3, "tried": 5, "failed": 2, "stopped": "empty"}
    state = {r.record_id: r for r in s.read("census_records").collect()}
    assert [state[f"r{i}"].acquisition_status for i in range(6)] == ["downloaded", "downloaded", "downloaded", "failed", "failed", "discovered"]
    assert state["r0"].document_sha256 == state["r2"].document_sha256 and "Not a PDF: " in state["r3"].last_error and "no route" in state["r4"].last_error
    assert acquire.drain(s, 2, **quiet)["tried"] == 0
    again = acquire.drain(s, 2, retry_failed=True, opener=lambda url, timeout: b"%PDF-2", attempts=1)
    assert (again["tried"], again["failed"]) == (2, 0) and s.read("census_records").where("last_error IS NOT NULL").count() == 0
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.pdf").write_text("no")
    got = cli.main(["--store", str(tmp_path / "s"), "ingest", str(tmp_path / "in")], spark)
    assert [r["error"] for r in got["rejected"]] == ["not a PDF"]


def test_layers(spark, tmp_path):
    pages = spark.createDataFrame([(d, p) for d in ("a", "b", "c") for p in range(1, 6)], "document_sha256 string, page_number int")
    records = spark.createDataFrame([("a", "downloaded"), ("b", "downloaded"), ("c", "downloaded"), ("a", "downloaded")], "document_sha256 string, acquisition_status string")
    inventory = layers.inventory(pages, records)
    assert [(r.position, r.key) for r in inventory.orderBy("position").collect()][:6] == [(0, "a:1"), (1, "a:2"), (2, "a:3"), (3, "a:4"), (4, "a:5"), (5, "b:1")]
    with pytest.raises(ValueError, match="all their pages"):
        layers.inventory(pages.where("page_number <> 3 OR document_sha256 <> 'b'"), records)
    with pytest.raises(ValueError, match="not acquired"):
        layers.inventory(pages, records.withColumn("acquisition_status", F.lit("discovered")))
    layer = layers.Layer(spark, str(tmp_path / "layer"), "ocr", "text string", size=4)
    rows = inventory.withColumn("text", F.concat(F.lit("text of "), "key"))
    assert layer.add(rows.where("position < 7"), 15) == 1 and layer.next_position() == 4
    with pytest.raises(ValueError, match="follow each other"):
        layer.add(rows.where("position >= 8"), 15)
    assert layer.add(rows, 15) == 3 and layer.add(rows, 15) == 0
    got = layer.read(inventory)
    assert got.count() == 15 and got.where("text = concat('text of ', key)").count() == 15
    with pytest.raises(ValueError, match="inventory doesn't have"):
        layer.read(inventory.withColumn("key", F.when(F.col("position") == 3, "z:9").otherwise(F.col("key"))))
    manifest = layer.manifest()
    lost = spark.createDataFrame(manifest.where("shard <> 1").collect(), manifest.schema)
    assert {r.problem for r in layers.manifest_problems(lost, 4, 15).collect()} == {"gap"}
    shutil.rmtree(tmp_path / "layer" / "manifest")
    manifest = lost.unionByName(lost.where("shard = 0").withColumn("shard", F.lit(1).cast("long")).withColumn("first", F.lit(4).cast("long")).withColumn("last", F.lit(7).cast("long")))
    manifest.write.parquet(str(tmp_path / "layer" / "manifest"))
    with pytest.raises(ValueError, match="differ from their manifest"):
        layer.read(inventory)


def test_evidence_of_completion(spark):
    scopes = spark.createDataFrame([("s1", "t/1"), ("s2", "t/2"), ("s3", "t/3")], "scope string, prefix string")
    marks = [("s1", "m/1.complete.json", "session-complete", True, None), ("s2", "m/2.snapshot.json", "session-complete", True, None), ("s3", "m/3.skipped.json", "skipped", None, "no records")]
    markers = spark.createDataFrame(marks, "scope string, path string, kind string, complete boolean, reason string")
    names = [f"t/{n}/{f}" for n in (1, 2) for f in layers.TRANCHE] + [f"t/3/{f}" for f in layers.TRANCHE[1:]]
    got = layers.completion_evidence(scopes, markers, spark.createDataFrame([(n,) for n in names], "path string"))
    assert sorted(map(tuple, got.collect())) == [("s1", True, True, True), ("s2", False, True, False), ("s3", True, False, False)]
    h = "a" * 64
    sides = [((h, "r", 3), (h, "r", 3)), ((h, "r", 3), (h, "r", 4)), (("A" * 64, "r", 3), ("A" * 64, "r", 3)), ((h, "", 3), (h, "", 3)), ((None, "r", 3), (None, "r", 3))]
    names = ("inventory_sha256", "revision", "pages")
    df = spark.createDataFrame([(i, *a, *b) for i, (a, b) in enumerate(sides)], "i int, a0 string, a1 string, a2 int, b0 string, b1 string, b2 int")
    same = layers.same_inventory(*({n: F.col(f"{s}{i}") for i, n in enumerate(names)} for s in "ab"))
    assert [r.x for r in df.select("i", same.alias("x")).orderBy("i").collect()] == [True, False, False, False, False]


def test_reports(spark, tmp_path):
    pages = spark.createDataFrame([(1, 2, "ocr", "review"), (1, 1, "native", "accepted"), (1, 3, "ocr", "review"), (2, 1, "native", "accepted")], "run_id long, page_number int, route string, validation_status string")
    assert sorted(map(tuple, reports.run_manifest(pages).collect())) == [(1, 3, 1, 2, [2, 3]), (2, 1, 1, 0, [])]
    tasks = spark.createDataFrame([("m", True, None, 5), ("m", False, None, 7), ("m", None, "late", None), ("n", None, "late", None)], "model string, agrees boolean, error string, tokens long")
    found = reports.write_verification(tasks, str(tmp_path / "v"))["models"]
    assert found == [{"model": "m", "tasks": 3, "errors": 1, "agreed": 1, "tokens": 12, "share": 0.5}, {"model": "n", "tasks": 1, "errors": 1, "agreed": 0, "tokens": 0, "share": None}]
    assert json.loads((tmp_path / "v" / "report.json").read_text())["models"] == found and "| m | 3 | 1 | 1 |" in (tmp_path / "v" / "report.md").read_text()
    path = reports.write_audit({"b": 1, "a": {2, 1}}, str(tmp_path))
    assert json.loads(open(path).read()) == {"a": [1, 2], "b": 1}
    assert reports.matrix([{"s": "1"}]) == 'matrix={"include":[{"s":"1"}]}\ncount=1\n'
    documents = spark.createDataFrame([("one", "text", ["r1"]), ("two", None, [])], "slug string, text string, record_ids array<string>")
    assert reports.write_readable(documents, str(tmp_path / "docs")).count() == 2
    assert (tmp_path / "docs" / "one" / "document.md").read_text() == "text" and json.loads((tmp_path / "docs" / "one" / "metadata.json").read_text()) == {"record_ids": ["r1"], "slug": "one"}
    reports.write_card(str(tmp_path / "card"), "Title", {"pages": 3})
    assert "| pages | 3 |" in (tmp_path / "card" / "README.md").read_text()
    reports.write_csv_summary(spark.createDataFrame([("a", 1.23456)], "name string, elapsed double"), str(tmp_path / "csv"), ("elapsed",))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()] == [("a", "1.2346")]
    assert reports.plain(types.SimpleNamespace(a=(1, {2}), _b=3)) == {"a": [1, [2]]} and reports.raw_count({"files": ["a.pdf", "b.txt"]}) == reports.raw_count({"originals": {"h": 1}}) == 1
    assert reports.request_digest({"b": 1, "a": 2}) == hashlib.sha256(b'{"b":1,"a":2}').hexdigest()
    row = spark.range(1).select(reports.model_folder(F.lit("a/b c")).alias("m"), arrow_udfs.exact_round(4)(F.lit(0.12345)).alias("r"), reports.marker_kind(F.lit(None), F.lit(False), F.lit(True)).alias("k")).first()
    assert tuple(row) == ("a__b__c", round(0.12345, 4), "snapshot-complete")


def test_census_of_a_repository_and_of_questions(spark, tmp_path):
    from foliary.sources import http_json

    def source():
        class Fake(http_json.PagedJson):
            @classmethod
            def name(cls):
                return "fake_repository"

            @staticmethod
            def opener(url, timeout):
                import json
                import urllib.parse

                n = int(urllib.parse.parse_qs(urllib.parse.urlparse(url).query)["page"][0])
                hit = lambda i: {"_embedded": {"indexableObject": {"uuid": f"u{i}", "metadata": {"dc.title": [{"value": f"T{i}"}], "dc.identifier.sessionnumber": [{"value": "II"}], "dc.identifier.loksabhanumber": [{"value": "1"}]}}}}
                return json.dumps({"page": {"number": n, "size": 2, "totalElements": 5, "totalPages": 3}, "_embedded": {"searchResult": {"_embedded": {"objects": [hit(i) for i in range(2 * n, min(5, 2 * n + 2))]}}}}).encode()

        return Fake

    spark.dataSource.register(source())
    s = Store(spark, str(tmp_path / "s"))
    assert workflow.census_repository(s, "http://x", 2, source="fake_repository") == 1
    assert workflow.census_repository(s, "http://x", 2, source="fake_repository") == 2
    assert sorted((r.record_id, r.title, r.acquisition_status) for r in s.read("census_records").collect()) == [(f"elibrary_ls_question_u{i}", f"T{i}", "discovered") for i in range(5)]
    assert workflow.scope_status(s, "lok_sabha", "1", "II")["census_status"] == "complete"
    (tmp_path / "q.json").write_text(json.dumps({"qslno": "7", "files": "u", "shri": "Shri", "name": "A", "qno": 3.0, "ses_no": "5"}) + "\n" + json.dumps({"qslno": "7", "files": "u", "shri": "Shri", "name": "B"}) + "\n")
    assert workflow.census_questions(s, str(tmp_path / "q.json")) == 6
    assert s.read("census_records").where("record_id = 'rs_qsl7_en'").first().members == ["Shri A", "Shri B"]


def test_census_of_the_modern_interface(spark, tmp_path):
    from foliary.sources import http_json, payloads

    def source():
        class Fake(http_json.NumberedJson):
            @classmethod
            def name(cls):
                return "fake_modern"

            @staticmethod
            def opener(url, timeout):
                import json
                import urllib.parse

                q = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(url).query).items()}
                n, session = int(q["pageNo"]), q["sessionNumber"]
                row = lambda i: {"quesNo": f" {1 if session == '3' else i} ", "type": "Starred", "subjects": f"S{i}", "member": [" A ", ""], "date": "02.04.2026", "questionsFilePath": "" if i == 2 else f"http://x/{i}.pdf"}
                rows = [row(i) for i in range(5)][2 * n - 2 : 2 * n]
                if session == "2" and n == 2:
                    rows = []
                if session == "4":
                    rows[0].pop("quesNo")
                return json.dumps([{"totalRecordSize": 6 if session == "5" and n > 1 else 5, "listOfQuestions": rows}]).encode()

        return Fake

    spark.dataSource.register(source())
    s = Store(spark, str(tmp_path / "s"))
    got = workflow.census_modern(s, "http://x", [("18", str(i)) for i in range(1, 6)], 100, source="fake_modern")
    assert got["status"] == "failed" and sorted(got["errors"]) == ["18/2", "18/3", "18/4", "18/5"]
    for scope, message in (("18/2", "ended after 2 of 5"), ("18/3", "repeat"), ("18/4", "no number"), ("18/5", "changed from 5 to 6")):
        assert message in got["errors"][scope]
    records = {r.record_id: r for r in s.read("census_records").collect()}
    assert sorted(records) == [f"ls_l18_s1_q{i}_starred_en" for i in range(5)]
    assert records["ls_l18_s1_q2_starred_en"].source_url == "" and records["ls_l18_s1_q1_starred_en"].members == ["A"] and records["ls_l18_s1_q1_starred_en"].document_date == "2026-04-02"
    assert workflow.failed_scopes(s) == [("18", str(i)) for i in range(2, 6)]
    assert workflow.scope_status(s, "lok_sabha", "18", "1")["census_status"] == "complete" and workflow.scope_status(s, "lok_sabha", "18", "2")["census_status"] == "failed"
    rows = spark.createDataFrame([(2, 267), (0, None), (1, 268)], "o int, session int")
    assert [r.session for r in payloads.session_list(rows, "o").collect()] == ["268", "267"]


def _documents(spark, root, names):
    store = Store(spark, root)
    rows = spark.createDataFrame([(x, len(x), x.encode()) for x in names], "sha256 string, size_bytes long, content binary")
    rows.write.mode("append").parquet(f"{root}/originals")
    store.insert_or_ignore("documents", rows.select("sha256", "size_bytes"))
    return store


def test_two_calls_at_once_take_different_runs(spark, tmp_path, monkeypatch):
    store = _documents(spark, str(tmp_path / "s"), ["a", "b", "c"])
    write, others = store._write, []

    def slow(name, rows):  # another call takes its runs between this one's reading and claiming
        folder = write(name, rows)
        if name == "runs" and not others:
            others.append(workflow._claim_runs(Store(spark, store.root), "{}"))
        return folder

    monkeypatch.setattr(store, "_write", slow)
    mine = {r.run_id for r in workflow._claim_runs(store, "{}").collect()}
    assert mine == {4, 5, 6} and {r.run_id for r in others[0].collect()} == {1, 2, 3}
    assert {(r.id, r.status) for r in workflow.current_runs(store).collect()} == {(i, "running") for i in range(1, 7)}


def test_runs_have_states_and_ends(spark, tmp_path, monkeypatch):
    store = _documents(spark, str(tmp_path / "s"), ["a", "b"])
    broken = lambda error: monkeypatch.setattr(workflow, "_process", lambda *a: (_ for _ in ()).throw(error))
    with monkeypatch.context():
        broken(RuntimeError("no room"))
        with pytest.raises(RuntimeError):
            workflow.process(store, None, {})
        broken(KeyboardInterrupt())
        with pytest.raises(KeyboardInterrupt):
            workflow.process(store, None, {})
        monkeypatch.undo()
    found = {r.id: r for r in workflow.current_runs(store).collect()}
    assert {i: r.status for i, r in found.items()} == {1: "failed", 2: "failed", 3: "interrupted", 4: "interrupted"}
    assert found[1].error == "RuntimeError: no room" and found[1].started_at is not None and found[3].finished_at is not None
    assert workflow.pending(store, "{}").count() == 2


def test_what_is_written_grows_with_what_is_new(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    rows = lambda a, b: spark.createDataFrame([(f"{i:06d}", "x" * 50) for i in range(a, b)], "sha256 string, raw_path string").coalesce(1)
    size = lambda: sum(f.stat().st_size for f in (tmp_path / "s" / "documents").rglob("*.parquet"))
    sizes = []
    for i in range(0, 600, 100):
        store.insert_or_ignore("documents", rows(max(0, i - 50), i + 100))  # half of it is there
        sizes.append(size())
    steps = [b - a for a, b in zip(sizes, sizes[1:], strict=False)]
    assert store.read("documents").count() == 600 and max(steps) < 2 * min(steps)


class _Echo:
    def complete(self, model, prompt):
        return {"text": f"{model} read {prompt}", "total_tokens": 2}


echo = _Echo()


def test_commands_for_models_archives_and_the_installation(spark, tmp_path, monkeypatch):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    root = str(tmp_path / "s")
    store = Store(spark, root)
    store.append("runs", spark.createDataFrame([(1, "d", "complete")], "id long, document_sha256 string, status string"))
    store.append("pages", spark.createDataFrame([(1, i, "ocr", "review", f"page {i}") for i in range(3)], "run_id long, page_number int, route string, validation_status string, markdown string"))
    run = lambda *a: cli.main(["--store", root, *a], spark)
    command = ["adjudicate", "--client", f"{__name__}:echo", "--models", "m, n", "--limit-pages", "2"]
    assert run(*command) == {"completed": 2, "failed": 0, "stored": 0, "repeated": 0, "over_budget": 0}
    assert run(*command)["completed"] == 1 and run(*command)["completed"] == 0
    assert {r.text for r in store.read("adjudications").collect()} == {f"m read page {i}" for i in range(3)}
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.pdf").write_bytes(b"a")
    assert run("archive-save", str(tmp_path / "kept"), str(tmp_path / "raw"))["files"] == 1
    assert run("archive-restore", str(tmp_path / "kept"), str(tmp_path / "back"))["restored"] and (tmp_path / "back" / "a.pdf").read_bytes() == b"a"
    found = run("doctor")
    assert found["problems"] == [] and found["tables"]["pages"] == 1 and found["spark"] == spark.version


def test_settings_fill_what_is_missing():
    from foliary.sources import snapshots

    have = {"A": "kept"}
    snapshots.fill(have, "# c\n\nA=1\nB = 'two' \nC=\"x=y\"\nB=3\nnothing\n=5\n")
    assert have == {"A": "kept", "B": "two", "C": "x=y"}


def test_several_original_bundles_are_a_problem(spark):
    from foliary.sources import payloads

    rows = [("a", "ORIGINAL", "1", "f1", "x.pdf", None), ("a", "ORIGINAL", "2", "f2", "y.pdf", None), ("b", "ORIGINAL", "3", "f3", "x.pdf", None), ("b", "TEXT", "4", "f4", "x.txt", None)]
    frame = spark.createDataFrame(rows, "record_id string, bundle string, bundle_id string, bitstream_id string, name string, mime string")
    assert [tuple(r) for r in payloads.file_problems(frame).collect()] == [("a", "several original bundles")]
    assert payloads.file_problems(frame.drop("bundle_id")).count() == 0
    items = spark.createDataFrame([(0, '{"quesNo": "1"}'), (150, '{"quesNo": "2"}')], "position long, item string")
    got = payloads.modern_questions(items, "18", "5", "https://x.test/api", {"loksabhaNo": "18"}, 100, "https://x.test/list").orderBy("position").collect()
    assert [r.api_params["pageNo"] for r in got] == ["1", "2"] and got[0].api_url == "https://x.test/api" and got[0].official_page_url == "https://x.test/list" and got[0].api_params["loksabhaNo"] == "18"
