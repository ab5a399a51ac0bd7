"""Samples without replacement over overlapping strata, states of tasks, and transcripts whose paths repeat the root."""

from foliary.operators import audits


def test_strata_overlap_but_no_page_is_drawn_twice(spark):
    rows = [(i, "rare" if i == 77 else None if i % 5 == 0 else "ocr", i % 4 == 0, i % 9, i % 2 == 0) for i in range(400)]
    pages = spark.createDataFrame(rows, "id long, route string, local_empty boolean, separator_rows int, numeric_differs boolean")
    for count in (1, 7, 60, 400, 900):
        drawn = audits.layout_sample(pages, "id", count, 5).collect()
        assert len({r.id for r in drawn}) == len(drawn) == min(count, 400)
        assert sum(r.stratum == "random_baseline" for r in drawn) == min(400, max(1, count // 2))
        by = {r.id: r for r in pages.collect()}
        assert all({"empty_local_text": by[r.id].local_empty, "layout": by[r.id].separator_rows >= 3, "numeric": by[r.id].numeric_differs}.get(r.stratum, True) for r in drawn)
        if count == 60:
            assert 77 in {r.id for r in drawn} and sum(r.stratum == "empty_local_text" for r in drawn) == 10
            assert sorted(map(tuple, drawn)) == sorted(map(tuple, audits.layout_sample(pages.repartition(7), "id", count, 5).collect()))


def test_task_states_are_resumed(spark):
    sample = spark.createDataFrame([(1,), (2,)], "page long")
    results = spark.createDataFrame([(1, "a", 1, "error"), (1, "a", 2, "ok"), (2, "b", 1, "error"), (3, "a", 1, "ok")], "page long, model string, n int, state string")
    assert {(r.page, r.model): r.state for r in audits.task_states(sample, ["a", "b"], results).collect()} == {(1, "a"): "ok", (1, "b"): "pending", (2, "a"): "pending", (2, "b"): "error"}


def test_transcripts_of_latest_runs_alone(spark):
    frame = spark.createDataFrame
    found = audits.transcript_paths(
        frame([("d",), ("d",)], "document string"), frame([(1, "d", "complete"), (2, "d", "complete"), (3, "d", "failed"), (4, "other", "complete")], "id long, document string, status string"), frame([(r, p) for r in (1, 2, 3, 4) for p in (1, 2, 3)], "run_id long, page_number int"),
        frame([(1, 1, 1, "m", "data/artifacts/old/response.json"), (2, 2, 1, "m", "x\\data\\artifacts\\a\\data/artifacts/1.json"), (3, 2, 1, "n", "data/artifacts/n/1.json"), (4, 2, 2, "m", "/tmp/2.json"), (5, 4, 1, "m", "data/artifacts/o/1.json")], "id long, run_id long, page_number int, provider string, response_path string"),
        frame([("data/artifacts/old/adjudicated.md",)], "path string"), "m",
    )
    assert {r.path: r.state for r in found.collect()} == {"data/artifacts/a/data/artifacts/adjudicated.md": "missing", "/tmp/2.json": "outside", "data/artifacts/old/adjudicated.md": "unexpected"}
