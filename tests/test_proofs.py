"""Layers by position, snapshots with proof, and the seven faults of a publication."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from foliary.operators import proofs


def _layers(spark, n, read, partitions=5):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    left = spark.createDataFrame([(f"{i // 7:03d}", i % 7, f"l{i}") for i in range(n)], "d string, p int, text string").repartition(3)
    right = spark.createDataFrame([(f"{i // 7:03d}", i % 7, i) for i in read], "d string, p int, n int").repartition(4)
    return left, right


@pytest.fixture(autouse=True)
def _partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("read", [0, 1, 60, 100])
def test_positions_are_zipped(spark, read):
    rows = proofs.require_merge(*_layers(spark, 100, range(read)), ["d", "p"]).orderBy("position").collect()
    assert [(r.position, r.left.text, r.right.n if r.right else None) for r in rows] == [(i, f"l{i}", i if i < read else None) for i in range(100)]


def test_every_gap_is_seen_at_edges_too(spark):
    # the layer lacks one row: wherever it is, also where a partition begins or ends
    for lost in range(0, 39, 6):
        left, right = _layers(spark, 40, [i for i in range(40) if i != lost])
        _, wrong = proofs.merge_by_position(left, right, ["d", "p"])
        assert [(r.position, r.problem) for r in wrong.orderBy("position").collect()] == [(i, "gap") for i in range(lost + 1, 40)]
    with pytest.raises(ValueError, match="gap"):
        proofs.require_merge(left, right, ["d", "p"])


def test_unknown_and_repeated_rows(spark):
    left, right = _layers(spark, 20, [*range(6), 5, 23])
    left = left.unionByName(left.where("text = 'l2'"))
    _, wrong = proofs.merge_by_position(left, right, ["d", "p"])
    assert {(r.position, r.problem) for r in wrong.collect()} == {(2, "repeated left"), (5, "repeated right"), (20, "unknown")}
    empty = left.limit(0), right.limit(0)
    assert [x.count() for x in proofs.merge_by_position(*empty, ["d", "p"])] == [0, 0]


_ROW = "record_id string, source string"


def _assemble(spark, path, base, fresh, expected, **passes):
    return proofs.assemble_snapshot(spark.createDataFrame(base, _ROW), spark.createDataFrame(fresh, _ROW), F.col("source") == "e", path, expected, **passes)


def test_a_snapshot_counts_only_if_its_proofs_hold(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    base, fresh = [("a", "m"), ("b", "e"), ("c", "e"), ("n", None)], [("c", "e"), ("d", "e"), ("x", "e")]
    good = {"base": 4, "base_refreshed": 2, "fresh": 3}
    for bad in ({"base": 5}, {"base_refreshed": 1}, {"fresh": 2}):
        with pytest.raises(ValueError, match="no snapshot"):
            _assemble(spark, path, base, fresh, good | bad)
    for rows in ([*fresh, ("c", "e")], [*fresh, ("a", "e")], [*fresh, (None, "e")]):
        with pytest.raises(ValueError, match="1 ids repeat"):
            _assemble(spark, path, base, rows, good | {"fresh": 4})
    one, other = (spark.createDataFrame(x, "page int, hash string") for x in ([(1, "a"), (2, "b")], [(1, "a"), (2, "c"), (3, "d")]))
    with pytest.raises(ValueError, match="two passes"):
        _assemble(spark, path, base, fresh, good, first_pass=one, second_pass=other)
    assert not os.path.exists(f"{path}.json")
    said = _assemble(spark, path, base, fresh, good, first_pass=one, second_pass=one)
    assert {k: said[k] for k in ("records", "new", "removed")} == {"records": 5, "new": 2, "removed": 1}
    assert sorted(map(tuple, proofs.read_snapshot(spark, path, _ROW).collect()), key=str) == sorted([("a", "m"), ("n", None), *fresh], key=str)
    with pytest.raises(FileExistsError):
        _assemble(spark, path, base, fresh, good)


def _publication(spark):
    texts = {f"text {i}".encode(): [f"r{i}", f"s{i}"] for i in range(4)}
    sha = {t: hashlib.sha256(t).hexdigest() for t in texts}
    files = [("pages.parquet", 10, "a"), ("metadata.json", 2, "b")]
    scope = {"house": "h", "parliament": "1", "session": "2"}
    return {
        "scope": scope, "marker": scope | {"complete": True, "tranche": "data/h/parliament-1/session-2/t"}, "sums": list(files), "files": list(files), "metadata": {"document_count": 4, "page_count": 8, "attachment_count": 8},
        "documents": [(sha[t], len(t), r) for t, r in texts.items()], "pages": [(h, p) for h in sha.values() for p in (1, 2)], "members": [(f"{h}.pdf", len(t), h) for t, h in sha.items()], "attachments": [(x, sha[t]) for t, r in texts.items() for x in r],
    }


_SCHEMAS = {"sums": "path string, size long, hash string", "files": "path string, size long, hash string", "documents": "document_sha256 string, size_bytes long, record_ids array<string>", "pages": "document_sha256 string, page_number int", "members": "name string, size long, hash string", "attachments": "record_id string, document_sha256 string"}


def _violations(spark, p):
    frames = {k: spark.createDataFrame(p[k], s) for k, s in _SCHEMAS.items()}
    return {(r.check, r.what, r.problem) for r in proofs.publication_violations(spark, p["scope"], p["marker"], frames["sums"], frames["files"], p["metadata"], frames["documents"], frames["pages"], frames["members"], frames["attachments"]).collect()}


def test_a_whole_publication_has_no_row(spark):
    assert _violations(spark, _publication(spark)) == set()


def test_each_planted_fault_is_listed(spark):
    p = _publication(spark)
    h = [d[0] for d in p["documents"]]
    p["marker"]["session"] = "3"  # 1: another scope's marker
    p["files"][1] = ("metadata.json", 2, "c")  # 2: a file that has changed
    p["pages"][1] = (h[0], 3)  # 3: a page is missing
    p["pages"] += [(h[1], 1), ("zz", 0)]  # 4: a page that repeats, 5: one that is malformed and nobody's
    p["members"][2] = (f"{h[2]}.pdf", 6, "0" * 64)  # 6: a member with other bytes
    p["attachments"][0] = ("r0", h[3])  # 7: an attachment that leads elsewhere
    assert _violations(spark, p) == {
        ("marker", "session", "not this scope's"), ("checksums", "metadata.json", "hash"), ("counts", "page_count", "10 where 8 are published"), ("pages", h[0], "pages missing"), ("pages", f"{h[1]}/1", "repeated"), ("pages", "zz/0", "malformed"),
        ("pages", "zz", "not a published document"), ("members", f"{h[2]}.pdf", "other bytes"), ("attachments", "r0", "record without attachment"), ("attachments", "r0", "document doesn't list the record"),
    }
    q = _publication(spark)
    q["marker"] |= {"complete": 1, "tranche": "data/h/parliament-1/session-3/"}
    q["members"] = [*q["members"][1:], ("x.pdf", 1, "x")]
    q["sums"] += [("lost", 1, "x")]
    q["metadata"] = {}
    assert {(c, w) for c, w, _ in _violations(spark, q)} == {("marker", "complete"), ("marker", "tranche"), ("checksums", "lost"), ("counts", "document_count"), ("counts", "page_count"), ("counts", "attachment_count"), ("members", h[0]), ("members", "x.pdf")}
