"""The incremental archive: three generations byte for byte, what it refuses, and manifests of older versions."""

import glob
import json
import os

import pytest

from foliary.operators import archive


def _put(folder, name, data: bytes):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _tree(folder) -> dict:
    return {os.path.relpath(p, folder): open(p, "rb").read() for p in glob.glob(f"{folder}/**", recursive=True) if os.path.isfile(p)}


@pytest.fixture
def three(spark, tmp_path):
    raw, kept = str(tmp_path / "raw"), archive.RawArchive(spark, str(tmp_path / "kept"))
    made = []
    for generation in range(3):
        for i in range(4):
            _put(raw, f"g{generation}/d{i}/file {i}.pdf", bytes([generation, i]) * (i * 70_000 + (i > 0)))
        made.append(kept.save(archive.folder(spark, raw), pack_bytes=100_000))
    return raw, kept, made


def test_three_generations_come_back_byte_for_byte(spark, tmp_path, three):
    raw, kept, made = three
    assert [m["files"] for m in made] == [4, 4, 4] and [m["total_files"] for m in made] == [4, 8, 12]
    assert kept.violations().count() == 0
    assert kept.index().groupBy("generation").count().count() == 3
    again = kept.save(archive.folder(spark, raw))
    assert again["files"] == 0 and again["inventory"] == made[-1]["inventory"]
    target = str(tmp_path / "back")
    assert kept.restore(target) == {"restored": True, "generations": 4, "files": 12, "bytes": sum(map(len, _tree(raw).values())), "inventory": made[-1]["inventory"]}
    assert _tree(target) == _tree(raw)
    # packs are named by their content: only what is new is written
    assert kept.packs().count() == len(os.listdir(f"{kept.root}/packs"))


def test_changed_and_lost_originals_are_refused_before_anything_is_written(spark, three):
    raw, kept, _ = three
    before = _tree(kept.root)
    _put(raw, "g0/d1/file 1.pdf", b"other")
    with pytest.raises(ValueError, match="changed or disappeared"):
        kept.save(archive.folder(spark, raw))
    os.unlink(f"{raw}/g0/d1/file 1.pdf")
    with pytest.raises(ValueError, match="gone"):
        kept.save(archive.folder(spark, raw))
    assert _tree(kept.root) == before


@pytest.mark.parametrize("how", ["changed", "missing", "swapped"])
def test_a_pack_that_is_not_what_it_was_stops_a_restore(spark, tmp_path, three, how):
    _, kept, _ = three
    packs = sorted(glob.glob(f"{kept.root}/packs/*.zst"))
    if how == "changed":
        data = bytearray(open(packs[0], "rb").read())
        data[len(data) // 2] ^= 1
        open(packs[0], "wb").write(bytes(data))
    elif how == "missing":
        os.unlink(packs[0])
    else:
        a, b = open(packs[0], "rb").read(), open(packs[1], "rb").read()
        open(packs[0], "wb").write(b)
        open(packs[1], "wb").write(a)
    with pytest.raises(ValueError, match="packs that are missing or have changed"):
        kept.restore(str(tmp_path / "back"))
    assert not os.path.exists(tmp_path / "back")


def _rewritten(at: str, content) -> None:
    """A manifest with other content; Hadoop's checksum of the old one goes."""
    with open(at, "w") as f:
        json.dump(content, f)
    side = os.path.join(os.path.dirname(at), f".{os.path.basename(at)}.crc")
    if os.path.exists(side):
        os.unlink(side)


def _as_old(kept, version: int) -> None:
    """The first generation as an older version of the manifest describes it."""
    at = f"{kept.root}/generations/1.json"
    own = kept.index().where("generation = 1")
    packs = [{"path": r.pack, "size": r.pack_size, "hash": r.pack.split("/")[1][:64]} for r in own.select("pack", "pack_size").distinct().collect()]
    found = {"version": version, "packs": packs} | ({"inventory": archive.inventory(own)["inventory"]} if version == 2 else {})
    _rewritten(at, found)


@pytest.mark.parametrize("version", [1, 2])
def test_older_manifests_are_read_and_continued(spark, tmp_path, version):
    raw, kept = str(tmp_path / "raw"), archive.RawArchive(spark, str(tmp_path / "kept"))
    _put(raw, "a.pdf", b"a" * 1000)
    _put(raw, "b/c.pdf", b"c")
    kept.save(archive.folder(spark, raw), pack_bytes=10)
    _as_old(kept, version)
    _put(raw, "new.pdf", b"")
    assert kept.save(archive.folder(spark, raw))["files"] == 1
    assert kept.restore(str(tmp_path / "back"))["files"] == 3 and _tree(tmp_path / "back") == _tree(raw)
    _put(raw, "a.pdf", b"b" * 1000)
    with pytest.raises(ValueError, match="changed"):
        kept.save(archive.folder(spark, raw))
    if version == 2:
        at = f"{kept.root}/generations/1.json"
        said = json.load(open(at))
        _rewritten(at, said | {"inventory": "0" * 64})
        with pytest.raises(ValueError, match="inventory"):
            kept.restore(str(tmp_path / "back2"))


def test_chains_claims_and_empty_archives(spark, tmp_path):
    kept = archive.RawArchive(spark, str(tmp_path / "kept"))
    assert kept.restore(str(tmp_path / "back")) == {"restored": False, "reason": "nothing is archived"}
    rows = spark.createDataFrame([("x", 1, "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881", b"x")], "path string, size long, hash string, content binary")
    assert kept.save(rows.limit(0))["files"] == 0
    assert kept.save(rows)["total_files"] == 1
    with pytest.raises(RuntimeError, match="another save"):
        kept._claim(2, {})
    with pytest.raises(Exception, match="has changed while it was archived"):
        kept.save(rows.unionByName(spark.createDataFrame([("y", 1, "0" * 64, b"y")], rows.schema)))
    with pytest.raises(ValueError, match="repeat"):
        kept.save(rows.union(rows))
    os.unlink(f"{kept.root}/generations/1.json")
    with pytest.raises(ValueError, match="chain"):
        kept.manifests()
    _rewritten(f"{kept.root}/generations/1.json", {"version": 9})
    with pytest.raises(ValueError, match="unknown"):
        kept.manifests()
