"""Primary files chosen anew, origin counts and roots of layers, renderers under a deadline, stores that older versions wrote."""

import sys
import time

import pytest
from pyspark.sql import functions as F

from foliary.operators import attachments, layers
from foliary.operators.store import Conflict, Store
from foliary.sources import documents

LEDGER = "record_id string, bitstream_id string, position int, name string, document_sha256 string"


def test_reselection_follows_labels_only(spark, tmp_path):
    files = [
        ("e_1", "a", 0, "q_hindi.pdf", "h1"), ("e_1", "b", 1, "q_english.pdf", "n1"),
        ("e_2", "a", 0, "q.pdf", "u2"), ("e_2", "b", 1, "r.pdf", "v2"),
        ("e_3", "a", 0, "q_hin.pdf", "h3"), ("e_3", "b", 1, "q.pdf", "u3"),
        ("e_4", "a", 0, "q_en.pdf", "n4"), ("e_6", "a", 0, None, "u6"), ("e_7", "a", 0, "x_en.pdf", "n7"), ("e_8", "a", 0, "x.pdf", None),
    ]
    chosen = [("e_1", "h1"), ("e_2", "v2"), ("e_3", "h3"), ("e_4", "n4"), ("e_5", "x5"), ("e_6", "u6"), ("e_7", "gone"), ("e_8", "n8"), ("e_1", "h1"), ("e_9", None)]
    records = spark.createDataFrame(chosen, "record_id string, document_sha256 string")
    ledger = spark.createDataFrame(files, LEDGER)
    got = {r.record_id: (r.candidate, r.outcome) for r in attachments.reselection(records, ledger).collect()}
    assert got == {
        "e_1": ("n1", "changed"), "e_2": ("u2", "ambiguous"), "e_3": ("u3", "changed"), "e_4": ("n4", "kept"), "e_5": (None, "no ledger"),
        "e_6": ("u6", "kept"), "e_7": ("n7", "absent"), "e_8": (None, "no ledger"), "e_9": (None, "no ledger"),
    }
    assert attachments.reselection(records.limit(0), ledger).count() == 0

    store = Store(spark, str(tmp_path / "s"))
    own = records.where("record_id IN ('e_1', 'e_2', 'e_3', 'e_5')").distinct()
    store.append("census_records", own.select("*", F.lit("h").alias("house"), F.lit(None).cast("string").alias("parliament_number"), F.lit("1").alias("session"), F.lit("downloaded").alias("acquisition_status"), F.lit("old").alias("last_error")))
    store.append("attachments", ledger)
    assert attachments.reselect_primary(store, "h", "", "1") == {"inspected": 3, "changed": 2, "ambiguous": 1, "missing_ledgers": 1}
    now = {r.record_id: (r.document_sha256, r.last_error) for r in store.read("census_records").collect()}
    assert now == {"e_1": ("n1", None), "e_2": ("v2", "old"), "e_3": ("u3", None), "e_5": ("x5", "old")}
    assert attachments.reselect_primary(store, "h", "", "1")["changed"] == 0 and store.version("outcomes") == 1
    with pytest.raises(Conflict):
        store.append_to("outcomes", store.read("outcomes"), 0)
    store.append("attachments", spark.createDataFrame([("e_5", "a", 0, "y.pdf", "other")], LEDGER))
    with pytest.raises(ValueError, match="aren't among"):
        attachments.reselect_primary(store, "h", "", "1")


def test_layers_hold_origin_counts(spark, tmp_path):
    inventory = spark.createDataFrame([(i, f"d:{i}") for i in range(7)], "position long, key string")
    rows = inventory.withColumn("origin", F.when(F.col("position") % 3 == 0, "selected").when(F.col("position") == 4, F.lit(None)).otherwise("sidecar"))
    layer = layers.Layer(spark, str(tmp_path / "layer"), "ocr", "origin string", size=4, origin="origin")
    assert layer.add(rows, 7) == 2 and layer.read(inventory).count() == 7
    assert [r.origins for r in layer.manifest().orderBy("shard").collect()] == ["selected:2,sidecar:2", "selected:1,sidecar:1"]
    for origins, wrong in ((None, False), ("selected:1,sidecar:2", True)):
        manifest = layer.manifest().withColumn("origins", F.lit(origins).cast("string"))
        manifest = spark.createDataFrame(manifest.collect(), manifest.schema)
        manifest.write.mode("overwrite").parquet(str(tmp_path / "layer" / "manifest"))
        if wrong:
            with pytest.raises(ValueError, match="origins"):
                layer.read(inventory)
        else:
            assert layer.read(inventory).count() == 7
    names = [f"layers/k/{r}/part-{i:03d}.{e}" for r in ("a", "b") for i in range(3) for e in ("json", "jsonl.gz")]
    files = spark.createDataFrame([(n,) for n in names], "path string")
    assert layers.layer_root(files, "layers/k/a/") == "layers/k/a"
    for prefix in ("layers/k/", "layers/z/"):
        with pytest.raises(ValueError, match="one layer"):
            layers.layer_root(files, prefix)


def test_renderer_has_a_deadline_and_makes_one_image():
    tool = lambda code: lambda path, out: [sys.executable, "-c", code, path, out]
    copy = "import sys, shutil; [shutil.copy(sys.argv[1], f'{sys.argv[2]}/{i}.png') for i in range(%d)]"
    assert documents.rendered(b"page", ".pdf", tool(copy % 1)) == b"page"
    for code, seconds, said in ((copy % 2, 60, "2 images"), ("pass", 60, "0 images"), ("import sys; sys.exit('no such page')", 60, "no such page")):
        with pytest.raises(RuntimeError, match=said):
            documents.rendered(b"page", ".pdf", tool(code), seconds)
    begun = time.monotonic()
    with pytest.raises(RuntimeError, match="more than 0.5 s"):
        documents.rendered(b"page", ".pdf", tool("import time; time.sleep(60)"), 0.5)
    assert time.monotonic() - begun < 30


def test_store_reads_what_an_older_version_wrote(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    old = spark.createDataFrame([(1, 7, 2, "text")], "id long, run_id long, page_number int, text string")
    old.write.parquet(str(tmp_path / "s" / "adjudications" / "data-old"))
    store._claim("adjudications", 0, ["data-old"])
    store.append("adjudications", old.withColumns({"id": F.lit(2).cast("long"), "visually_blank": F.lit(True)}))
    assert sorted((r.id, r.text, r.visually_blank, r.reported_cost) for r in store.read("adjudications").collect()) == [(1, "text", None, None), (2, "text", True, None)]
