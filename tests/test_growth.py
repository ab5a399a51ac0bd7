"""Queries on rows that the small tables don't hold, and the work that their plans leave out."""

import difflib
import io
import random
import tarfile

import duckdb

from foliary import registry
from foliary.functions import arrow_udfs
from foliary.sources import documents, files

from test_queries import normal


def compare(spark, folder, name, **tables):
    """The query over these tables (name: (rows, schema)) against its SQL."""
    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        path = f"{folder}/{table}.parquet"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/*.parquet'")
    found = registry.queries()[name](spark, str(folder))
    columns = sorted(found.columns)
    rows = sorted(tuple(normal(v) for v in r) for r in found.select(*columns).collect())
    assert rows == sorted(tuple(normal(v) for v in r) for r in con.sql(registry.oracle_sql()[name]).select(*(f'"{c}"' for c in columns)).fetchall())
    return rows


def test_attachments_that_are_lost_and_lead_elsewhere(spark, tmp_path):
    rows = compare(spark, tmp_path, "publication_violations", documents=([(i, f"text {i}") for i in (1, 5, 13, 1751, 9414)], "doc_id long, text string"))
    assert sum("r1751" in str(r) for r in rows) == 2


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tables_are_parsed_once(spark, tmp_path):
    part = ([(i, i % 2) for i in range(9)], "p_partkey long, p_size int")
    rows = compare(spark, tmp_path, "table_score", part=part)
    assert len(rows) == 9
    found = registry.queries()["table_score"](spark, str(tmp_path))
    assert plan(found).count("RLIKE") == 2 and found.rdd.getNumPartitions() == 4


def test_new_and_removed_ids_in_one_pass(spark, tmp_path):
    rows = compare(spark, tmp_path, "new_removed_ids", orders=([(1,), (2,), (2,), (3,)], "o_orderkey long"), lineitem=([(3,), (3,), (4,), (4,)], "l_orderkey long"))
    assert len(rows) == 4
    found = registry.queries()["new_removed_ids"](spark, str(tmp_path))
    assert "Join" not in plan(found) and found.rdd.getNumPartitions() == 4


def test_texts_are_dealt_once_for_gold_texts(spark, tmp_path):
    texts = [(1, "the act, the house"), (1, "the 7 acts"), (2, ""), (3, None), (None, "the act"), (4, "house act the the")]
    rows = compare(spark, tmp_path, "gold_word_f1", documents=(texts, "doc_id long, text string"), benchmark=([(1, "the act"), (2, "the the house")], "item_id long, text string"))
    assert len(rows) == 4
    found = registry.queries()["gold_word_f1"](spark, str(tmp_path))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(doc_id") == 1


def test_archives_are_read_by_as_many_tasks_as_shuffles_have(spark, tmp_path):
    names = {}
    for k in range(6):
        with tarfile.open(tmp_path / f"{k}.tar", "w") as tar:
            for i in range(1100 if k == 0 else 2):
                info = tarfile.TarInfo(f"{k}-{i}")
                names[info.name] = content = b"x" * (i % 7)
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
    assert files.listing(spark, str(tmp_path)).rdd.getNumPartitions() == 4
    found = documents.archive_members(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 4
    assert {r.name: bytes(r.content) for r in found.collect()} == names and found.count() == len(names)


def test_numbers_of_both_layers_are_counted_in_one_pass(spark, tmp_path):
    texts = [(3, "no 1.5 and 1.5, then 15"), (3, "1.5"), (4, "2.5"), (6, ""), (9, None), (None, "3.5")]
    rows = compare(spark, tmp_path, "numeric_difference", documents=(texts, "doc_id long, text string"))
    assert len(rows) == 6
    assert "Join" not in plan(registry.queries()["numeric_difference"](spark, str(tmp_path)))


def test_sequence_ratio_is_that_of_difflib(spark, tmp_path):
    draw = random.Random(5)
    for k in range(300):
        a, b = ("".join(draw.choice("ab" if k % 3 else "abcdefgh é\U0001f600") for _ in range(draw.randrange(320 if k % 2 else 40))) for _ in range(2))
        b = a[: len(a) // 2] + b + a[len(a) // 3 :] if k % 4 == 0 else b
        for junk in (True, False) if k % 10 == 0 else (True,):
            assert arrow_udfs.sequence_ratio(a, b, junk) == difflib.SequenceMatcher(None, a, b, junk).ratio()
    spark.createDataFrame([(i, k, f"turn {k}") for i in range(3) for k in range(5)], "conv_id long, turn int, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    found = registry.queries()["sequence_similarity"](spark, str(tmp_path))
    assert found.count() == 12 and found.rdd.getNumPartitions() == 4
