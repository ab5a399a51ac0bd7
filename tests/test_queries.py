"""Every query with an SQL twin against DuckDB; the rest must run. The package must work without its llm part."""

import decimal
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from foliary import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(v):
    if isinstance(v, float | decimal.Decimal):
        return f"{float(v):.9g}"
    return repr(v)


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, small, con, name):
    found = registry.queries()[name](spark, small)
    columns = sorted(found.columns)
    rows = sorted(tuple(normal(v) for v in r) for r in found.select(*columns).collect())
    sql = registry.oracle_sql().get(name)
    if sql:
        twin = con.sql(sql)
        assert sorted(twin.columns) == columns
        places = [twin.columns.index(c) for c in columns]
        assert rows == sorted(tuple(normal(r[i]) for i in places) for r in twin.fetchall())
    else:
        assert rows


def test_plans_prune_and_push(spark, small):
    plan = registry.queries()["scope_status"](spark, small)._jdf.queryExecution().toString()
    assert "l_comment" not in plan and "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)" in plan
    assert "CartesianProduct" not in plan and "Python" not in plan


def test_entry_without_the_llm_part(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "foliary"), tmp_path / "foliary", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'scope_status' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q); print(e.__file__)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0 and str(tmp_path) in done.stdout, done.stderr


def test_visible_markdown_reads_whole_texts(spark, small):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    expected = {i: hashlib.sha256(f"Report {i} {t} [open](x(1".encode()).hexdigest() for i, t in texts.items() if "](" not in t}
    got = {r.doc_id: r.digest for r in registry.queries()["visible_markdown"](spark, small).collect()}
    assert len(expected) > 100 and expected.items() <= got.items() and got.keys() == texts.keys()
