"""Source divergence, fill-in-middle and learned partitions against SQL, a scan and brute force; odd rows."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from foliary.llm import fill_middle, learned_partitions, queries, term_divergence


def _twin(name: str, table: str, frame):
    con = duckdb.connect()
    con.register(table, frame)
    return con.sql(queries.oracle_sql()[name]).df()


def _rows(df, columns):
    return sorted(map(str, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))


_DOCS = [
    (1, "alpha Beta beta gamma", "en", "a", 1), (2, "alpha beta", "en", "b", 2), (3, "Alpha alpha BETA delta", "en", "a", 3), (3, "Alpha alpha BETA delta", "en", "a", 3), (4, "only\x00once éclair", "en", "c", 4),
    (5, None, "en", "d", 5), (6, "", None, None, 6), (None, "x y z", None, "q", 7), (8, "x x1x-x_y", None, "r", 8), (9, "x z éé Éé", None, "", 9), (10, "漢字 漢字🙂", "ja", "s", 10), (11, "漢字 beta", "ja", None, 11), (12, "漢字" * 9000, "ja", "t", 12),
]


@pytest.mark.parametrize("times", [1, 3])
def test_divergence_equals_sql_over_all_terms_and_sources(spark, times):
    docs = spark.createDataFrame(_DOCS * times, "doc_id long, text string, lang string, source string, n_chars long")
    extra = docs.withColumn("ix", F.lit("ix")).withColumn("term", F.lit(1)).withColumn("count", F.lit(0))
    got = term_divergence.audit(extra).toPandas()
    expected = _twin("op11_term_divergence", "documents", docs.toPandas())
    columns = ["lang", "source", "part", "item", "value", "rank"]
    assert _rows(got, columns) == _rows(expected, columns)
    assert len(got[got.part == "pair"]) == 12 + 6 + 6


def test_divergence_of_random_counts_and_of_a_hot_source(spark):
    rng = random.Random(3)
    names = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows = [(i, " ".join(names[min(299, int(rng.paretovariate(0.6)))] for _ in range(rng.randrange(60))), "en", "hot" if rng.random() < 0.5 else f"s{rng.randrange(9)}", 0) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got, expected = term_divergence.audit(docs).toPandas(), _twin("op11_term_divergence", "documents", docs.toPandas())
    columns = ["lang", "source", "part", "item", "value", "rank"]
    assert _rows(got, columns) == _rows(expected, columns)
    assert got[got.part == "term"].groupby("source").size().max() <= 200


def test_divergence_shares_are_exact_beyond_doubles(spark):
    sizes = [(0, 1), (5, 7), (10**15 - 1, 10**15), (123456789012345, 987654321098765), (0, 9 * 10**15), (3 * 10**15, 9 * 10**15)]
    got = spark.createDataFrame(sizes, "c long, d long").select(F.expr(term_divergence._share("c", "d"))).collect()
    assert [x[0] for x in got] == [1 + 10**9 * (c + 1) // d for c, d in sizes]


def test_divergence_of_an_empty_table(spark):
    assert term_divergence.audit(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0


def _middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, hexed = len(units), hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) else "spm" if h[3] % 100 < 50 else "psm"
    output = {"plain": text, "psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[form]
    chars = (None, None) if form == "plain" else (len(prefix), len(middle))
    return (doc_id, n, form, *chars, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("chunk", [4, 7, 1 << 14])
def test_middles_equal_a_scan_whatever_the_chunks(spark, chunk):
    rng = random.Random(chunk)
    rows = [(i, "".join(rng.choice("ab\n\n<é漢🙂P>SM \r\x00") for _ in range(rng.choice([0, 1, 3, 4, 5, 7, 8, 14, 16, 40, 200])))) for i in range(1500)]
    rows += [(None, "a\nb"), (5, None), (6, "x<P>"), (7, "\n"), (8, "\n" * 28), (9, "abcdefgh"), (9, "abcdefg\n"), (9, "abcdefg\n"), (10, "a<\nP>\n<S"), (11, ("line é\n" * 9 + "\n") * 50), (12, "x" * 5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("n")).withColumn("form", F.lit(1)).withColumn("output", F.lit(2))
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    got = fill_middle.digests(docs, chunk_bytes=chunk).select(columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted((_middle(*r) for r in rows), key=str)


def test_middles_rates_forms_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, f"a{i}\nb\nc") for i in range(300)], "doc_id long, text string")
    plain = fill_middle.transform(docs, rate=40, spm=100)
    forms = {r["form"]: r["count"] for r in plain.groupBy("form").count().collect()}
    assert 140 < forms["plain"] < 220 and "psm" not in forms
    assert plain.where(fill_middle.restored(F.col("output"), F.col("form")) != F.concat(F.lit("a"), F.col("doc_id").cast("string"), F.lit("\nb\nc"))).count() == 0
    assert fill_middle.digests(docs.limit(0)).count() == 0


def _truth(ids, x, is_query, k):
    out = {}
    for i in np.flatnonzero(is_query(ids)):
        score = [sum(float(a) * float(b) for a, b in zip(x[i], y, strict=True)) for y in x]
        out[int(ids[i])] = sorted(((-s, int(v)) for s, v in zip(score, ids, strict=True) if v != ids[i]))[:k]
    return out


def _found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_neighbours_reach_their_recall_on_clusters_with_few_parts_probed(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 4000)] + 0.25 * rng.normal(size=(4000, 24))
    ids = rng.permutation(4000)
    models, fit = [], learned_partitions.fit
    monkeypatch.setattr(learned_partitions, "fit", lambda *a, **b: models.append(fit(*a, **b)) or models[-1])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = _found(learned_partitions.search(df, F.col("vec_id") % 20 == 0, k=20, fit_rows=2000, tune_rows=500))
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    shares = [len({v for _, v in got[int(ids[i])]} & set(ids[np.argsort(-s[i])[:20]].tolist())) / 20 for i in np.flatnonzero(ids % 20 == 0)]
    assert len(shares) == 200 and np.mean(shares) >= 0.9
    assert models[0].parts == 16 and models[0].probes <= 5
    part = models[0].probabilities(x).argmax(1)
    assert np.bincount(part, minlength=16).max() < 4 * 4000 / 16


def test_graph_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(8, 16))[rng.integers(0, 8, 1600)] + 0.2 * rng.normal(size=(1600, 16))
    graph = learned_partitions.nearest(x, x, 10, np.arange(1600))
    part = learned_partitions.partition(x, graph, 8)
    assert np.bincount(part, minlength=8).max() <= 1.05 * 200 + 1
    assert (part[graph] == part[:, None]).mean() > 0.6


def test_neighbours_are_exact_where_all_parts_are_probed_with_odd_rows_and_ties(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-3, 4, size=(260, 5)).astype(float)
    x[40:160] = x[40]  # a group of copies, ties all along
    rows = [(i * 5, v.tolist()) for i, v in enumerate(x)] + [(35, x[7].tolist())]
    odd = [(1, None), (2, []), (3, [0.0] * 5), (4, [1.0, None, 0.0, 0.0, 0.0]), (6, [float("nan")] * 5), (7, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 5), (2000, [1.0, 1.0]), (2020, [2.0, 1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("part", F.lit("p")).withColumn("length", F.lit(1))
    got = _found(learned_partitions.search(df, F.col("vec_id") % 20 == 0, k=20, recall=1.0, block_rows=50, block_queries=7))
    kept = {i: v for i, v in rows if any(v)}
    ids = np.array(list(kept))
    expected = _truth(ids, list(kept.values()), lambda i: i % 20 == 0, 20)
    expected |= {2000: [(-3.0, 2020)], 2020: [(-3.0, 2000)]}
    short = {q: r for q, r in got.items() if q in (2000, 2020)}
    assert short == {q: expected[q] for q in (2000, 2020)}
    at_least = [len(set(got[q]) & set(expected[q])) / len(expected[q]) for q in expected]
    assert got.keys() == expected.keys() and np.mean(at_least) >= 0.98
    assert all(r == sorted(r) for r in got.values())


def test_few_vectors_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    search = lambda rows: _found(learned_partitions.search(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0))
    assert search([]) == {} and search([(20, [1.0, 2.0])]) == {}
    assert search([(20, [1.0, 2.0]), (21, [1.0, 0.5]), (22, [3.0, 0.0]), (20, [1.0, 2.0])]) == {20: [(-3.0, 22), (-2.0, 21)]}
