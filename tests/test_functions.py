"""Text functions and rules on the reference cases and against Python twins."""

import random
import re
import time

import pytest
import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliary.functions import arrow_udfs, rules
from foliary.functions import text as X
from foliary.operators import multisets

NUMBER = re.compile(r"(?<![A-Za-z])\d[\d,]*(?:\.\d+)?")


def column(spark, values, f, schema="t string"):
    rows = spark.createDataFrame([(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)], f"i int, {schema}").coalesce(1)
    return [r.x for r in rows.select("i", f().alias("x")).orderBy("i").collect()]


def test_numbers(spark):
    got = column(spark, ["a12 3,4.5 x", "1,234 and 5.", "x٣٤ 9", "", "v2 (7)"], lambda: X.plain_numbers(F.col("t")))
    assert got == [["2", "34.5"], ["1234", "5"], ["٤", "9"], [], ["7"]]


def test_page_footers_do_not_count(spark):
    texts = ["Total 42 acres", "Total 42 acres\n**Page 2 of 2**", "on Page 2 of 2 we"]
    assert column(spark, texts, lambda: X.content_numbers(F.col("t"))) == [["42"], ["42"], ["2", "2"]]


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab1२٣,. \n\t|-:*_pageof \x0b　\x1c", max_size=40), min_size=20, max_size=40))
def test_functions_equal_their_python_twins(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    t = F.col("t")
    got = rows.select("i", X.plain_numbers(t).alias("n"), X.alphanumeric_ratio(t).alias("r"), X.is_blank(t).alias("b"), X.table_widths(t).alias("w"), X.separator_rows(t).alias("s"), X.slugify(t).alias("g")).orderBy("i").collect()
    for r, s in zip(got, texts, strict=True):
        assert r.n == [x.replace(",", "") for x in NUMBER.findall(s)]
        seen = [c for c in s if not c.isspace()]
        assert r.r == (sum(c.isalnum() for c in seen) / len(seen) if seen else 0.0)
        assert r.b == (not s.strip())
        stripped = [x.strip() for x in s.splitlines()]
        cells = [x[1:-1].split("|") for x in stripped if x.startswith("|") and x.endswith("|")]
        assert r.w == [len(c) for c in cells if not all(set(x.strip()) <= {"-", ":"} for x in c)]
        assert r.s == sum(x.lstrip().startswith("|") and "-" in x and set(x.strip()) <= set("|-: ") for x in s.splitlines())
        slug = re.sub("[^a-z0-9]+", "-", s.casefold()).strip("-")[:60].rstrip("-")
        assert r.g == (slug or "document")


def test_visible_markdown(spark):
    cases = ["[Report 2024](https://example.test/file(7).pdf)", "[a](b\\)c) d", "[open](x", "no [link] (here)", "[a][b](c)", None]
    got = column(spark, cases, lambda: X.without_links(F.col("t")))
    assert got == ["Report 2024", "a d", "[open](x", "no [link] (here)", "a][b", None]
    deep = ["[a](" + "(" * 6 + ")" * 6 + ") 1", "x" * 200_000 + "[b](1)", "[" * 5000 + "](2", "[c](" + "\\(" * 3000 + ")", "](" * 3000]
    assert column(spark, deep, lambda: X.without_links(F.col("t"))) == ["a 1", "x" * 200_000 + "b", deep[2], "c", deep[4]]


_LINK = regex.compile(r"\[((?:(?!\]\()[\s\S])*+)\]\((?P<target>(?:[^()]|(?<=\\)[()]|(?<!\\)\((?&target)(?<!\\)\))*+)(?<!\\)\)")


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["[", "]", "](", "(", ")", "\\", "a", "1", "\n", " "]), max_size=16).map("".join), min_size=30, max_size=60))
def test_links_equal_a_recursive_pattern(spark, texts):
    got = column(spark, texts, lambda: X.without_links(F.col("t")))
    assert got == [_LINK.sub(lambda m: m.group(1), t) for t in texts]


def _shown(text: str) -> str:
    """What a scan from left to right leaves of the links."""
    out, i = [], 0
    while i < len(text):
        at = text.find("](", i + 1) if text[i] == "[" else -1
        depth, end = 1, at + 2
        while at >= 0 and end < len(text) and depth:
            if text[end] in "()" and text[end - 1] != "\\":
                depth += 1 if text[end] == "(" else -1
            end += 1
        if at >= 0 and depth == 0:
            out.append(text[i + 1 : at])
            i = end
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def test_links_of_any_depth_equal_a_scan(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice(["[", "](", "(", ")", "\\", "]", "a", "1\n", "[x](", "é"]) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += [f"5 [a](x{'(' * d}1{')' * (d + k)}) 7 [b](c)" for d in range(51) for k in (-1, 0, 1)]
    assert column(spark, texts, lambda: X.without_links(F.col("t"))) == [_shown(t) for t in texts]
    assert column(spark, ["[a](x" + "(" * 7 + "1" + ")" * 7 + ") 5"], lambda: X.numbers(F.col("t"))) == [["5"]]


def test_links_take_time_in_proportion(spark):
    seconds = []
    for n in (4_000, 32_000):
        text = ("word " * 20 + "[lab](http://x/(1)_y) (see) ") * n
        began = time.perf_counter()
        assert column(spark, [text], lambda: F.length(X.without_links(F.col("t")))) == [110 * n]
        seconds.append(time.perf_counter() - began)
    assert seconds[1] < 20 * seconds[0] + 5


def test_numbers_of_link_targets_do_not_count(spark):
    a, b = "Total 5 [Report](https://x.test/12.pdf)", "Total 5 Report"
    pairs = [(a, b), (a, b.replace("5", "6")), (a, "Total 5 [Report](https://x.test/99.pdf)")]
    candidate = column(spark, pairs, lambda: rules.candidate_flags(F.col("t"), F.col("m")), "t string, m string")
    assert candidate == [[], ["candidate-numeric-disagreement"], []]
    page = column(spark, pairs, lambda: rules.page_flags(F.col("t"), F.col("t"), F.lit("ocr"), F.lit(0.9), F.col("m")), "t string, m string")
    assert page == [[], ["native-ocr-numeric-disagreement"], []]


def test_empty_fences_dates_romans_labels(spark):
    pairs = [("", "```text\n```"), ("", "```\nword\n```"), (" ", ""), ("x", "")]
    assert column(spark, pairs, lambda: X.local_content_empty(F.col("t"), F.col("m")), "t string, m string") == [True, False, True, False]
    assert column(spark, ["02.04.2026", "date unavailable", "2.4.26", "", None], lambda: X.parse_date(F.col("t"))) == ["2026-04-02", "", "0026-04-02", "", ""]
    assert column(spark, ["XIV", "12", "iv", "MCMXCIV", "A", "12abc"], lambda: X.roman_value(F.col("t"))) == [14, 12, 4, 1994, None, None]
    members = F.array(F.lit("Shri A"), F.lit("Shri B"))
    assert column(spark, ["XII", "Shri AXII", "Shri AZ", "9"], lambda: X.normal_session(F.col("t"), members)) == ["XII", "XII", "Shri AZ", "9"]
    none = F.array().cast("array<string>")
    assert column(spark, ["x_English.pdf", "हिंदी.pdf", "hin_eng", "a"], lambda: X.language_hint(F.col("t"), none)) == ["en", "hi", "und", "und"]


def test_slug(spark):
    f = lambda: X.document_slug(F.lit("2026-02-11"), F.lit("1948"), F.lit("r_1"), F.col("t"), F.lit(""), F.lit("questions_answers"), F.lit("3322680abcdef"))
    assert column(spark, ["Biogas Projects in Rajasthan!"], f) == ["2026-02-11_Q1948_biogas-projects-in-rajasthan__3322680a"]


LONG = "A page of native text that is long enough to be kept, with 123 and 14.2 in it."


def test_routing_cases(spark):
    rows = [(LONG, ["sparse-text"], False), ("", ["scanned"], False), (LONG, [], True), ("short", None, None), ("-- " * 40, [], False)]
    got = column(spark, rows, lambda: rules.route_reasons(F.col("t"), F.col("c"), F.col("f")), "t string, c array<string>, f boolean")
    assert got == [[], ["empty-native-text", "scanned"], ["full-page-image"], ["too-little-native-text"], ["low-alphanumeric-ratio"]]


def test_validation_cases(spark):
    f = lambda: rules.page_flags(F.col("t"), F.col("t"), F.col("r"), F.col("c"), F.col("n"))
    rows = [("value 142", "ocr", 0.9, "value 14.2"), ("value 142", "native", 0.1, "value 14.2"), ("| a | b |\n|---|---|\n| 1 | 2 |", "native", None, ""), ("| a | b |\n| 1 | 2 | 3 |", "ocr", 0.5, None), (" �", "ocr", None, "")]
    assert column(spark, rows, f, "t string, r string, c double, n string") == [["native-ocr-numeric-disagreement"], [], [], ["low-ocr-confidence", "inconsistent-table-width"], ["replacement-characters"]]
    g = lambda: rules.candidate_flags(F.col("t"), F.col("n"))
    assert column(spark, [("Total 42 acres", "Total 4.2 acres"), ("Total 42\nPage 2 of 3", "Total 42"), ("", "x"), ("1", None)], g, "t string, n string") == [["candidate-numeric-disagreement"], [], ["empty-text"], []]


def test_triads_metrics_and_choice(spark):
    a = "array<string>"
    rows = [(["1"], ["1"], ["1"]), (["1"], ["2"], ["1"]), (["1"], ["1"], ["2"]), (["1"], ["2"], ["2"]), (["1"], ["2"], ["3"]), ([], [], [])]
    assert column(spark, rows, lambda: rules.triad(F.col("l"), F.col("o"), F.col("m")), f"l {a}, o {a}, m {a}") == ["all_equal", "local_model_equal", "local_ocr_equal", "model_ocr_equal", "all_different", None]
    rows = [(100, 25, 250, True), (100, 26, 250, True), (100, 5, 240, True), (0, 0, 250, True), (10, 26, 250, False), (None, 1, 250, True)]
    assert column(spark, rows, lambda: rules.valid_metrics(F.col("p"), F.col("d"), F.col("c"), F.col("b")), "p long, d long, c int, b boolean") == [True, False, False, False, False, False]
    rows = [("local", "model", True, False, "model"), ("local", None, False, False, "model"), ("local", "model", True, True, "local"), ("local", "model", True, False, "local")]
    schema = "t string, m string, h boolean, b boolean, p string"
    assert column(spark, rows, lambda: rules.canonical(F.col("t"), F.col("m"), F.col("h"), F.col("b"), F.col("p"))[1], schema) == ["model", "local", "visual:verified-blank", "local"]
    assert column(spark, [("", None, True, False, "model"), ("", " ", True, False, "model"), ("", " ", True, True, "model")], lambda: rules.canonical_violations(F.col("m"), F.col("h"), F.col("b"), F.lit(True), F.col("p")), schema) == [["missing-transcript", "unproven-empty-model-text"], ["unproven-empty-model-text"], []]


def test_multiset_difference_and_scores(spark):
    rows = [(["1", "1", "2"], ["1", "3"]), ([], ["1"])]
    assert column(spark, rows, lambda: multisets.difference(F.col("a"), F.col("b")), "a array<string>, b array<string>") == [["1", "2"], []]
    p, r, f1 = multisets.scores(F.col("c"), F.col("f"), F.col("e"))
    got = spark.createDataFrame([(2, 4, 2), (0, 0, 0)], "c int, f int, e int").select(p.alias("p"), r.alias("r"), f1.alias("f")).collect()
    assert tuple(got[0]) == pytest.approx((0.5, 1.0, 2 / 3)) and tuple(got[1]) == (0.0, 0.0, 0.0)


def test_table_rows(spark):
    got = column(spark, ["| 1 | **a** |\n| 1 | b |\n| x | y |\n|  | Total | 5 |\n| Grand Total | 9 |"], lambda: X.table_rows(F.col("t")))
    assert got == [{"1": ["1", "b"], "total": ["", "Total", "5"], "grand total": ["Grand Total", "9"]}]


def test_similarity(spark):
    rows = [("# abc def", "abc  def"), ("a", ""), ("abcd", "bcde")]
    assert column(spark, rows, lambda: arrow_udfs.similarity("a", "b"), "a string, b string") == [1.0, 0.0, 0.75]
    assert column(spark, ['{"b": 1, "a": "é"}'], lambda: arrow_udfs.canonical_json("t")) == ['{"a": "é", "b": 1}']
