"""Queries over text layers: tokens, numbers, tables, rules, agreement, digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliary.functions import arrow_udfs, rules
from foliary.functions import text as X
from foliary.operators import audits, multisets, sampling, staging
from foliary.plans.catalog import query
from foliary.plans.frames import t


def _nums(c: str) -> str:
    return f"list_transform(regexp_extract_all({c}, '(?:^|[^A-Za-z])(\\p{{Nd}}[\\p{{Nd}},]*(?:\\.\\p{{Nd}}+)?)', 1), lambda x: replace(x, ',', ''))"


def _words(c: str) -> str:
    return f"list_transform(regexp_extract_all({c}, '[A-Za-z]+(?:[-''][A-Za-z]+)*|\\p{{Nd}}[\\p{{Nd}},]*(?:\\.\\p{{Nd}}+)?'), lambda x: lower(replace(x, ',', '')))"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[\\s\\p{{Z}}\\x1c-\\x1f]+|[\\s\\p{{Z}}\\x1c-\\x1f]+$', '', 'g')"


def _content(c: str) -> str:
    return f"regexp_replace({c}, '(?im)^[ \\t]*(?:\\*\\*|__)?page[ \\t]+\\p{{Nd}}+[ \\t]+of[ \\t]+\\p{{Nd}}+(?:\\*\\*|__)?[ \\t]*$', '', 'g')"


def _seen(c: str) -> str:
    return f"regexp_replace({c}, '\\[([^\\]]*)\\]\\((?:[^()]|\\([^()]*\\))*\\)', '\\1', 'g')"


# a page footer, a number, and a link whose target holds numbers that don't count
_FOOTED = "text || chr(10) || '**Page ' || CAST(doc_id % 9 AS VARCHAR) || ' of 9**' || chr(10) || 'Total ' || CAST(doc_id AS VARCHAR) || ',000.5 a12 [Report 3](https://x.test/(' || CAST(doc_id % 5 AS VARCHAR) || ')/12.pdf)'"


def _footed():
    link = F.concat(F.lit(" [Report 3](https://x.test/("), (F.col("doc_id") % 5).cast("string"), F.lit(")/12.pdf)"))
    return F.concat(F.col("text"), F.lit("\n**Page "), (F.col("doc_id") % 9).cast("string"), F.lit(" of 9**\nTotal "), F.col("doc_id").cast("string"), F.lit(",000.5 a12"), link)


@query(f"SELECT doc_id, array_to_string({_nums(_seen(_FOOTED))}, ' ') AS numbers, len({_nums(_FOOTED)}) AS with_targets FROM documents")
def number_tokens(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.array_join(X.numbers(_footed()), " ").alias("numbers"), F.size(X.plain_numbers(_footed())).cast("long").alias("with_targets"))


@query(f"SELECT doc_id, array_to_string({_nums(_seen(_content(_FOOTED)))}, ' ') AS numbers FROM documents")
def content_number_tokens(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.array_join(X.content_numbers(_footed()), " ").alias("numbers"))


# all documents, and planted beside them (ids below 0) empty, short and ruled texts
_ROUTED = "(SELECT doc_id, text FROM documents UNION ALL SELECT -1 - doc_id, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'A short text of ' || CAST(doc_id AS VARCHAR) ELSE repeat('-- ', 30) || 'ab' END FROM documents WHERE doc_id % 7 < 3)"
_STRIPPED = _strip("text")
_RATIO = f"length(regexp_replace({_STRIPPED}, '[^\\p{{L}}\\p{{N}}]', '', 'g')) / CAST(length(regexp_replace({_STRIPPED}, '[\\s\\p{{Z}}\\x1c-\\x1f]', '', 'g')) AS DOUBLE)"
_REASONS = f"""list_filter([CASE WHEN doc_id % 11 = 0 THEN 'full-page-image' END, CASE WHEN {_STRIPPED} = '' THEN 'empty-native-text' END,
 CASE WHEN {_STRIPPED} <> '' AND length({_STRIPPED}) < 40 THEN 'too-little-native-text' END, CASE WHEN {_STRIPPED} <> '' AND {_RATIO} < 0.35 THEN 'low-alphanumeric-ratio' END,
 CASE WHEN doc_id % 13 = 0 THEN 'garbled' END, CASE WHEN doc_id % 13 = 0 THEN 'scanned' END], lambda x: x IS NOT NULL)"""


def _routed(spark, sf):
    d, i = t(spark, sf, "documents").select("doc_id", "text"), F.col("doc_id")
    planted = F.when(i % 7 == 0, "").when(i % 7 == 1, F.concat(F.lit("A short text of "), i.cast("string"))).otherwise(F.concat(F.repeat(F.lit("-- "), 30), F.lit("ab")))
    return d.unionByName(d.where(i % 7 < 3).select((-1 - i).alias("doc_id"), planted.alias("text")))


def _reasons():
    given = F.when(F.col("doc_id") % 13 == 0, F.array(F.lit("scanned"), F.lit("sparse-text"), F.lit("garbled"))).otherwise(F.array(F.lit("sparse-text")))
    return rules.route_reasons(F.col("text"), given, F.col("doc_id") % 11 == 0)


@query(f"SELECT doc_id, CASE WHEN len(r) > 0 THEN 'ocr' ELSE 'native' END AS route, array_to_string(r, ',') AS reasons FROM (SELECT doc_id, {_REASONS} AS r FROM {_ROUTED})")
def route_decision(spark, sf):
    """All documents; empty, short and ruled texts are planted as further rows."""
    return _routed(spark, sf).withColumn("r", _reasons()).select("doc_id", rules.route(F.col("r")).alias("route"), F.array_join("r", ",").alias("reasons"))


@query(f"SELECT doc_id, CASE WHEN length({_STRIPPED}) = 0 THEN 0.0 ELSE {_RATIO} END AS ratio FROM {_ROUTED}")
def alnum_ratio_route(spark, sf):
    return _routed(spark, sf).select("doc_id", X.alphanumeric_ratio(X.stripped(F.col("text"))).alias("ratio"))


@query(f"""WITH x AS (SELECT CASE WHEN len({_REASONS}) > 0 THEN 'ocr' ELSE 'native' END AS route, CASE WHEN text LIKE '%|%' THEN 'review' ELSE 'accepted' END AS status FROM {_ROUTED})
SELECT CASE WHEN grouping(route) = 0 THEN 'route' ELSE 'status' END AS kind, coalesce(route, status) AS name, count(*) AS n FROM x GROUP BY GROUPING SETS ((route), (status))""")
def route_status_marginals(spark, sf):
    x = _routed(spark, sf).select(rules.route(_reasons()).alias("route"), F.when(F.col("text").contains("|"), "review").otherwise("accepted").alias("status")).groupBy("route", "status").agg(F.count("*").alias("n"))
    g = x.groupingSets([[F.col("route")], [F.col("status")]], "route", "status").agg(F.sum("n").alias("n"), F.grouping("route").alias("g"))
    return g.select(F.when(F.col("g") == 0, "route").otherwise("status").alias("kind"), F.coalesce("route", "status").alias("name"), "n")


# all documents, some with a sign or a table added, and blank texts planted beside them (ids below 0)
_PAGES = "(SELECT doc_id, text FROM documents UNION ALL SELECT -1 - doc_id, '  ' FROM documents WHERE doc_id % 6 = 0)"
_PAGE = "CASE doc_id % 6 WHEN 1 THEN text || chr(65533) WHEN 2 THEN '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 | 3 |' || chr(10) || text ELSE text END"


def _page():
    i = F.col("doc_id")
    table = F.concat(F.lit("| a | b |\n|---|---|\n| 1 | 2 | 3 |\n"), F.col("text"))
    return F.when(i % 6 == 1, F.concat("text", F.lit("�"))).when(i % 6 == 2, table).otherwise(F.col("text"))


def _pages(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "text")
    return d.unionByName(d.where("doc_id % 6 = 0").select((-1 - F.col("doc_id")).alias("doc_id"), F.lit("  ").alias("text")))


def _widths(c: str) -> str:
    own = f"list_filter(list_transform(string_split({c}, chr(10)), lambda x: {_strip('x')}), lambda x: starts_with(x, '|') AND ends_with(x, '|') AND length(x) > 0)"
    cells = f"list_transform({own}, lambda x: string_split(substr(x, 2, greatest(length(x) - 2, 0)), '|'))"
    return f"list_transform(list_filter({cells}, lambda c: len(list_filter(c, lambda x: regexp_replace({_strip('x')}, '[-:]', '', 'g') <> '')) > 0), lambda c: len(c))"


@query(f"SELECT doc_id, array_to_string(w, ',') AS widths, len(list_distinct(w)) > 1 AS uneven FROM (SELECT doc_id, {_widths(_PAGE)} AS w FROM {_PAGES})")
def table_widths(spark, sf):
    p = _pages(spark, sf).select("doc_id", X.table_widths(_page()).alias("w"))
    return p.select("doc_id", F.array_join(F.transform("w", lambda x: x.cast("string")), ",").alias("widths"), (F.size(F.array_distinct("w")) > 1).alias("uneven"))


@query(f"""SELECT doc_id, len(list_filter(string_split({_PAGE}, chr(10)), lambda x: starts_with({_strip('x')}, '|') AND x LIKE '%-%' AND regexp_replace({_strip('x')}, '[|: -]', '', 'g') = '')) AS n FROM {_PAGES}""")
def separator_rows(spark, sf):
    return _pages(spark, sf).select("doc_id", X.separator_rows(_page()).alias("n"))


@query(f"""SELECT doc_id, length(p) - length(replace(p, chr(65533), '')) AS replaced, {_strip('p')} = '' AS blank,
 {_strip('p')} = '' AND ({_strip('f')} = '' OR regexp_matches(f, '^\\s*```[^\\n]*\\n\\s*```\\s*$')) AS empty FROM (SELECT doc_id, {_PAGE} AS p, CASE WHEN doc_id % 4 = 0 THEN '```text' || chr(10) || '```' WHEN doc_id % 4 = 1 THEN '' ELSE text END AS f FROM {_PAGES})""")
def replacement_and_empty(spark, sf):
    fence = F.when(F.col("doc_id") % 4 == 0, "```text\n```").when(F.col("doc_id") % 4 == 1, "").otherwise(F.col("text"))
    return _pages(spark, sf).select("doc_id", X.replacement_characters(_page()).alias("replaced"), X.is_blank(_page()).alias("blank"), X.local_content_empty(_page(), fence).alias("empty"))


@query(f"""WITH p AS (SELECT doc_id, {_PAGE} AS p, {_PAGE.replace('text', "replace(text, '1', '7')")} AS native, CASE WHEN doc_id % 3 = 0 THEN 'native' ELSE 'ocr' END AS route, (doc_id % 10) / 10.0 AS confidence FROM {_PAGES}),
f AS (SELECT doc_id, unnest(list_filter([CASE WHEN {_strip('p')} = '' THEN 'empty-text' END, CASE WHEN p LIKE '%' || chr(65533) || '%' THEN 'replacement-characters' END,
 CASE WHEN route = 'ocr' AND confidence < 0.75 THEN 'low-ocr-confidence' END, CASE WHEN len(list_distinct({_widths('p')})) > 1 THEN 'inconsistent-table-width' END,
 CASE WHEN route = 'ocr' AND {_strip('native')} <> '' AND list_sort({_nums(_seen('p'))}) <> list_sort({_nums(_seen('native'))}) THEN 'native-ocr-numeric-disagreement' END], lambda x: x IS NOT NULL)) AS flag FROM p)
SELECT flag, count(*) AS n FROM f GROUP BY 1""")
def flag_histogram(spark, sf):
    i, p = F.col("doc_id"), _pages(spark, sf)
    p = p.select("doc_id", _page().alias("p"), p["text"]).withColumn("text", F.replace("text", F.lit("1"), F.lit("7"))).select("doc_id", "p", _page().alias("native"))
    found = rules.page_flags(F.col("p"), F.col("p"), F.when(i % 3 == 0, "native").otherwise("ocr"), (i % 10) / 10.0, F.col("native"))
    return p.select(F.explode(found).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


# candidate texts beside their references: a sign, a table of uneven width or a changed number in some; every fifth reference is blank
_CANDIDATE = f"CASE WHEN doc_id < 0 THEN text WHEN doc_id % 6 = 1 THEN {_FOOTED} || chr(65533) WHEN doc_id % 6 = 2 THEN '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| x | y | z |' || chr(10) || {_FOOTED} WHEN doc_id % 6 = 3 THEN replace({_FOOTED}, '.5', '5') ELSE {_FOOTED} END"


@query(f"""SELECT doc_id, array_to_string(list_filter([CASE WHEN {_strip('p')} = '' THEN 'empty-text' END, CASE WHEN p LIKE '%' || chr(65533) || '%' THEN 'replacement-characters' END,
 CASE WHEN len(list_distinct({_widths('p')})) > 1 THEN 'inconsistent-table-width' END,
 CASE WHEN {_strip('r')} <> '' AND list_sort({_nums(_seen(_content('p')))}) <> list_sort({_nums(_seen(_content('r')))}) THEN 'candidate-numeric-disagreement' END], lambda x: x IS NOT NULL), ',') AS flags
FROM (SELECT doc_id, {_CANDIDATE} AS p, CASE WHEN doc_id % 5 = 0 THEN ' ' ELSE {_FOOTED} END AS r FROM {_PAGES})""")
def candidate_flags(spark, sf):
    """Flags of every candidate text against its reference; blank texts are planted as further rows."""
    i, own = F.col("doc_id"), _footed()
    table = F.concat(F.lit("| a | b |\n|---|---|\n| x | y | z |\n"), own)
    changed = F.when(i < 0, F.col("text")).when(i % 6 == 1, F.concat(own, F.lit("\ufffd"))).when(i % 6 == 2, table).when(i % 6 == 3, F.replace(own, F.lit(".5"), F.lit("5"))).otherwise(own)
    x = _pages(spark, sf).select("doc_id", changed.alias("p"), F.when(i % 5 == 0, " ").otherwise(own).alias("r"))
    return x.select("doc_id", F.array_join(rules.candidate_flags(F.col("p"), F.col("r")), ",").alias("flags"))


def _gold(tokens: str, numbered: bool = False) -> str:
    own = "text || ' ' || CAST({i} % 40 AS VARCHAR) || ',5.' || CAST({i} % 3 AS VARCHAR) || ' 7'" if numbered else "text"
    d, b = (f"(SELECT {i} AS id, w AS token, count(*) AS n FROM (SELECT {i}, unnest({tokens.format(own.format(i=i))}) AS w FROM {tab}) GROUP BY 1, 2)" for i, tab in (("doc_id", "documents"), ("item_id", "benchmark")))
    return f"""WITH d AS {d}, b AS {b}, ds AS (SELECT id, sum(n) AS total FROM d GROUP BY 1), bs AS (SELECT id, sum(n) AS total FROM b GROUP BY 1),
c AS (SELECT d.id AS doc_id, b.id AS item_id, sum(least(d.n, b.n)) AS common FROM d JOIN b ON d.token = b.token GROUP BY 1, 2)
SELECT doc_id, item_id, CAST(common AS BIGINT) AS common, CAST(ds.total AS BIGINT) AS found, CAST(bs.total AS BIGINT) AS expected FROM c JOIN ds ON ds.id = doc_id JOIN bs ON bs.id = item_id WHERE common * 2 >= bs.total"""


def _gold_plan(spark, sf, tokens, numbered=False):
    """Token-count tables joined on the token; that of the gold texts is broadcast if it is small, so that no task gathers a common
    word's documents. Texts are dealt by document once: their tokens, the pairs with gold texts and the sums stay in that task.
    Numbers are planted by rule, as the gold texts have none."""
    own = lambda i: F.concat(F.col("text"), F.lit(" "), (F.col(i) % 40).cast("string"), F.lit(",5."), (F.col(i) % 3).cast("string"), F.lit(" 7")) if numbered else F.col("text")
    documents = t(spark, sf, "documents").where("doc_id IS NOT NULL").select("doc_id", "text")
    texts = staging.spread(documents, "doc_id", rows=documents.count(), rows_per_task=2_500).groupBy("doc_id").agg(F.collect_list(own("doc_id")).alias("texts"))
    words = texts.select("doc_id", F.flatten(F.transform("texts", tokens)).alias("words")).select("doc_id", F.size("words").cast("long").alias("found"), F.explode_outer("words").alias("token"))  # a filter for empty arrays would tokenise again
    d = words.where("token IS NOT NULL").groupBy("doc_id", "found", "token").agg(F.count("*").alias("n_left"))
    b = multisets.counted(t(spark, sf, "benchmark"), ["item_id"], tokens(own("item_id")))
    b = staging.stage(b, "gold-tokens")
    few = F.broadcast(b) if b.count() <= 500_000 else b
    common = d.join(few.withColumnRenamed("n", "n_right"), "token").groupBy("doc_id", "found", "item_id").agg(F.sum(F.least("n_left", "n_right")).alias("common"))
    expected = b.groupBy("item_id").agg(F.sum("n").alias("expected"))
    return common.join(F.broadcast(expected) if few is not b else expected, "item_id").where(F.col("common") * 2 >= F.col("expected")).select("doc_id", "item_id", "common", "found", "expected")


@query(_gold(_words("{}").replace("{", "{{").replace("}", "}}").replace("{{}}", "{0}")))
def gold_word_f1(spark, sf):
    """Counts behind precision, recall and F1 of documents that hold at least half of a gold text's words."""
    return _gold_plan(spark, sf, X.word_tokens)


@query(_gold(_nums("{}").replace("{", "{{").replace("}", "}}").replace("{{}}", "{0}"), numbered=True))
def gold_number_f1(spark, sf):
    return _gold_plan(spark, sf, X.plain_numbers, numbered=True)


_LAYERS = f"""SELECT doc_id, {_nums(_seen(_content('a')))} AS local, {_nums(_seen(_content('b')))} AS ocr, {_nums(_seen(_content('c')))} AS model FROM (SELECT doc_id, {_FOOTED} AS a, CASE WHEN doc_id % 3 = 0 THEN replace({_FOOTED}, '.5', '5') ELSE {_FOOTED} END AS b, CASE WHEN doc_id % 4 = 0 THEN {_FOOTED} || ' 77' WHEN doc_id % 4 = 1 THEN replace({_FOOTED}, '/12.pdf', '/99.pdf') ELSE {_FOOTED} END AS c FROM documents)"""


def _layer_texts():
    i, a = F.col("doc_id"), _footed()
    b = F.when(i % 3 == 0, F.replace(a, F.lit(".5"), F.lit("5"))).otherwise(a)
    c = F.when(i % 4 == 0, F.concat(a, F.lit(" 77"))).when(i % 4 == 1, F.replace(a, F.lit("/12.pdf"), F.lit("/99.pdf"))).otherwise(a)
    return a, b, c


def _layers(spark, sf):
    a, b, c = _layer_texts()
    return t(spark, sf, "documents").select("doc_id", X.content_numbers(a).alias("local"), X.content_numbers(b).alias("ocr"), X.content_numbers(c).alias("model"))


@query(f"SELECT doc_id, list_sort(local) = list_sort(ocr) AS agrees FROM ({_LAYERS})")
def numeric_disagreement(spark, sf):
    return _layers(spark, sf).select("doc_id", X.same_multiset(F.col("local"), F.col("ocr")).alias("agrees"))


@query(f"""WITH l AS ({_LAYERS}), a AS (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest(local) AS x FROM l) GROUP BY 1, 2), b AS (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest(ocr) AS x FROM l) GROUP BY 1, 2)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.x, b.x) AS number, greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS local_only, greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) AS ocr_only
FROM a FULL JOIN b ON a.doc_id = b.doc_id AND a.x = b.x WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def numeric_difference(spark, sf):
    """Both layers are counted in one pass. Equal texts have equal numbers, which cancel out in every count: theirs needn't be read out."""
    a, b, _ = _layer_texts()
    texts = t(spark, sf, "documents").select("doc_id", a.alias("a"), b.alias("b")).where(~F.col("a").eqNullSafe(F.col("b")))
    layers = texts.select("doc_id", F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("a").alias("text")), F.struct(F.lit(-1).alias("sign"), F.col("b").alias("text")))).alias("layer"))
    tokens = layers.select("doc_id", "layer.sign", F.explode_outer(X.content_numbers(F.col("layer.text"))).alias("number")).where("number IS NOT NULL")  # a filter for empty arrays would read the numbers out again
    n = tokens.groupBy("doc_id", "number").agg(F.sum("sign").alias("n")).where("n <> 0")
    return n.select("doc_id", "number", F.greatest("n", F.lit(0)).alias("local_only"), F.greatest(-F.col("n"), F.lit(0)).alias("ocr_only"))


_TRIAD = "CASE WHEN a = b AND b = c THEN 'all_equal' WHEN a = c THEN 'local_model_equal' WHEN a = b THEN 'local_ocr_equal' WHEN b = c THEN 'model_ocr_equal' ELSE 'all_different' END"


@query(f"SELECT doc_id, {_TRIAD} AS pattern FROM (SELECT doc_id, list_sort(local) AS a, list_sort(ocr) AS b, list_sort(model) AS c FROM ({_LAYERS}))")
def triad_patterns(spark, sf):
    return _layers(spark, sf).select("doc_id", rules.triad(F.col("local"), F.col("ocr"), F.col("model")).alias("pattern"))


@query(f"""SELECT CASE WHEN doc_id % 2 = 0 THEN 'selected' ELSE 'sidecar' END AS origin, {_TRIAD} AS pattern, count(*) AS pages, count(*) FILTER (WHERE b <> c) AS disagreements
FROM (SELECT doc_id, list_sort(local) AS a, list_sort(ocr) AS b, list_sort(model) AS c FROM ({_LAYERS})) GROUP BY 1, 2""")
def layer_audit(spark, sf):
    x = _layers(spark, sf).select(F.when(F.col("doc_id") % 2 == 0, "selected").otherwise("sidecar").alias("origin"), rules.triad(F.col("local"), F.col("ocr"), F.col("model")).alias("pattern"), (~X.same_multiset(F.col("ocr"), F.col("model"))).alias("differ"))
    return x.groupBy("origin", "pattern").agg(F.count("*").alias("pages"), F.count_if("differ").alias("disagreements"))


@query()
def sequence_similarity(spark, sf):
    """Ratio of each conversation's turn to the one before: an Arrow function, as no built-in has this measure. Its work is long beside the
    bytes of its rows, so that the number of tasks is given."""
    c = t(spark, sf, "conversations").select("conv_id", "turn", "text")
    before = staging.spread(c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("before")), "conv_id", "turn")
    return staging.spread(c, "conv_id", "turn").join(before, ["conv_id", "turn"]).select("conv_id", "turn", arrow_udfs.similarity("before", "text").alias("similarity"), arrow_udfs.word_sequence_similarity("before", "text").alias("words"))


_LINKED = "'[Report ' || CAST(doc_id AS VARCHAR) || '](https://example.test/file(7).pdf) ' || text || ' [open](x(1'"


@query(f"SELECT doc_id, sha256({_seen(_LINKED)}) AS digest FROM documents")
def visible_markdown(spark, sf):
    """Whole texts between a link and one that isn't closed, which stays."""
    linked = F.concat(F.lit("[Report "), F.col("doc_id").cast("string"), F.lit("](https://example.test/file(7).pdf) "), F.col("text"), F.lit(" [open](x(1"))
    return t(spark, sf, "documents").select("doc_id", F.sha2(X.without_links(linked), 256).alias("digest"))


# a link nested as deep as the id says, with an escaped parenthesis, a link inside its target and one that isn't closed
_DEEP = "text || ' [Label [' || CAST(doc_id AS VARCHAR) || '](' || repeat('a(1', CAST(doc_id % 51 AS INTEGER)) || '\\\\)[in](2)' || repeat(')', CAST(doc_id % 51 AS INTEGER)) || ') 3 [open](x(1) [4](5)'"


@query(f"""WITH RECURSIVE p AS (SELECT doc_id, regexp_extract_all({_DEEP}, '\\]\\(|[\\[\\]()]|[^\\[\\]()]+') AS x FROM documents),
s AS (
  SELECT doc_id, CAST(1 AS BIGINT) AS j, CAST(0 AS BIGINT) AS opened, CAST(0 AS BIGINT) AS closed, CAST(0 AS BIGINT) AS depth, CAST([] AS VARCHAR[]) AS shown FROM p
  UNION ALL
  SELECT doc_id, CASE WHEN opened > 0 THEN CASE WHEN j > len(x) THEN opened + 1 ELSE j + 1 END WHEN link > 0 THEN j + link + 1 ELSE j + 1 END,
    CASE WHEN opened > 0 THEN CASE WHEN j > len(x) OR deeper = 0 THEN 0 ELSE opened END WHEN link > 0 THEN j ELSE 0 END,
    CASE WHEN opened > 0 THEN closed WHEN link > 0 THEN j + link ELSE 0 END,
    CASE WHEN opened > 0 THEN CASE WHEN j > len(x) THEN 0 ELSE deeper END WHEN link > 0 THEN 1 ELSE 0 END,
    CASE WHEN opened > 0 THEN CASE WHEN j > len(x) THEN list_append(shown, x[opened]) WHEN deeper = 0 THEN list_concat(shown, x[opened + 1:closed - 1]) ELSE shown END WHEN link > 0 THEN shown ELSE list_append(shown, x[j]) END
  FROM (
    SELECT s.*, p.x, CASE WHEN s.opened = 0 AND x[j] = '[' THEN coalesce(list_position(x[j + 1:], ']('), 0) ELSE 0 END AS link,
      s.depth + CASE WHEN ends_with(coalesce(x[j - 1], ''), '\\') THEN 0 WHEN x[j] IN ('(', '](') THEN 1 WHEN x[j] = ')' THEN -1 ELSE 0 END AS deeper
    FROM s JOIN p USING (doc_id) WHERE s.j <= len(p.x) OR s.opened > 0
  )
)
SELECT s.doc_id, sha256(array_to_string(shown, '')) AS digest, len(shown) > 0 AS found FROM s JOIN p USING (doc_id) WHERE j > len(x) AND opened = 0""")
def deep_links(spark, sf):
    """Whole texts with a link of 0 to 50 nested parentheses, a link within its target, and one that isn't closed."""
    i, text = F.col("doc_id"), F.col("text")
    depth = (i % 51).cast("int")
    linked = F.concat(text, F.lit(" [Label ["), i.cast("string"), F.lit("]("), F.repeat(F.lit("a(1"), depth), F.lit("\\)[in](2)"), F.repeat(F.lit(")"), depth), F.lit(") 3 [open](x(1) [4](5)"))
    return t(spark, sf, "documents").select("doc_id", F.sha2(X.without_links(linked), 256).alias("digest"), F.lit(True).alias("found"))


@query("""WITH s AS (SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM documents)
SELECT doc_id, CASE WHEN s = '' THEN 'document' ELSE rtrim(substr(s, 1, 60), '-') END AS slug FROM s""")
def slugs(spark, sf):
    return t(spark, sf, "documents").select("doc_id", X.slugify(F.col("text")).alias("slug"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE lpad(CAST(year(o_orderdate) AS VARCHAR), 4, '0') || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '-' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') END AS day FROM orders""")
def parse_dates(spark, sf):
    written = F.when(F.col("o_orderkey") % 5 == 0, "date unavailable").otherwise(F.concat_ws(".", F.dayofmonth("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"), F.year("o_orderdate").cast("string")))
    return t(spark, sf, "orders").select("o_orderkey", X.parse_date(written).alias("day"))


@query("""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN p_size WHEN 1 THEN 4 WHEN 2 THEN 19 WHEN 3 THEN 1994 END::BIGINT AS value FROM part""")
def roman_values(spark, sf):
    s = F.col("p_size")
    label = F.when(s % 5 == 0, s.cast("string")).when(s % 5 == 1, "IV").when(s % 5 == 2, "xix").when(s % 5 == 3, "MCMXCIV").otherwise("12abc")
    return t(spark, sf, "part").select("p_partkey", X.roman_value(label).alias("value"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'en' WHEN p_size % 4 = 1 THEN 'hi' ELSE 'und' END AS hint, CASE WHEN p_size % 4 = 0 THEN 'XII' WHEN p_size % 4 = 1 THEN 'Ram XII' ELSE '7' END AS session,
 CASE WHEN p_size % 4 = 0 THEN 'en' WHEN p_size % 4 = 1 THEN 'hi' ELSE 'und' END AS language FROM part""")
def labels_and_hints(spark, sf):
    s = F.col("p_size") % 4
    name = F.when(s == 0, "answer_English.pdf").when(s == 1, "उत्तर हिंदी.pdf").when(s == 2, "hin_eng.pdf").otherwise("file.pdf")
    session = F.when(s == 0, "RamXII").when(s == 1, "Ram XII").otherwise("7")
    said = F.when(s == 0, F.array(F.lit(" English "))).when(s == 1, F.array(F.lit("hindi"), F.lit(""))).otherwise(F.array(F.lit("English"), F.lit("Hindi")))
    return t(spark, sf, "part").select("p_partkey", X.language_hint(name, F.array().cast("array<string>")).alias("hint"), X.normal_session(session, F.array(F.lit("Ram"), F.lit("Sita"))).alias("session"), X.language_of(said).alias("language"))


@query("SELECT sha256(text) AS digest, min(doc_id) AS first_id, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1")
def content_hash_dedup(spark, sf):
    return t(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT source, sha256(string_agg(CAST(doc_id AS VARCHAR) || chr(10), '' ORDER BY doc_id)) AS digest, count(*) AS n FROM documents GROUP BY 1")
def inventory_digest(spark, sf):
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: F.concat(x.cast("string"), F.lit("\n"))), "")
    return t(spark, sf, "documents").groupBy("source").agg(F.sha2(joined, 256).alias("digest"), F.count("*").alias("n"))


_INK = "SELECT vec_id, label, len(g) AS pixels, len(list_filter(g, lambda x: x < 250)) AS dark FROM (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 + 100 * CAST(x AS DOUBLE))) AS g FROM embeddings)"


def _inks(spark, sf):
    grey = F.transform("embedding", lambda x: F.floor(256 + 100 * x.cast("double")))
    pixels, dark, blank = rules.ink(F.col("g"))
    return t(spark, sf, "embeddings").select("vec_id", "label", grey.alias("g")).select("vec_id", "label", pixels.alias("pixels"), dark.alias("dark"), blank.alias("blank"))


@query(f"SELECT vec_id, pixels, dark, dark <= 25 AS blank FROM ({_INK})")
def ink_metrics(spark, sf):
    return _inks(spark, sf).drop("label")


@query(f"""SELECT vec_id, label <> 3 AND dark <= pixels AS valid, label <> 3 AND dark <= 25 AS verified_blank, concat_ws(',', CASE WHEN dark <= 25 AND label = 1 THEN 'local-nonempty-on-blank' END, CASE WHEN dark <= 25 AND label = 2 THEN 'model-nonempty-on-blank' END,
 CASE WHEN dark > 25 THEN 'ocr-empty-on-visible' END) AS flags FROM ({_INK})""")
def metrics_valid(spark, sf):
    x, label = _inks(spark, sf), F.col("label")
    cutoff = F.when(label == 3, 240).otherwise(250)
    found = rules.visual_flags(F.col("blank"), label != 1, F.when(label == 2, "text"), F.lit(""))
    args = (F.col("pixels"), F.col("dark"), cutoff, F.col("blank"))
    return x.select("vec_id", rules.valid_metrics(*args).alias("valid"), rules.verified_blank(F.lit(True), *args).alias("verified_blank"), F.array_join(found, ",").alias("flags"))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 4 ELSE 5 END::BIGINT AS exact, 6::BIGINT AS expected FROM part""")
def table_score(spark, sf):
    """Cells of a Markdown table against a reference by the row's first cell, the last of equal keys counting."""
    reference = X.table_rows(F.lit("| no | a | b |\n|---|---|---|\n| 1 | 10 | 20 |\n| **Total** | 30 | 40 |\n"))
    candidate = X.table_rows(F.when(F.col("p_size") % 2 == 0, "| 1 | 10 | 21 |\n| total | 30 | 41 |").otherwise("| 1 | 9 | 9 |\n| 1 | 10 | 20 |\n| Total | 30 | 4 |"))
    parts = staging.spread(t(spark, sf, "part").select("p_partkey", "p_size"), "p_partkey")
    once = F.broadcast(spark.range(1).select(F.map_entries(reference).alias("reference")))  # parsed once, not in every row
    # a case of key cells differs between the tables, as it does in the reference row "Total"
    score = parts.crossJoin(once).select("p_partkey", X.table_cells(F.col("reference"), candidate).alias("score"))
    return score.select("p_partkey", "score.exact", "score.expected")


_AGREE = f"""WITH s AS (SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations) ORDER BY md5('7|' || CAST(conv_id AS VARCHAR)), conv_id LIMIT 200),
k AS (SELECT conv_id AS page, arg_min(text, turn) || ' 5 ' || CAST(conv_id % 3 AS VARCHAR) AS canonical FROM conversations JOIN s USING (conv_id) GROUP BY conv_id),
a AS (SELECT conv_id AS page, role AS model, arg_max(text, turn) || ' 5 ' || CAST((conv_id + max(turn)) % 3 AS VARCHAR) AS text FROM conversations JOIN s USING (conv_id) GROUP BY conv_id, role),
n AS (SELECT page, model, list_sort({_nums(_seen(_content('canonical')))}) AS said, list_sort({_nums(_seen(_content('text')))}) AS read, {_strip('text')} = '' AS blank, len(list_distinct({_widths('text')})) > 1 AS uneven FROM a JOIN k USING (page))
SELECT 'model' AS kind, model AS a, 'canonical' AS b, count(*) AS pages, count(*) FILTER (WHERE blank) AS empty, count(*) FILTER (WHERE said <> read) AS numeric, count(*) FILTER (WHERE uneven) AS tables FROM n GROUP BY model
UNION ALL SELECT 'pair', x.model, y.model, count(*), NULL, count(*) FILTER (WHERE x.read <> y.read), NULL FROM n x JOIN n y ON x.page = y.page AND x.model < y.model GROUP BY 2, 3"""


@query(_AGREE)
def model_agreement(spark, sf):
    """Roles as models that read conversations: a seeded sample of 200 (the sample is the feature), each role's newest turn against the first
    one; numbers are added by rule."""
    c = t(spark, sf, "conversations").select(F.col("conv_id").alias("page"), "turn", F.col("role").alias("model"), "text")
    number = lambda n: F.concat(F.lit(" 5 "), (n % 3).cast("string"))
    drawn = sampling.seeded(c.select("page").distinct(), 200, 7, "page")
    sample = c.join(F.broadcast(drawn), "page").groupBy("page").agg(F.min_by("text", "turn").alias("first")).select("page", F.concat("first", number(F.col("page"))).alias("canonical"))
    answers = c.groupBy("page", "model").agg(F.max_by("text", "turn").alias("text"), F.max("turn").alias("turn")).select("page", "model", F.concat("text", number(F.col("page") + F.col("turn"))).alias("text"))
    return audits.model_agreement(sample, answers)


_TABLE = "chr(10) || '| a | b |' || chr(10) || '|---|---|' || chr(10) || '|---|---|' || chr(10) || '|---|---|'"
_LAYOUTS = f"""(SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'native' ELSE 'ocr' END AS route, text || CASE WHEN doc_id % 17 = 0 THEN {_TABLE} ELSE '' END AS local, text || CASE WHEN doc_id % 13 = 0 THEN ' 12' ELSE '' END AS model FROM documents
UNION ALL SELECT -1 - doc_id, 'ocr', '', text FROM documents WHERE doc_id % 41 = 0)"""


def _separators(c: str) -> str:
    return f"len(list_filter(string_split({c}, chr(10)), lambda x: starts_with({_strip('x')}, '|') AND x LIKE '%-%' AND regexp_replace({_strip('x')}, '[|: -]', '', 'g') = ''))"


@query(f"""WITH p AS (SELECT doc_id, route, local, model, {_separators('local')} AS separators, list_sort({_nums(_seen(_content('local')))}) AS a, list_sort({_nums(_seen(_content('model')))}) AS b, md5('3|' || CAST(doc_id AS VARCHAR)) AS h FROM {_LAYOUTS}),
s1 AS (SELECT doc_id, route, 'random_baseline' AS stratum FROM p ORDER BY h, doc_id LIMIT 60),
s2 AS (SELECT doc_id, route, 'route_baseline' AS stratum FROM p WHERE route NOT IN (SELECT route FROM s1) QUALIFY row_number() OVER (PARTITION BY route ORDER BY h, doc_id) = 1),
t2 AS (FROM s1 UNION ALL FROM s2), s3 AS (SELECT doc_id, route, 'empty_local_text' AS stratum FROM p WHERE {_strip('local')} = '' AND doc_id NOT IN (SELECT doc_id FROM t2) ORDER BY h, doc_id LIMIT 20),
t3 AS (FROM t2 UNION ALL FROM s3), s4 AS (SELECT doc_id, route, 'layout' AS stratum FROM p WHERE separators >= 3 AND doc_id NOT IN (SELECT doc_id FROM t3) ORDER BY h, doc_id LIMIT (SELECT (121 - count(*)) // 2 FROM t3)),
t4 AS (FROM t3 UNION ALL FROM s4), s5 AS (SELECT doc_id, route, 'numeric' AS stratum FROM p WHERE a <> b AND doc_id NOT IN (SELECT doc_id FROM t4) ORDER BY h, doc_id LIMIT (SELECT 120 - count(*) FROM t4)),
t5 AS (FROM t4 UNION ALL FROM s5), s6 AS (SELECT doc_id, route, 'random_fill' AS stratum FROM p WHERE doc_id NOT IN (SELECT doc_id FROM t5) ORDER BY h, doc_id LIMIT (SELECT 120 - count(*) FROM t5))
SELECT doc_id, stratum, concat_ws(',', CASE WHEN separators <> {_separators('model')} THEN 'separator-rows' END, CASE WHEN {_widths('local')} <> {_widths('model')} THEN 'table-widths' END, CASE WHEN a <> b THEN 'numbers' END,
 CASE WHEN {_strip('local')} = '' THEN 'local-empty' END, CASE WHEN {_strip('model')} = '' THEN 'model-empty' END) AS reasons FROM p JOIN (FROM t5 UNION ALL FROM s6) USING (doc_id)""")
def layout_audit(spark, sf):
    """A sample of 120 pages over overlapping strata (the sample is the feature) and why each must be looked at. Tables and numbers are added to
    some whole texts; pages without local text are planted beside the documents."""
    d, i = t(spark, sf, "documents").select("doc_id", "text"), F.col("doc_id")
    table = F.lit("\n| a | b |\n|---|---|\n|---|---|\n|---|---|")
    pages = d.select("doc_id", F.when(i % 3 == 0, "native").otherwise("ocr").alias("route"), F.concat("text", F.when(i % 17 == 0, table).otherwise("")).alias("local"), F.concat("text", F.when(i % 13 == 0, " 12").otherwise("")).alias("model"))
    pages = pages.unionByName(d.where(i % 41 == 0).select((-1 - i).alias("doc_id"), F.lit("ocr").alias("route"), F.lit("").alias("local"), F.col("text").alias("model")))
    numbers = lambda c: F.sort_array(X.content_numbers(F.col(c)))
    strata = pages.select("doc_id", "route", X.is_blank(F.col("local")).alias("local_empty"), X.separator_rows(F.col("local")).alias("separator_rows"), (numbers("local") != numbers("model")).alias("numeric_differs"))
    found = audits.layout_differences(audits.layout_sample(strata, "doc_id", 120, 3), pages, "doc_id")
    return found.select("doc_id", "stratum", F.array_join("reasons", ",").alias("reasons"))
