"""Divergence of sources within each language, by term vectors.

Terms are runs of letters and of characters beyond ASCII, A to Z in lower case. A language keeps the V terms that occur in at least
``least_documents`` of its documents (rows). Each term is pivoted into one row with an array over the language's sources (source
index and count, in order of the index). A count c in a group of N kept terms stands for p = 1 + floor(10^9 (c + 1) / (N + V)); the
divergence of p from q is f(p, q) = floor((p - q)^2 / q).

Pairs. Sources that lack a term aren't stored in its array: they all have p(0) = z there. With F over all V terms,

    value(g, h) = V f(z_g, z_h) + sum over terms of g [f(p, z_h) - f(z_g, z_h)] + sum over terms of h [f(z_g, q) - f(z_g, z_h)]
                  + sum over terms of both [f(p, q) - f(p, z_h) - f(z_g, q) + f(z_g, z_h)]

which is exact, as all are integers. The last sum is emitted per term by higher-order functions over its array, and summed with map-side
aggregation; the two in the middle depend on the count alone, so they come from how many terms of a group have which count. So
work follows the terms a source has, not all terms times all sources squared. The rows of a document are never counted by a key of
the document: occurrences are sorted within the row, where the first of each term counts its document.

Exact up to 9.2 * 10^15 occurrences per language (floor of a ratio by long division in base 1,000 in 64 bits). A row of a language holds
one number per source; its join is dealt by language and a salt, and Spark broadcasts it only below its own size limit. Ranking is
by group; terms are ranked in salted parts first.

Null text, lang and source read as ''. Groups without terms take part with V, their counts being 0; a language without kept terms has
pairs of value 0. A language of one source has no pairs. Repeated rows are documents of their own. Empty tables give none.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliary.llm.common import stage

#: What stands between terms.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SALTS = 32


def occurrences(docs: DataFrame) -> DataFrame:
    """lang, source, term: ``count`` occurrences in ``documents`` rows."""
    rows = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("lang"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("source"), docs["text"].cast("string").alias("text"))
    words = F.sort_array(F.split(F.translate("text", string.ascii_uppercase, string.ascii_lowercase), BETWEEN))
    rows = rows.where(F.col("text").isNotNull()).select("lang", "source", words.alias("words"))
    # each sorted word beside the one before it
    each = rows.select("lang", "source", F.inline(F.arrays_zip(F.col("words").alias("term"), F.concat(F.array(F.lit("")), "words").alias("before"))).alias("term", "before")).where("term <> ''")
    return each.groupBy("lang", "source", "term").agg(F.count(F.lit(1)).alias("count"), F.sum((F.col("term") != F.col("before")).cast("long")).alias("documents"))


def _share(count: str, size: str) -> str:
    """SQL of 1 + floor(10^9 (count + 1) / size), 1 where size is 0: long division in base 1,000, as count + 1 <= size."""
    a = f"({count} + 1L)"
    r1 = f"(({a} * 1000L) % {size})"
    r2 = f"(({r1} * 1000L) % {size})"
    return f"if({size} = 0L, 1L, 1L + 1000000L * (({a} * 1000L) div {size}) + 1000L * (({r1} * 1000L) div {size}) + (({r2} * 1000L) div {size}))"


def _apart(p: str, q: str) -> str:
    """SQL of floor((p - q)^2 / q)."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def _with_language(df: DataFrame, languages: DataFrame, salt) -> DataFrame:
    """``df`` with its language's row, dealt by language and salt, so that no language is one task."""
    salted = languages.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int")).join(salted, ["lang", "_salt"]).drop("_salt")


def audit(docs: DataFrame, top: int = 200, least_documents: int = 3) -> DataFrame:
    """lang, source, part (pair, term), item, value, rank: see the module."""
    found = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("lang"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("source")).distinct()
    groups = stage(found.withColumn("ix", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1), "groups")
    counts = occurrences(docs).join(groups, ["lang", "source"])
    wide = counts.groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("count").alias("total"), F.sort_array(F.collect_list(F.struct("ix", "count"))).alias("entries"))
    wide = stage(wide.where(F.col("documents") >= least_documents).select("lang", "term", "total", "entries"), "wide-terms")

    cells = wide.select("lang", "term", "total", F.inline("entries"))
    # how many terms of a group have which count: all sums over one group come from here
    counted = stage(cells.groupBy("lang", "ix", "count").agg(F.count(F.lit(1)).alias("terms")), "term-counts")
    sizes = counted.groupBy("lang", "ix").agg(F.sum(F.col("count") * F.col("terms")).alias("n"))
    kept = wide.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    every = groups.join(sizes, ["lang", "ix"], "left").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("ix", F.coalesce("n", F.lit(0)).alias("n")))).alias("by_ix"))
    languages = every.join(kept, "lang", "left").select("lang", F.coalesce("v", F.lit(0)).alias("v"), F.col("by_ix.n").alias("ns"))
    languages = languages.withColumn("d", F.transform("ns", lambda n: n + F.col("v"))).withColumn("all_d", F.aggregate("ns", F.col("v"), lambda a, n: a + n))
    languages = stage(languages.withColumn("z", F.expr(f"transform(d, x -> {_share('0L', 'x')})")).select("lang", "v", "d", "z", "all_d"), "languages")

    # 1. V f(z_g, z_h), for all ordered pairs of a language's sources
    base = languages.select("lang", "v", "z", F.posexplode("z").alias("i", "zi")).select("lang", "v", "i", "zi", F.posexplode("z").alias("j", "zj")).where("i <> j").select("lang", "i", "j", F.expr(f"v * {_apart('zi', 'zj')}").alias("value"))
    # 2. a group's own terms against what lacks them, both ways
    alone = _with_language(counted, languages, F.xxhash64("ix", "count")).withColumn("p", F.expr(_share("count", "d[ix]"))).withColumn("zi", F.expr("z[ix]"))
    alone = alone.select("lang", "ix", "terms", "p", "zi", F.posexplode("z").alias("j", "zj")).where("ix <> j")
    alone = alone.select("lang", F.inline(F.array(
        F.struct(F.col("ix").alias("i"), F.col("j"), F.expr(f"terms * ({_apart('p', 'zj')} - {_apart('zi', 'zj')})").alias("value")),
        F.struct(F.col("j").alias("i"), F.col("ix").alias("j"), F.expr(f"terms * ({_apart('zj', 'p')} - {_apart('zj', 'zi')})").alias("value")),
    )))
    # 3. terms that both have: each entry with those after it, both ways. As f(p, q) = floor(p^2 / q) - 2 p + q, only the ratios remain of
    # the four differences
    valued = _with_language(wide, languages, F.xxhash64("term")).withColumn("e", F.expr(f"transform(entries, e -> named_struct('ix', e.ix, 'p', {_share('e.count', 'd[e.ix]')}, 'z', z[e.ix]))"))
    valued = valued.withColumn("e", F.expr("transform(e, e -> named_struct('ix', e.ix, 'p', e.p, 'z', e.z, 'pp', e.p * e.p, 'zz', e.z * e.z))"))
    each = valued.where("size(entries) > 1").select("lang", F.posexplode("e").alias("k", "a"), "e").where("k + 1 < size(e)")
    both = each.select("lang", "a", F.explode(F.expr(f"""transform(slice(e, k + 2, size(e)), b -> named_struct('ix', b.ix, 'z', b.z,
        'ij', a.pp div b.p - a.pp div b.z - a.zz div b.p, 'ji', b.pp div a.p - b.pp div a.z - b.zz div a.p))""")).alias("b"))
    both = both.groupBy("lang", F.col("a.ix").alias("i"), F.col("b.ix").alias("j")).agg(F.sum("b.ij").alias("ij"), F.sum("b.ji").alias("ji"), F.count(F.lit(1)).alias("n"), F.any_value("a.z").alias("zi"), F.any_value("b.z").alias("zj"))
    both = both.select("lang", F.inline(F.array(
        F.struct("i", "j", F.expr("ij + n * (zi * zi div zj)").alias("value")),
        F.struct(F.col("j").alias("i"), F.col("i").alias("j"), F.expr("ji + n * (zj * zj div zi)").alias("value")),
    )))
    pairs = base.unionByName(alone).unionByName(both).groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    named = lambda ix, source: groups.select("lang", F.col("ix").alias(ix), F.col("source").alias(source))
    pairs = pairs.join(named("i", "source"), ["lang", "i"]).join(named("j", "item"), ["lang", "j"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))

    # terms that a group has more of than its language
    terms = _with_language(wide, languages, F.xxhash64("term")).withColumn("q", F.expr(_share("total", "all_d"))).select("lang", "term", "q", "d", F.inline("entries"))
    terms = terms.withColumn("p", F.expr(_share("count", "d[ix]"))).where("p > q").select("lang", "ix", F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"))
    order = [F.desc("value"), F.asc("item")]
    terms = terms.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(SALTS))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "ix", "part").orderBy(*order))).where(F.col("rank") <= top)
    terms = terms.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "ix").orderBy(*order))).where(F.col("rank") <= top)
    terms = terms.join(groups, ["lang", "ix"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.select("lang", "source", "part", "item", "value", "rank").unionByName(terms)
