"""Audits over samples: agreement of models on a seeded sample with task states that can be resumed, layouts of pages drawn from overlapping
strata, and the transcripts that a scope's latest runs should have left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliary.functions import text as X
from foliary.operators import sampling, versions
from foliary.operators.staging import stage


def task_states(sample: DataFrame, models: list[str], results: DataFrame, key: str = "page") -> DataFrame:
    """(page, model, state) of every task of a sample: the state of its newest result (page, model, n, state), pending without one. What
    isn't ok is what a resumed run takes up."""
    tasks = sample.select(key, F.explode(F.array(*map(F.lit, models))).alias("model"))
    newest = versions.latest(results.select(key, "model", "n", F.col("state").alias("_state")), [key, "model"], "n")
    return tasks.join(newest, [key, "model"], "left").select(key, "model", F.coalesce("_state", F.lit("pending")).alias("state"))


def model_agreement(sample: DataFrame, answers: DataFrame, key: str = "page") -> DataFrame:
    """kind, a, b, pages, empty, numeric, tables. Per model (kind model, b is canonical): pages answered, empty answers, answers whose numbers
    aren't those of the canonical text, and those with tables of uneven width. Per pair of models (kind pair, a < b): pages that both
    answered, and those with other numbers. Columns page, canonical; answers page, model, text (one per page and model). Numbers are taken
    once per answer; the pairs of a page are those of its few models."""
    numbers = lambda c: F.sort_array(X.content_numbers(F.coalesce(c, F.lit(""))))
    wanted = sample.select(key, numbers(F.col("canonical")).alias("said"))
    widths = X.table_widths(F.coalesce("text", F.lit("")))
    read = stage(answers.join(wanted, key).select(key, "model", "said", numbers(F.col("text")).alias("read"), X.is_blank(F.col("text")).alias("blank"), (F.size(F.array_distinct(widths)) > 1).alias("uneven")), "answers")
    single = read.groupBy(F.col("model").alias("a")).agg(F.count("*").alias("pages"), F.count_if("blank").alias("empty"), F.count_if(F.col("said") != F.col("read")).alias("numeric"), F.count_if("uneven").alias("tables"))
    single = single.select(F.lit("model").alias("kind"), "a", F.lit("canonical").alias("b"), "pages", "empty", "numeric", "tables")
    both = read.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("model", "read"))).alias("m"))
    each = both.select(F.posexplode("m").alias("i", "x"), "m").select("x", F.explode(F.slice("m", F.col("i") + 2, F.greatest(F.size("m") - F.col("i") - 1, F.lit(0)))).alias("y"))
    pairs = each.groupBy(F.col("x.model").alias("a"), F.col("y.model").alias("b")).agg(F.count("*").alias("pages"), F.count_if(F.col("x.read") != F.col("y.read")).alias("numeric"))
    none = F.lit(None).cast("long")
    return single.unionByName(pairs.select(F.lit("pair").alias("kind"), "a", "b", "pages", none.alias("empty"), "numeric", none.alias("tables")))


def layout_sample(pages: DataFrame, key: str, count: int, seed: int) -> DataFrame:
    """``count`` pages over strata that overlap, none drawn twice; ``stratum`` says which drew it. Half are a random baseline; then one of
    each route that is missing, up to a sixth without local text, half of what is left with layouts (three separator rows or more), the rest with
    numbers that differ, and random ones to fill up. Columns route, local_empty, separator_rows, numeric_differs. Each stratum is a top-k by
    hash; what is drawn is at most ``count`` rows."""
    if count <= 0:
        raise ValueError("a sample needs at least one page")
    light = stage(pages.select(key, "route", "local_empty", "separator_rows", "numeric_differs"), "strata")
    taken = light.limit(0).withColumn("stratum", F.lit(""))
    sizes = 0

    def draw(name: str, condition: Column, most: int, per_route: bool = False) -> None:
        nonlocal taken, sizes
        most = min(most, count - sizes)
        if most <= 0:
            return
        pool = light.where(condition).join(F.broadcast(taken.select(key)), key, "left_anti")
        if per_route:
            pool = sampling.per_group(pool.join(F.broadcast(taken.select("route").distinct()), "route", "left_anti").where("route IS NOT NULL"), ["route"], 1, [sampling.seeded_rank(seed, key), F.col(key)])
        drawn = pool.orderBy(sampling.seeded_rank(seed, key), key).limit(most).withColumn("stratum", F.lit(name))
        taken = stage(taken.unionByName(drawn.select(*taken.columns)), "drawn")
        sizes = taken.count()

    draw("random_baseline", F.lit(True), max(1, count // 2))
    draw("route_baseline", F.lit(True), count, per_route=True)
    draw("empty_local_text", F.col("local_empty"), max(1, count // 6))
    draw("layout", F.col("separator_rows") >= 3, (count - sizes + 1) // 2)
    draw("numeric", F.col("numeric_differs"), count - sizes)
    draw("random_fill", F.lit(True), count - sizes)
    return taken.select(key, "stratum")


def layout_differences(sample: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """Reasons of each drawn page to be looked at (local, model: texts): separator rows or table widths differ, numbers differ, either is empty."""
    local, model = F.coalesce("local", F.lit("")), F.coalesce("model", F.lit(""))
    numbers = lambda c: F.sort_array(X.content_numbers(c))
    found = [
        F.when(X.separator_rows(local) != X.separator_rows(model), "separator-rows"), F.when(X.table_widths(local) != X.table_widths(model), "table-widths"), F.when(numbers(local) != numbers(model), "numbers"),
        F.when(X.is_blank(local), "local-empty"), F.when(X.is_blank(model), "model-empty"),
    ]
    return pages.join(F.broadcast(sample), key).select(key, "stratum", F.array_compact(F.array(*found)).alias("reasons"))


def transcript_paths(scope: DataFrame, runs: DataFrame, pages: DataFrame, answers: DataFrame, listing: DataFrame, provider: str, root: str = "data/artifacts/", name: str = "adjudicated.md") -> DataFrame:
    """(path, state) of the transcripts of a scope: of every page of each document's latest complete run, the newest answer of
    ``provider`` names a response; the transcript lies beside it. Distinct paths are held against ``listing`` (path): present, missing or unexpected;
    a response that isn't below ``root`` is outside. Columns document; id, document, status; run_id, page_number; id, run_id, page_number, provider, response_path."""
    last = runs.where("status = 'complete'").join(scope.select("document").distinct(), "document", "left_semi").groupBy("document").agg(F.max("id").alias("run_id"))
    newest = answers.where(F.col("provider") == provider).groupBy("run_id", "page_number").agg(F.max_by("response_path", "id").alias("response"))
    responses = pages.join(last.select("run_id"), "run_id", "left_semi").join(newest, ["run_id", "page_number"]).where("response IS NOT NULL").select(F.replace("response", F.lit("\\"), F.lit("/")).alias("response")).distinct()
    inside = F.col("response").contains(root)
    below = F.substr("response", F.instr("response", F.lit(root)))
    expected = responses.select(F.when(inside, F.concat(F.regexp_replace(below, "[^/]*$", ""), F.lit(name))).otherwise(F.col("response")).alias("path"), inside.alias("inside")).distinct()
    there = listing.select("path").distinct().withColumn("there", F.lit(True))
    state = F.when(F.col("inside").isNull(), "unexpected").when(~F.col("inside"), "outside").when(F.col("there"), "present").otherwise("missing")
    return expected.join(there, "path", "full").select("path", state.alias("state"))
