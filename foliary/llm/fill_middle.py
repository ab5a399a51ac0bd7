"""Fill-in-middle transformation by overlapping chunks of each text.

A text is a sequence of units, here lines: a boundary lies after a line feed that another character follows, and at the end of a
text that isn't empty. The UTF-8 bytes are cut into chunks of ``chunk_bytes`` that overlap by one byte, so that the predicate over
two adjacent characters (left one is a line feed, right one exists) can be counted in each chunk by itself, also at its edge (a line
feed is never part of another character). Prefix sums of the counts give the chunk that owns each of the two cut ranks; only these
chunks are scanned again for the place. Chunks of a text are counted in the task that holds the text: it moves nowhere, there
is no shuffle, and memory is a text and its outputs. All of it is Spark columns.

The two cuts come from the sha256 of ``seed:doc_id`` (first 8-digit groups h1 to h4): after h1 % (n+1) and h2 % (n+1) units, where n
is the number of units. A text is left plain if it is empty, if it contains a sentinel, or if h3 % 100 >= ``rate``; else it is spm if
h4 % 100 < ``spm``, else psm.

Null texts are empty. A null doc_id reads as the empty string in the digest. Repeated rows give repeated rows; empty tables give
none. Other columns are left out, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def _text(data: Column, start: Column, length: Column) -> Column:
    """Whole characters of UTF-8 ``data`` from byte ``start`` (from 0)."""
    return F.substring(data, start + 1, length).cast("string")


def _feeds(chunk: Column) -> Column:
    """Line feeds in a chunk that may begin or end inside a character."""
    return F.octet_length(chunk) - F.octet_length(F.replace(chunk, F.lit("\n"), F.lit("")))


def _counts(data: Column, size: Column, chunk_bytes: int) -> Column:
    """Boundaries per chunk: line feeds with a byte after them, among the chunk's own bytes; the last chunk has the text's end too."""

    def one(i: Column) -> Column:
        start = i * chunk_bytes
        own = F.least(F.lit(chunk_bytes), size - start)
        right = F.least(size - start - own, F.lit(1))  # the byte of overlap, if there is one
        left = F.substring(data, start + 1, own - F.when(right == 0, 1).otherwise(0))  # the text's last byte has no neighbour to its right
        return (_feeds(left.cast("string")) + F.when(right == 0, 1).otherwise(0)).cast("long")

    return F.when(size > 0, F.transform(F.sequence(F.lit(0), ((size - 1) / chunk_bytes).cast("int")), one)).otherwise(F.array().cast("array<long>"))


def _owner(counts: Column, rank: Column) -> Column:
    """The chunk whose boundaries include the ``rank``-th (from 1) and its rank there, by prefix sums."""
    zero = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("chunk"), F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("rank"))

    def step(acc: Column, n: Column) -> Column:
        here = (acc["chunk"] < 0) & (acc["before"] + n >= rank)
        return F.struct(
            (acc["at"] + 1).alias("at"), F.when(here, acc["at"]).otherwise(acc["chunk"]).alias("chunk"),
            (acc["before"] + n).alias("before"), F.when(here, rank - acc["before"]).otherwise(acc["rank"]).alias("rank"),
        )

    return F.aggregate(counts, zero, step, lambda acc: F.struct(acc["chunk"].alias("chunk"), acc["rank"].alias("rank")))


def _place(data: Column, size: Column, rank: Column, n: Column, owner: Column, chunk_bytes: int) -> Column:
    """Byte where the ``rank``-th unit ends: only the owning chunk is scanned."""
    start = owner["chunk"] * chunk_bytes
    chunk = F.substring(data, start + 1, F.lit(chunk_bytes)).cast("string")
    before = F.call_function("substring_index", chunk, F.lit("\n"), owner["rank"].cast("int"))
    return F.when(rank == 0, 0).when(rank == n, size).otherwise(start + F.octet_length(before) + 1).cast("int")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, wherever the optimizer moves or repeats the columns around it."""
    return F.transform(F.array(value), use)[0]


def _transformed(doc_id: Column, text: Column, seed: str, rate: int, spm: int, chunk_bytes: int) -> Column:
    """The struct n, form, prefix_chars, middle_chars, output of one text."""
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.conv(F.substring(digest, 1 + 8 * i, F.lit(8)), 16, 10).cast("long"))

    def drawn(n: Column) -> Column:
        form = lambda h: F.when((n == 0) | marked | (h[2] % 100 >= rate), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
        return _let(h, lambda h: F.struct(form(h).alias("form"), F.least(h[0] % (n + 1), h[1] % (n + 1)).alias("first"), F.greatest(h[0] % (n + 1), h[1] % (n + 1)).alias("second")))

    def joined(n: Column, form: Column, parts: Column) -> Column:
        p, m, s = parts["p"], parts["m"], parts["s"]
        psm = F.concat(F.lit(PREFIX), p, F.lit(SUFFIX), s, F.lit(MIDDLE), m)
        spm_text = F.concat(F.lit(SUFFIX), s, F.lit(PREFIX), p, F.lit(MIDDLE), m)
        whole = F.when(form == "psm", psm).when(form == "spm", spm_text).otherwise(text)
        chars = lambda x: F.when(form != "plain", F.char_length(x).cast("long"))
        return F.struct(n.alias("n"), form.alias("form"), chars(p).alias("prefix_chars"), chars(m).alias("middle_chars"), whole.alias("output"))

    def cut(data: Column, size: Column, counts: Column, n: Column, draw: Column) -> Column:
        place = lambda rank: _let(_owner(counts, rank), lambda owner: _place(data, size, rank, n, owner, chunk_bytes))
        parts = lambda at: F.struct(_text(data, F.lit(0), at["first"]).alias("p"), _text(data, at["first"], at["second"] - at["first"]).alias("m"), _text(data, at["second"], size - at["second"]).alias("s"))
        return _let(F.struct(place(draw["first"]).alias("first"), place(draw["second"]).alias("second")), lambda at: _let(parts(at), lambda x: joined(n, draw["form"], x)))

    def counted(data: Column) -> Column:
        size = F.octet_length(data)
        n = lambda counts: F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
        return _let(_counts(data, size, chunk_bytes), lambda counts: _let(n(counts), lambda n: _let(drawn(n), lambda draw: cut(data, size, counts, n, draw))))

    return _let(text.cast("binary"), counted)


def transform(docs: DataFrame, seed: str = "7", rate: int = 100, spm: int = 50, chunk_bytes: int = 1 << 14) -> DataFrame:
    """doc_id, n, form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and the transformed text ``output``."""
    rows = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    made = rows.select("doc_id", _transformed(F.col("doc_id"), F.col("text"), seed, rate, spm, chunk_bytes).alias("made"))
    return made.select("doc_id", "made.n", "made.form", "made.prefix_chars", "made.middle_chars", "made.output")


def restored(output: Column, form: Column) -> Column:
    """The exact text from a transformed one: each sentinel stands in it once, so that what lies between them is the text."""
    tail = lambda x, mark: F.substring_index(x, mark, -1)
    head = lambda x, mark: F.substring_index(x, mark, 1)

    def rebuilt(body: Column) -> Column:  # without the first sentinel
        spm_text = _let(tail(body, PREFIX), lambda rest: F.concat(head(rest, MIDDLE), tail(rest, MIDDLE), head(body, PREFIX)))
        psm = _let(tail(body, SUFFIX), lambda rest: F.concat(head(body, SUFFIX), tail(rest, MIDDLE), head(rest, MIDDLE)))
        return F.when(form == "psm", psm).otherwise(spm_text)

    return F.when(form == "plain", output).otherwise(_let(F.substr(output, F.lit(len(PREFIX) + 1)), rebuilt))


def digests(docs: DataFrame, **how) -> DataFrame:
    """Of each transformed text its digest, and that of the text rebuilt from output and form."""
    rows = transform(docs, **how)
    return rows.withColumn("output_sha256", F.sha2("output", 256)).withColumn("restored_sha256", F.sha2(restored(F.col("output"), F.col("form")), 256)).drop("output")
