"""Text functions as Columns: numbers, tokens, tables, slugs, dates and labels. Nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number, a word, a page footer, an empty code fence (Java syntax).
NUMBER = r"(?<![A-Za-z])\p{Nd}[\p{Nd},]*(?:\.\p{Nd}+)?"
WORD = r"[A-Za-z]+(?:[-'][A-Za-z]+)*|\p{Nd}[\p{Nd},]*(?:\.\p{Nd}+)?"
PAGE_FOOTER = r"(?imd)^[ \t]*(?:\*\*|__)?page[ \t]+\p{Nd}+[ \t]+of[ \t]+\p{Nd}+(?:\*\*|__)?[ \t]*$"
EMPTY_FENCE = r"(?U)\A\s*```[^\n]*\n\s*```\s*\z"
SPACE_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
REPLACEMENT = "�"


def stripped(t: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(t, SPACE_ENDS, "")


def is_blank(t: Column) -> Column:
    return stripped(F.coalesce(t, F.lit(""))) == ""


def plain_numbers(t: Column) -> Column:
    """Numbers as written, thousands commas removed, in order."""
    return F.transform(F.regexp_extract_all(t, F.lit(NUMBER), F.lit(0)), lambda x: F.replace(x, F.lit(","), F.lit("")))


#: Pieces of a text: ``](``, a bracket or parenthesis, or what stands between them.
_PIECES = r"\]\(|[\[\]()]|[^\[\]()]++"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _two(high: Column, low: Column) -> Column:
    return F.shiftleft(high.cast("long"), 32) + low.cast("long")


_high = lambda x: F.shiftright(x, 32).cast("int")
_low = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")


def _emitted(items: Column, zero: Column, step, block: int = 128) -> Column:
    """Longs that a fold emits: ``step`` gives a struct of the next state ``s`` and what is emitted, ``out`` (null: nothing). Spark copies a
    fold's state at every item, so that items are folded in blocks, and only blocks meet the whole list."""
    none = F.array().cast("array<long>")

    def inner(a: Column, item: Column) -> Column:
        return _let(step(a["s"], item), lambda r: F.struct(r["s"].alias("s"), F.when(r["out"].isNull(), a["found"]).otherwise(F.concat(a["found"], F.array(r["out"]))).alias("found")))

    def outer(a: Column, items: Column) -> Column:
        return _let(F.aggregate(items, F.struct(a["s"].alias("s"), none.alias("found")), inner), lambda r: F.struct(r["s"].alias("s"), F.concat(a["found"], r["found"]).alias("found")))

    blocks = F.transform(F.sequence(F.lit(0), ((F.size(items) - 1) / block).cast("int")), lambda i: F.slice(items, i * block + 1, F.lit(block)))
    return F.aggregate(blocks, F.struct(zero.alias("s"), none.alias("found")), outer, lambda a: a["found"])


def _targets(pieces: Column) -> Column:
    """(at, end) of each ``](`` whose parenthesis is closed, in order: indexes of both pieces. A fold over the pieces with a stack of the
    targets that are open; what is open inside one is a number beside it, so that the stack doesn't grow with it."""
    zero = F.struct(F.lit(0).alias("j"), F.lit(False).alias("escaped"), F.array().cast("array<long>").alias("stack"))

    def step(s: Column, piece: Column) -> Column:
        stack, top, plain = s["stack"], F.element_at(s["stack"], -1), ~s["escaped"] & (F.size(s["stack"]) > 0)
        below = F.slice(stack, 1, F.size(stack) - 1)
        closes = plain & (piece == ")")
        after = F.when(piece == "](", F.concat(stack, F.array(_two(s["j"], F.lit(0))))).when(plain & (piece == "("), F.concat(below, F.array(top + 1))).when(closes, F.when(_low(top) > 0, F.concat(below, F.array(top - 1))).otherwise(below)).otherwise(stack)
        out = F.when(closes, F.when(_low(top) == 0, _two(_high(top), s["j"])))
        return F.struct(F.struct((s["j"] + 1).alias("j"), piece.endswith("\\").alias("escaped"), after.alias("stack")).alias("s"), out.alias("out"))

    return F.sort_array(_emitted(pieces, zero, step))


def _links(pieces: Column, targets: Column) -> Column:
    """(index of the opening piece, number of the target) of the links from left to right: the first ``[`` that isn't inside an earlier link,
    with the first ``](`` after it. If that isn't closed, no ``[`` before it begins a link."""
    zero = F.struct(F.lit(0).alias("j"), F.lit(-1).alias("open"), F.lit(-1).alias("end"), F.lit(0).alias("next"))

    def step(s: Column, piece: Column) -> Column:
        j, target = s["j"], F.get(targets, s["next"])
        free, close = j > s["end"], piece == "]("
        closed = close & F.coalesce(_high(target) == j, F.lit(False))
        link = free & closed & (s["open"] >= 0)
        opened = F.when(link | (free & close & ~closed), -1).when(free & (piece == "[") & (s["open"] < 0), j).otherwise(s["open"])
        after = F.struct((j + 1).alias("j"), opened.alias("open"), F.when(link, _low(target)).otherwise(s["end"]).alias("end"), (s["next"] + closed.cast("int")).alias("next"))
        return F.struct(after.alias("s"), F.when(link, _two(s["open"], s["next"])).alias("out"))

    return _emitted(pieces, zero, step)


def without_links(t: Column) -> Column:
    """Links ``[label](target)`` as their labels. A label ends at the first ``](``; parentheses in a target are balanced to any depth, those
    after a backslash don't count; what is not closed stays as it is. The work grows with the text and, per piece, with
    the targets that are open there."""

    def shown(pieces: Column, targets: Column, links: Column) -> Column:
        between = lambda start, stop: F.array_join(F.slice(pieces, start + 1, F.greatest(stop - start, F.lit(0))), "")
        before = lambda k: F.coalesce(_low(F.get(targets, _low(F.get(links, k - 1)))), F.lit(-1)) + 1
        parts = F.transform(links, lambda x, k: F.concat(between(before(k), _high(x)), between(_high(x) + 1, _high(F.get(targets, _low(x))))))
        return F.concat(F.array_join(parts, ""), between(before(F.size(links)), F.size(pieces)))

    resolved = _let(F.regexp_extract_all(t, F.lit(_PIECES), F.lit(0)), lambda p: _let(_targets(p), lambda x: _let(_links(p, x), lambda links: shown(p, x, links))))
    return F.when(t.contains("]("), resolved).otherwise(t)


def numbers(t: Column) -> Column:
    """Numbers as written that a reader sees: targets of links don't count."""
    return plain_numbers(without_links(t))


def without_footers(t: Column) -> Column:
    return F.regexp_replace(t, PAGE_FOOTER, "")


def content_numbers(t: Column) -> Column:
    """Numbers that a reader sees outside standalone page-count lines."""
    return numbers(without_footers(t))


def word_tokens(t: Column) -> Column:
    """Words and numbers, lower-case, commas removed."""
    return F.transform(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda x: F.lower(F.replace(x, F.lit(","), F.lit(""))))


def same_multiset(a: Column, b: Column) -> Column:
    return F.array_sort(a) == F.array_sort(b)


def alphanumeric_ratio(t: Column) -> Column:
    """Letters and digits among the characters that aren't white space; 0 if there are none."""
    visible = F.length(F.regexp_replace(t, r"(?U)[\s\x1c-\x1f]", ""))
    return F.when(visible == 0, 0.0).otherwise(F.length(F.regexp_replace(t, r"[^\p{L}\p{N}]", "")) / visible)


def lines(t: Column) -> Column:
    return F.split(t, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")


def table_widths(t: Column) -> Column:
    """Cells of each line between pipes, rows of dashes and colons aside."""
    inner = F.transform(F.filter(F.transform(lines(t), stripped), lambda x: x.startswith("|") & x.endswith("|")), lambda x: F.substring(x, 2, F.greatest(F.length(x) - 2, F.lit(0))))
    cells = F.transform(inner, lambda x: F.split(x, r"\|", -1))
    rows = F.filter(cells, lambda c: ~F.forall(c, lambda x: F.regexp_replace(stripped(x), "[-:]", "") == ""))
    return F.transform(rows, lambda c: F.size(c).cast("long"))


def has_uneven_table(t: Column) -> Column:
    return F.size(F.array_distinct(table_widths(t))) > 1


def separator_rows(t: Column) -> Column:
    """Lines of pipes, dashes, colons and spaces that begin with a pipe and hold a dash."""
    return F.size(F.filter(lines(t), lambda x: stripped(x).startswith("|") & x.contains("-") & (F.regexp_replace(stripped(x), r"[|\-: ]", "") == ""))).cast("long")


def replacement_characters(t: Column) -> Column:
    return (F.length(t) - F.length(F.replace(t, F.lit(REPLACEMENT), F.lit("")))).cast("long")


def local_content_empty(text: Column, markdown: Column) -> Column:
    """No visible text: blank, and markdown blank or an empty code fence."""
    return is_blank(text) & (is_blank(markdown) | F.coalesce(markdown, F.lit("")).rlike(EMPTY_FENCE))


def slugify(t: Column, most: int = 60) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(t), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    s = F.regexp_replace(F.substring(s, 1, most), "-+$", "")
    return F.when(s == "", "document").otherwise(s)


def document_slug(date: Column, number: Column, record_id: Column, title: Column, subtype: Column, source_type: Column, digest: Column) -> Column:
    day = F.replace(stripped(F.coalesce(F.nullif(date, F.lit("")), F.lit("undated"))), F.lit(" "), F.lit(""))
    day = F.when(day == "", "undated").otherwise(day)
    no = stripped(F.coalesce(number, F.lit("")))
    no = F.when(no == "", F.element_at(F.split(F.coalesce(record_id, F.lit("")), "_"), -1)).otherwise(no)
    marked = F.when(no != "", F.concat(F.when(source_type == "questions_answers", "Q").otherwise("doc"), no))
    name = F.coalesce(F.nullif(title, F.lit("")), F.nullif(subtype, F.lit("")), F.lit("document"))
    return F.concat(F.concat_ws("_", day, marked, slugify(name, 70)), F.lit("__"), F.substring(digest, 1, 8))


def parse_date(t: Column) -> Column:
    """dd.mm.yyyy as yyyy-mm-dd, without a look at the calendar; '' otherwise."""
    p = F.split(stripped(F.coalesce(t, F.lit(""))), r"\.")
    fill = lambda x, n: F.when(F.length(x) >= n, x).otherwise(F.lpad(x, n, "0"))
    ok = (F.size(p) == 3) & F.forall(p, lambda x: x.rlike(r"\A\p{Nd}+\z"))
    return F.when(ok, F.concat_ws("-", fill(F.get(p, F.lit(2)), 4), fill(F.get(p, F.lit(1)), 2), fill(F.get(p, F.lit(0)), 2))).otherwise("")


def roman_value(t: Column) -> Column:
    """Decimal digits as they are, else a subtractive Roman numeral; null for anything else."""
    up = F.upper(t)
    value = lambda c: F.element_at(F.create_map(*[F.lit(x) for pair in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100), ("D", 500), ("M", 1000)) for x in pair]), c)
    digits = F.reverse(F.filter(F.split(up, ""), lambda x: x != ""))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("last"))
    total = F.aggregate(digits, start, lambda a, c: F.struct((a["total"] + F.when(value(c) < a["last"], -value(c)).otherwise(value(c))).alias("total"), value(c).alias("last")), lambda a: a["total"])
    return F.when(t.rlike(r"\A[0-9]+\z"), t.try_cast("long")).when(up.rlike(r"\A[IVXLCDM]+\z"), total.cast("long"))


def normal_session(value: Column, members: Column) -> Column:
    """A label that is Roman or decimal stays; else one member's name at its beginning goes, if just one result remains."""
    label = r"(?i)\A(?:[IVXLCDM]+|[0-9]+)\z"
    rests = F.array_distinct(F.filter(F.transform(F.filter(members, lambda m: (m != "") & value.startswith(m)), lambda m: F.substr(value, F.length(m) + 1)), lambda r: r.rlike(label)))
    return F.when(value.rlike(label), value).when(F.size(rests) == 1, F.get(rests, F.lit(0))).otherwise(value)


def language_of(labels: Column) -> Column:
    """en or hi if that is all the labels say, else und."""
    said = F.array_distinct(F.filter(F.transform(labels, lambda x: F.lower(stripped(x))), lambda x: x != ""))
    return F.when(said == F.array(F.lit("english")), "en").when(said == F.array(F.lit("hindi")), "hi").otherwise("und")


def language_hint(name: Column, labels: Column) -> Column:
    """en or hi if the words of a file name or its labels speak for one of them alone, else und."""
    words = F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit("[a-z]+|[ऀ-ॿ]+"), F.lit(0))
    said = F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda x: F.lower(stripped(x)))
    en, hi = F.array(*map(F.lit, ("english", "eng", "en"))), F.array(*map(F.lit, ("hindi", "hin", "hi")))
    native = F.array(*map(F.lit, ("हिंदी", "हिन्दी")))
    english = F.arrays_overlap(words, en) | F.arrays_overlap(said, en)
    hindi = F.arrays_overlap(words, F.concat(hi, native)) | F.arrays_overlap(said, hi)
    return F.when(english & ~hindi, "en").when(hindi & ~english, "hi").otherwise("und")


def question_number(x: Column) -> Column:
    """4455.0 as '4455'; other values as written."""
    return F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(x.cast("string"))


def first_value(values: Column) -> Column:
    """First value that isn't blank, trimmed; '' if there is none."""
    return F.coalesce(F.get(F.filter(F.transform(values, lambda x: stripped(F.coalesce(x, F.lit("")))), lambda x: x != ""), F.lit(0)), F.lit(""))


def table_rows(t: Column) -> Column:
    """Map of a table's numbered and total rows: lower-case first cell to cells; the last of a key wins."""
    own = F.filter(F.transform(lines(t), stripped), lambda x: x.startswith("|") & x.endswith("|"))
    cells = F.transform(own, lambda x: F.transform(F.split(F.substring(x, 2, F.greatest(F.length(x) - 2, F.lit(0))), r"\|", -1), lambda c: stripped(F.regexp_replace(c, "[*_`]", ""))))
    key = lambda c: F.lower(F.get(c, F.lit(0)))
    second = lambda c: F.lower(F.coalesce(F.get(c, F.lit(1)), F.lit("")))
    kept = F.filter(cells, lambda c: key(c).rlike(r"\A\p{Nd}+\z") | key(c).contains("total") | ((key(c) == "") & second(c).contains("total")))
    named = F.transform(kept, lambda c: F.struct(F.when(key(c) == "", "total").otherwise(key(c)).alias("key"), c.alias("cells")))
    return _let(named, lambda rows: F.map_from_entries(F.filter(rows, lambda x, i: ~F.exists(F.slice(rows, i + 2, F.size(rows)), lambda y: y["key"] == x["key"]))))


def table_cells(reference: Column, candidate: Column) -> Column:
    """(exact, expected) of a table's rows against those of a reference (entries of their map): cells that agree but for case, and all
    cells of the reference. Each table is parsed once."""
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    cells = _let(candidate, lambda c: F.flatten(F.transform(reference, lambda r: F.zip_with(r["value"], F.coalesce(F.try_element_at(c, r["key"]), F.array().cast("array<string>")), pair))))
    same = lambda xs: F.size(F.filter(xs, lambda x: F.lower(x["a"]).eqNullSafe(F.lower(x["b"])))).cast("long")
    return _let(cells, lambda xs: F.struct(same(xs).alias("exact"), F.size(F.filter(xs, lambda x: x["a"].isNotNull())).cast("long").alias("expected")))
