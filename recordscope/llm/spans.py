"""Positions of pattern matches in texts, in SQL functions only.

Patterns are written with possessive quantifiers where nothing after them could need what they hold: matches are the same, and
Java's matcher neither backtracks nor grows its stack on very long runs. Running positions are summed block by block, so the time
of a text grows with its matches and not with their square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Items of a block of ``running``; arrays that grow step by step stay this short.
BLOCK = 256
#: Characters kept before and after a match.
BEFORE = 40
AFTER = 8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(items: Column, zero: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """For each item of an array the fold of the items before it, beginning with ``zero``.

    The fold at each block's first item comes first, then the folds inside the blocks, and the blocks are flattened.
    """
    block = lambda xs, b: F.slice(xs, b * BLOCK + 1, F.lit(BLOCK))
    after = lambda part, at: F.aggregate(part, at, fold)

    def grow(part: Column, at: Column) -> Column:
        step = lambda s, x: F.struct(fold(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(part, F.struct(at.alias("at"), F.slice(F.array(at), 1, 0).alias("out")), step, lambda s: s["out"])

    def blocks(xs: Column) -> Column:
        number = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int"))
        first = F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out"))
        step = lambda s, b: F.struct(after(block(xs, b), s["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        starts = F.aggregate(number, first, step, lambda s: s["out"])
        many = F.flatten(F.transform(starts, lambda at, b: grow(block(xs, b), at)))
        return F.when(F.size(xs) <= BLOCK, grow(xs, zero)).otherwise(many)

    return let(items, blocks)


def find_spans(text: Column, pattern: str, ok=None, only_if: Column | None = None, around: bool = False) -> Column:
    """Array of (start, end, hit) of the leftmost non-overlapping matches, in code points, end exclusive; ``ok(hit)`` filters.

    The text between matches comes from ``split`` with the same pattern, so running lengths give the positions. ``only_if`` is a
    cheap test that every text with a match passes. ``around`` adds the fields before and after: up to ``BEFORE`` characters that
    stand before the match and up to ``AFTER`` between it and the next one.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tail = lambda c: F.when(F.length(c) > BEFORE, F.right(c, F.lit(BEFORE))).otherwise(c)
    ends = lambda p: [tail(p).alias("tail"), F.substring(p, 1, AFTER).alias("head")] if around else []
    # only the lengths of the gaps (and their ends) are kept; the last piece has no match after it
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.struct(F.length(p).alias("n"), *ends(p)))
    join = lambda h, g: F.struct(h.alias("hit"), g.alias("gap"))
    known = lambda xs: F.filter(xs, lambda x: x["hit"].isNotNull())
    if around:
        follow = lambda x, g: F.struct(x["hit"].alias("hit"), x["gap"].alias("gap"), F.coalesce(g["head"], F.lit("")).alias("next"))
        items = let(gaps, lambda gs: known(F.zip_with(F.zip_with(hits, gs, join), F.slice(gs, F.lit(2), F.size(gs)), follow)))
    else:
        items = known(F.zip_with(hits, gaps, join))
    zero = F.struct(F.lit(0).alias("at"), *([F.lit("").alias("tail")] if around else []))
    ahead = lambda s, x: tail(F.concat(s["tail"], x["gap"]["tail"]))

    def fold(s: Column, x: Column) -> Column:
        more = [tail(F.concat(ahead(s, x), x["hit"])).alias("tail")] if around else []
        return F.struct((s["at"] + x["gap"]["n"] + F.length(x["hit"])).alias("at"), *more)

    def one(x: Column, s: Column) -> Column:
        start = s["at"] + x["gap"]["n"]
        more = [ahead(s, x).alias("before"), x["next"].alias("after")] if around else []
        return F.struct(start.alias("start"), (start + F.length(x["hit"])).alias("end"), x["hit"].alias("hit"), *more)

    found = let(items, lambda xs: F.zip_with(xs, running(xs, zero, fold), one))
    if ok is not None:
        found = F.filter(found, lambda s: ok(s["hit"]))
    if only_if is None:
        return found
    none = F.array().cast(f"array<struct<start:int,end:int,hit:string{',before:string,after:string' if around else ''}>>")
    return F.when(only_if, found).otherwise(none)


def masked(text: Column, spans: Column, mark: str) -> Column:
    """Text with the union of ``spans`` (ordered by start, with start and end) replaced by ``mark``.

    A text is cut into one piece for every ``BLOCK`` spans first, so no character is walked once for each span.
    """
    ends = lambda xs: running(xs, F.lit(0), lambda e, x: F.greatest(e, x["end"]))
    # a span that begins before an earlier one ends adds no mark; the text before each mark begins where the spans so far end
    cut = lambda x, e: F.struct(e.alias("from"), x["start"].alias("to"), x["end"].alias("end"))
    marks = F.filter(F.zip_with(spans, ends(spans), cut), lambda c: c["to"] >= c["from"])
    last = F.aggregate(spans, F.lit(0), lambda e, x: F.greatest(e, x["end"]))

    def pieces(cuts: Column) -> Column:
        number = F.sequence(F.lit(0), F.floor((F.size(cuts) - 1) / BLOCK).cast("int"))

        def block(b: Column) -> Column:
            def inside(part: Column) -> Column:
                first = F.get(part, F.lit(0))["from"]
                whole = F.substring(text, first + 1, F.element_at(part, -1)["to"] - first)
                return let(whole, lambda t: F.transform(part, lambda c: F.substring(t, c["from"] - first + 1, c["to"] - c["from"])))

            return let(F.slice(cuts, b * BLOCK + 1, F.lit(BLOCK)), inside)

        return F.flatten(F.transform(number, block))

    rest = F.substring(text, last + 1, F.length(text))
    joined = let(marks, lambda cuts: F.array_join(F.concat(pieces(cuts), F.array(rest)), mark))
    return F.when(F.size(spans) > 0, joined).otherwise(text)


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check: from the right, every second digit doubled."""
    n = F.length(digits)

    def value(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.pmod(n - i, F.lit(2)) == 1
        return F.when(twice & (d >= 5), 2 * d - 9).when(twice, 2 * d).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + value(i))
    return F.when(n > 0, F.pmod(total, F.lit(10)) == 0).otherwise(F.lit(False))


def described(kind: str, spans: Column) -> Column:
    """Texts ``kind:start:end`` of an array of spans."""
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))
