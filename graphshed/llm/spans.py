"""Spans of pattern matches, with positions, from built-in functions only, in time linear in text and matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:int,stop:int,match:string,before:string>>"
#: Code points before a match that are kept with it.
BEFORE = 40
#: Values that one fold lists: a fold copies its list at each step, so long lists are made of short ones.
BLOCK = 64
#: Code points of the parts a text is cut into to be read anywhere.
CHUNK = 256


def none() -> Column:
    return F.array().cast(SPAN)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is worked out once, wherever the body has it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, zero: Column, joined: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """The running results of an associative function: ``zero``, then one for each value.

    Blocks of BLOCK values are folded apart, then what each block begins with
    the same way.
    """

    def folded(part: Column) -> Column:
        return F.aggregate(part, F.array(zero), lambda made, x: F.concat(made, F.array(joined(F.element_at(made, -1), x))))

    if not levels:
        return folded(values)

    def blocks(all_: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(BLOCK))
        return let(F.transform(firsts, lambda first: folded(F.slice(all_, first, F.lit(BLOCK)))), lambda runs: F.concat(F.array(zero), moved(runs)))

    def moved(runs: Column) -> Column:
        begins = running(F.transform(runs, lambda r: F.element_at(r, -1)), zero, joined, levels - 1)
        return F.flatten(F.zip_with(runs, F.slice(begins, F.lit(1), F.size(runs)), lambda r, begin: F.transform(F.slice(r, F.lit(2), F.size(r)), lambda x: joined(begin, x))))

    return let(values, blocks)


def sums(values: Column) -> Column:
    return running(values, F.lit(0), lambda a, b: a + b)


def find(text: Column, kind: str, pattern: str, tail_group: int = 0) -> Column:
    """All leftmost non-overlapping matches: kind, start, stop (code points, exclusive), the matched text and what stands before it, back to the last match and BEFORE code points at most.

    The gaps between matches come from ``split`` with the same pattern; their
    lengths and those of the matches add up to the positions. The pattern may
    not match empty text. With ``tail_group`` the text of that group is added
    to ``match`` (a lookahead), while start and stop are those of the match.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.zip_with(F.split(text, pattern, -1), matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match"), F.length(match).alias("n")))
    if tail_group:
        tails = F.regexp_extract_all(text, F.lit(pattern), F.lit(tail_group))
        gaps = F.zip_with(gaps, tails, lambda x, tail: F.struct(x["gap"].alias("gap"), F.concat(x["match"], tail).alias("match"), x["n"].alias("n")))

    def span(x: Column, at: Column) -> Column:
        start = at + F.length(x["gap"])
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + x["n"]).alias("stop"), x["match"].alias("match"), F.right(x["gap"], F.lit(BEFORE)).alias("before"))

    def placed(found: Column) -> Column:
        ends = sums(F.transform(found, lambda x: F.length(x["gap"]) + x["n"]))
        return F.when(F.size(found) == 0, none()).otherwise(F.zip_with(found, F.slice(ends, F.lit(1), F.size(found)), span).cast(SPAN))

    # What follows the last match has no match of its own.
    return let(gaps, lambda all_: let(F.slice(all_, F.lit(1), F.size(all_) - 1), placed))


def chunks(text: Column) -> Column:
    """The text in parts of CHUNK code points."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))


def between(parts: Column, start: Column, stop: Column) -> Column:
    """The text from start to stop (exclusive), read from its chunks."""
    first = F.floor(start / CHUNK).cast("int")
    read = F.array_join(F.slice(parts, first + 1, F.floor(stop / CHUNK).cast("int") - first + 1), "")
    return F.when(stop <= start, F.lit("")).otherwise(F.substr(read, start % CHUNK + 1, stop - start))


def written(spans: Column) -> Column:
    """kind:start:end of the spans as they stand, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def apart(spans: Column, others: Column) -> Column:
    """The spans (ordered, not overlapping each other) that overlap none of the others.

    All are put in one order; the largest end of the others so far and the
    least beginning of those still to come decide.
    """
    far = F.lit(2**31 - 1)
    mark = lambda own: lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s["stop"].alias("stop"))
    merged = F.array_sort(F.concat(F.transform(others, mark(False)), F.transform(spans, mark(True))))

    def decided(row: Column) -> Column:
        reached = running(F.transform(row, lambda x: F.when(x["own"], F.lit(0)).otherwise(x["stop"])), F.lit(0), F.greatest)
        coming = F.reverse(running(F.transform(F.reverse(row), lambda x: F.when(x["own"], far).otherwise(x["start"])), far, F.least))
        fits = F.zip_with(
            F.zip_with(row, F.slice(reached, F.lit(1), F.size(row)), lambda x, end: F.struct(x["own"].alias("own"), (end <= x["start"]).alias("free"), x["stop"].alias("stop"))),
            F.slice(coming, F.lit(2), F.size(row)),
            lambda x, begin: F.struct(x["own"].alias("own"), (x["free"] & (begin >= x["stop"])).alias("free")),
        )
        own = F.filter(fits, lambda x: x["own"])
        kept = F.filter(F.zip_with(spans, own, lambda s, x: F.struct(s.alias("span"), x["free"].alias("free"))), lambda x: x["free"])
        return F.transform(kept, lambda x: x["span"])

    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(let(merged, decided))
