"""Spans of text as column expressions: where patterns match, in code points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTEXT = 40
BLOCK = 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use).getItem(0)


def running(items: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """A number folded along an array, as it stands after each item, in blocks, so that no growing array is copied per
    item. ``items`` is a column or a variable: an expression would be worked out for every block."""

    def block(state: Column, at: Column) -> Column:
        return F.aggregate(
            F.slice(items, at * BLOCK + 1, F.lit(BLOCK)),
            F.struct(state.alias("state"), F.array().cast("array<int>").alias("all")),
            lambda a, x: F.struct(step(a["state"], x).alias("state"), F.array_append(a["all"], step(a["state"], x)).alias("all")),
        )

    blocks = F.ceil(F.size(items) / BLOCK).cast("int")
    return F.aggregate(
        F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1),
        F.struct(zero.alias("state"), F.array().cast("array<array<int>>").alias("all")),
        lambda a, at: let(
            block(a["state"], at),
            lambda b: F.struct(b["state"].alias("state"), F.array_append(a["all"], b["all"]).alias("all")),
        ),
        lambda a: F.flatten(a["all"]),
    )


NONE = "array<struct<start: int, end: int, match: string, before: string>>"


def find(text: Column, pattern: str, needs: Column) -> Column:
    """``start, end, match, before`` of every match, leftmost and not overlapping: ``before`` is the
    text just before it, back to the last match. Looked for only where ``needs`` holds."""

    def placed(matches: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        both = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
        return let(
            both,
            lambda pairs: F.zip_with(
                pairs,
                running(pairs, F.lit(0), lambda at, x: at + F.length(x["p"]) + F.length(x["m"])),
                lambda x, end: F.struct(
                    (end - F.length(x["m"])).alias("start"),
                    end.alias("end"),
                    x["m"].alias("match"),
                    F.right(x["p"], F.lit(CONTEXT)).alias("before"),
                ),
            ),
        )

    none = F.array().cast(NONE)
    found = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none)
    )
    return F.when(needs, found).otherwise(none)


# Pieces of a text that are cheap to walk.
PIECE = 1024


def cut(text: Column) -> Column:
    """The text in pieces, so that a part of it is taken without walking all that lies before."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}+"), F.lit(0))


def part(pieces: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to before ``end`` of a text that was ``cut``."""
    first = F.floor(start / PIECE).cast("int")
    some = F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1)
    return F.substring(F.array_join(some, ""), start - first * PIECE + 1, end - start)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def tagged(found: Column, kind: str, rank: int) -> Column:
    """Spans with what they sort by: ``start, rank, kind, end``."""
    return F.transform(
        found,
        lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")),
    )


def written(spans: Column) -> Column:
    """``kind:start:end``, in order, joined by commas."""
    one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


def counted(spans: str, kind: str) -> Column:
    """How many of a column's spans are of a kind."""
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint")
