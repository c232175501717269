"""Positions of pattern matches in texts, by SQL functions alone.

``regexp_extract_all`` gives the matches and ``split`` the text between them;
the running sum of both lengths is where each match starts, in code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

SPANS = "array<struct<start:int,end:int,match:string>>"


def matches(text: Column, pattern: str, needs: Column | None = None, group: int = 0) -> Column:
    """All leftmost non-overlapping matches; ``needs`` is a cheap test they all imply."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return found if needs is None else F.when(needs, found).otherwise(F.array().cast("array<string>"))


#: Matches that are located in one go; more are located in blocks of blocks.
FEW = 64


def _folded(items: Column, state: Column, step: Callable[[Column, Column], Column], levels: int) -> Column:
    """``items`` folded by ``step`` into a state whose ``out`` is a list.

    A fold copies its state at every item, so a long list would cost the square of its
    length. In blocks, with lists of their own, it costs little more than its length.
    """
    empty = F.array().cast(SPANS)
    if levels == 1:
        return F.aggregate(items, state.withField("out", empty), step)
    size = F.greatest(F.ceil(F.pow(F.size(items), F.lit((levels - 1) / levels))).cast("int"), F.lit(1))
    blocks = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), size), lambda first: F.slice(items, first, size)
    )

    def whole_block(before: Column, block: Column) -> Column:
        inner = F.array(_folded(block, before, step, levels - 1))  # a list, so that it is computed once
        joined = F.transform(inner, lambda after: after.withField("out", F.concat(before["out"], after["out"])))
        return F.element_at(joined, 1)

    return F.aggregate(blocks, state.withField("out", empty), whole_block)


def located(
    text: Column,
    found: Column,
    pattern: str,
    valid: Callable[[Column], Column],
    taken: int | None = None,
) -> Column:
    """The valid ones of the matches ``found``, as structs of start, end and match.

    A pattern that takes only the first ``taken`` characters and looks ahead for the rest
    proposes matches that overlap; of valid ones that do, the first is given.
    """
    steps = F.zip_with(
        F.split(text, pattern, -1),
        found,
        lambda gap, match: F.struct(
            F.char_length(gap).alias("gap"),
            F.coalesce(F.char_length(match), F.lit(0)).alias("size"),
            match.alias("match"),
            (match.isNotNull() & valid(match)).alias("valid"),
        ),
    )

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + part["size"]
        at = end if taken is None else start + taken
        span = F.struct(start.alias("start"), end.alias("end"), part["match"].alias("match"))
        good = part["valid"] if taken is None else part["valid"] & (state["last"] <= start)
        return F.struct(
            at.alias("at"),
            (state["last"] if taken is None else F.when(good, end).otherwise(state["last"])).alias("last"),
            F.when(good, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"),
        )

    first = F.struct(F.lit(0).alias("at"), F.lit(0).alias("last"), F.array().cast(SPANS).alias("out"))
    return (
        F.when(F.size(found) > FEW, _folded(steps, first, step, 3)["out"])
        .when(F.size(found) > 0, _folded(steps, first, step, 1)["out"])
        .otherwise(F.array().cast(SPANS))
    )


#: Code points of the parts that a text with many matches is cut into.
PART = 1024


def parts_of(text: Column, many: Column) -> Column:
    """The text in parts of ``PART`` code points if there are ``many`` places to look at, else nothing.

    To find a place in a string Spark counts its characters from the beginning.
    """
    return F.when(many, F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PART}}}+"), F.lit(0)))


def excerpt(text: Column, parts: Column, begin: Column, length: Column) -> Column:
    """``length`` code points (a part at most) of ``text`` from ``begin`` on; ``parts`` are those of ``parts_of``."""
    first = F.floor(begin / PART).cast("int")
    two = F.concat_ws("", F.get(parts, first), F.get(parts, first + 1))
    return F.when(parts.isNull(), F.substring(text, begin + 1, length)).otherwise(
        F.substring(two, begin - first * PART + 1, length)
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
