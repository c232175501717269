"""Ordered work over groups of any size.

A window puts each of its groups into one task. That is fine until one year,
customer or product holds a third of all rows. When a group is too large for
one task the rows are sorted globally by (group, order) instead, and the slices
of that sort, the *segments*, become part of the window key. What a window
misses at the start or end of a segment is small: only the first group of a
segment can continue from an earlier one, so at most one row per segment has to
be carried over, and that bounded table is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from lodestar.scratch import materialise

SEGMENT = "_segment"
POSITION = "_position"

# Rows of one group that a single task may sort (it spills beyond memory).
MAX_GROUP_ROWS = 5_000_000


@dataclass
class Layout:
    """Rows ready for a window over ``keys``; ``split`` tells whether segments are in use."""

    rows: DataFrame
    group: list[str]
    split: bool

    @property
    def keys(self) -> list[str]:
        return [*self.group, SEGMENT] if self.split else self.group


def same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """NULL-safe equality of two column lists."""
    return reduce(lambda a, b: a & b, (x.eqNullSafe(y) for x, y in zip(left, right)))


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group: one pass over the key columns, counted before the shuffle."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def sorted_segments(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort globally and store each row with its segment and its position there.

    The generated positions are written, not recomputed, so every reader and
    every retry sees the same ones. The sort is balanced when the complete
    ``order`` tells most rows apart.
    """
    row_id = "_row_id"
    placed = (
        df.orderBy(*order)
        .withColumn(row_id, F.monotonically_increasing_id())
        .withColumns(
            {
                # partition number in the upper bits, row number in the lower 33
                SEGMENT: F.shiftright(row_id, 33).cast("int"),
                POSITION: F.col(row_id).bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
        .drop(row_id)
    )
    return materialise(placed, "segments")


def lay_out(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    max_group_rows: int,
) -> Layout:
    """Keep groups whole when all of them fit a task, else cut the rows into segments."""
    group = list(group)
    if largest_group(df, group) <= max_group_rows:
        return Layout(df, group, split=False)
    rows = sorted_segments(df, [*(F.col(g).asc() for g in group), *order])
    return Layout(rows, group, split=True)


def hashable(kind: T.DataType) -> bool:
    """Whether Spark can hash values of the type; maps and variants it cannot."""
    text = kind.simpleString()
    return "map<" not in text and "variant" not in text


def by_segment() -> WindowSpec:
    """For boundary rows only: there is one row per segment, so the window stays small."""
    return Window.orderBy(SEGMENT)


def rows_at(rows: DataFrame, extreme: DataFrame) -> DataFrame:
    """The rows at the places listed in ``extreme``, one per segment."""
    return rows.join(F.broadcast(extreme), [SEGMENT, POSITION])


def last_place(rows: DataFrame) -> DataFrame:
    return rows.groupBy(SEGMENT).agg(F.max(POSITION).alias(POSITION))


def first_place(rows: DataFrame) -> DataFrame:
    return rows.groupBy(SEGMENT).agg(F.min(POSITION).alias(POSITION))


def attach(rows: DataFrame, carried: DataFrame, group: Sequence[str]) -> DataFrame:
    """Join what is carried into the segments; ``carried`` has at most one row per segment."""
    keys = [*group, SEGMENT]
    names = {k: f"_carried_{i}" for i, k in enumerate(keys)}
    carried = carried.withColumnsRenamed(names)
    matches = same([F.col(k) for k in keys], [F.col(names[k]) for k in keys])
    return rows.join(F.broadcast(carried), matches, "left").drop(*names.values())
