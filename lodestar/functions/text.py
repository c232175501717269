"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def part_at(column: str, delimiter: str, index: int) -> Column:
    """The 0-based part of a delimited string; NULL when there is no such part.

    ``get`` is used instead of ``[index]``, which raises under ANSI mode for a
    value without the delimiter.
    """
    return F.get(F.split(F.col(column), rf"\Q{delimiter}\E"), F.lit(index))


def joined_name(*columns: str) -> Column:
    """The parts separated by a space; NULL as soon as one part is NULL."""
    parts = [part for name in columns for part in (F.lit(" "), F.col(f"`{name.replace('`', '``')}`"))]
    return F.concat(*parts[1:])
