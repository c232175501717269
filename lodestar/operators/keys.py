"""Dense surrogate keys, and the new and known rows of a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lodestar.names import Plain, column
from lodestar.operators.segments import POSITION, SEGMENT, same, sorted_segments


def assign_surrogate_keys(
    df: DataFrame, key_columns: Sequence[str], start: int = 0, out: str = "surrogate_key"
) -> DataFrame:
    """Number the rows ``start + 1 ... start + n`` in the order of unique ``key_columns``.

    The rows are sorted in parallel and stored with their place; a row's key is
    the number of rows in earlier segments plus its own position.
    """
    rows = Plain(df.drop(column(out)))
    placed = sorted_segments(rows.df, [F.col(c).asc() for c in rows.all_of(key_columns)])
    # One row per segment, so this window without a partition stays small.
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(SEGMENT)
        .count()
        .select(SEGMENT, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    key = F.lit(start + 1).cast("bigint") + F.col("_offset") + F.col(POSITION)
    numbered = placed.join(F.broadcast(offsets), SEGMENT).withColumn("key", key)
    return rows.back(numbered.select(*rows.plain, "key"), out)


def max_key(dimension: DataFrame, key: str) -> int:
    """The greatest surrogate key, 0 for an empty dimension."""
    return dimension.agg(F.coalesce(F.max(column(key)), F.lit(0))).first()[0]


def split_new_existing(
    incoming: DataFrame, dimension: DataFrame, key: str, keep: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``incoming`` without and with a dimension row.

    Known rows get the ``keep`` columns of the dimension. Keys match NULL-safe.
    New rows are found against the known ones, not against the dimension: when
    a load is small both joins can broadcast it and the dimension is never
    shuffled. A dimension that repeats a key of the load is an error.
    """
    rows = Plain(incoming)
    mine, kept = rows.of(key), [f"kept{i}" for i in range(len(keep))]
    known = dimension.select(column(key).alias("known"), *(column(c).alias(k) for c, k in zip(keep, kept)))
    matches = same([F.col(mine)], [F.col("known")])
    loaded = rows.df.select(mine).distinct()
    repeated = known.select("known").join(loaded, matches, "left_semi").groupBy("known").count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"the dimension repeats the key {repeated['known']}")
    existing = rows.df.join(known, matches, "inner").drop("known")
    found = existing.select(F.col(mine).alias("known"))
    new = rows.df.join(found, matches, "left_anti")
    return rows.back(new), rows.back(existing, *keep)
