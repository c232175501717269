"""Rankings within a partition, top rows per partition, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestar.names import Plain
from lodestar.operators.segments import (
    MAX_GROUP_ROWS,
    POSITION,
    SEGMENT,
    Layout,
    attach,
    by_segment,
    hashable,
    last_place,
    lay_out,
    rows_at,
)


def rank_within(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: str,
    tie_break: Sequence[str],
    *,
    descending: bool = True,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the named rankings of ``order_by`` within ``partition_by``.

    ``tie_break`` makes ``row_number`` repeatable. Where it leaves many rows of
    one value tied, a hash of the row keeps a split sort balanced.
    """
    rows = Plain(df)
    order_by = rows.of(order_by)
    value = F.col(order_by).desc() if descending else F.col(order_by).asc()
    ties = [F.col(c).asc() for c in rows.all_of(tie_break)]
    spread = [f.name for f in rows.df.schema.fields if hashable(f.dataType)]
    order = [value, *ties, *([F.xxhash64(*spread)] if spread else [])]
    layout = lay_out(rows.df, rows.all_of(partition_by), order, max_group_rows)
    local = _local_rankings(layout, value, ties)
    if layout.split:
        local = _globalise(layout, local, order_by)
    wanted = {"_row_number": row_number, "_rank": rank, "_dense_rank": dense_rank}
    names = {k: v for k, v in wanted.items() if v}
    # bigint, because a split group may hold more rows than an int can count
    ranked = local.select(*rows.plain, *(F.col(k).cast("bigint") for k in names))
    return rows.back(ranked, *names.values())


def _local_rankings(layout: Layout, value: Column, ties: Sequence[Column]) -> DataFrame:
    if layout.split:  # equal rows keep the order in which they were stored
        ties = [*ties, F.col(POSITION).asc()]
    # row_number comes first: its sort order also serves the two rankings of peers.
    rows = Window.partitionBy(*layout.keys).orderBy(value, *ties)
    peers = Window.partitionBy(*layout.keys).orderBy(value)
    return (
        layout.rows.withColumn("_row_number", F.row_number().over(rows))
        .withColumn("_rank", F.rank().over(peers))
        .withColumn("_dense_rank", F.dense_rank().over(peers))
    )


def _globalise(layout: Layout, local: DataFrame, order_by: str) -> DataFrame:
    """Turn rankings within a segment into rankings within the whole group."""
    group, value = F.struct(*layout.group), F.struct(order_by)
    first = layout.rows.where(F.col(POSITION) == 0).select(
        F.col(SEGMENT).alias("_first_segment"),
        group.alias("_first_group"),
        value.alias("_first_value"),
    )
    # The local rankings of a segment's last row tell how far its last group has come.
    last = rows_at(local, last_place(layout.rows)).select(
        SEGMENT,
        group.alias("_group"),
        value.alias("_value"),
        F.col("_row_number").alias("_rows"),
        F.col("_rank").alias("_last_rank"),
        F.col("_dense_rank").alias("_values"),
    )
    ends = last.join(F.broadcast(first), F.col(SEGMENT) == F.col("_first_segment"))

    same_group = F.col("_first_group").eqNullSafe(F.lag("_group").over(by_segment()))
    same_value = F.col("_first_value").eqNullSafe(F.lag("_value").over(by_segment()))
    ends = ends.withColumn("_continues", (same_group & same_value).cast("int"))
    # A value that continues from the segment before is not counted again.
    repeated = F.when(F.col("_first_group") == F.col("_group"), F.col("_continues")).otherwise(0)
    so_far = Window.partitionBy("_group").orderBy(SEGMENT)
    ends = ends.withColumns(
        {
            "_repeated": repeated,
            "_rows_so_far": F.sum("_rows").over(so_far),
            "_values_so_far": F.sum(F.col("_values") - repeated).over(so_far),
        }
    )
    begins_here = (F.col("_values") > 1) | (F.col("_repeated") == 0)
    began = F.when(begins_here, F.col("_rows_so_far") - F.col("_rows") + F.col("_last_rank"))
    ends = ends.withColumn("_began", began)
    ends = ends.withColumn("_peer_rank", F.last("_began", ignorenulls=True).over(so_far))
    before = F.lag(F.struct("_group", "_rows_so_far", "_values_so_far", "_peer_rank"))
    carried = ends.select(SEGMENT, "_continues", before.over(by_segment()).alias("_end")).select(
        SEGMENT, "_continues", "_end._group.*", "_end._rows_so_far", "_end._values_so_far", "_end._peer_rank"
    )

    rows = attach(local, carried.where("_rows_so_far IS NOT NULL"), layout.group)
    rows_before = F.coalesce("_rows_so_far", F.lit(0))
    continues = F.coalesce("_continues", F.lit(0))
    in_first_value = (continues == 1) & (F.col("_rank") == 1)
    return rows.withColumns(
        {
            "_row_number": rows_before + F.col("_row_number"),
            "_rank": F.when(in_first_value, F.col("_peer_rank")).otherwise(
                rows_before + F.col("_rank")
            ),
            "_dense_rank": F.coalesce("_values_so_far", F.lit(0)) + F.col("_dense_rank") - continues,
        }
    )


def top_within(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: str,
    tie_break: Sequence[str],
    n: int,
    *,
    descending: bool = True,
    row_number: str = "row_num_col",
) -> DataFrame:
    """The first ``n`` rows per partition.

    Catalyst limits each group to ``n`` rows before the shuffle, so a large
    group costs no more than a small one and needs no segments.
    """
    rows = Plain(df)
    order_by = rows.of(order_by)
    value = F.col(order_by).desc() if descending else F.col(order_by).asc()
    in_order = Window.partitionBy(*rows.all_of(partition_by)).orderBy(value, *rows.all_of(tie_break))
    numbered = rows.df.withColumn("number", F.row_number().over(in_order)).where(F.col("number") <= n)
    return rows.back(numbered.withColumn("number", F.col("number").cast("bigint")), row_number)


def dedup_latest(df: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest ``latest`` columns.

    The remaining columns break ties, so the survivor is always the same row.
    Only one row per key and map task is shuffled.
    """
    rows = Plain(df)
    keys, latest = rows.all_of(keys), rows.all_of(latest)
    others = [
        f.name
        for f in rows.df.schema.fields
        if f.name not in {*keys, *latest} and "map<" not in f.dataType.simpleString()
        and f.dataType.typeName() != "variant"
    ]
    in_order = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in [*latest, *others]))
    return rows.back(rows.df.withColumn("kept", F.row_number().over(in_order)).where("kept = 1").drop("kept"))
