"""Counts per group that are kept up to date by the rows of each load.

The group of every key is remembered in a table in slices
(``lodestar.sources.slices``), of which a load reads only slices that may hold
its keys. A row of the load takes its key out of the group it was in and puts it
into the one it is in now; these signed changes are added up and merged into the
stored counts. Neither the rows counted before nor the table of groups are
scanned.

Counts carry the number of the last batch that they contain, so a batch that is
replayed is not added twice. They are published before the groups: a run that
dies in between is finished by its replay.

Within a load the row with the greatest ``latest`` columns counts for its key. A
NULL key counts for nothing, a NULL group is a group. Groups without keys left
are not kept. Batches come in ascending order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestar.names import column
from lodestar.operators.merge import upsert_pruned
from lodestar.operators.ranking import dedup_latest
from lodestar.scratch import discard, materialise
from lodestar.sources import slices, tables

BATCH = "_batch"
KEYS = "_keys"


def changes_of_counts(now: DataFrame, before: DataFrame) -> DataFrame:
    """``group`` and ``change``: what the keys of ``now`` add, and what they leave; both have key and group."""
    was = before.select(F.col("key").alias("old_key"), F.col("group").alias("old_group"))
    joined = now.join(was, F.col("key") == F.col("old_key"), "left")
    known = F.col("old_key").isNotNull()
    moved = joined.where(~known | ~F.col("group").eqNullSafe(F.col("old_group")))
    one = F.struct(F.col("group"), F.lit(1).alias("change"))
    other = F.struct(F.col("old_group").alias("group"), F.lit(-1).alias("change"))
    signed = moved.select(F.inline(F.when(known, F.array(one, other)).otherwise(F.array(one))))
    return signed.groupBy("group").agg(F.sum("change").alias("change")).where("change <> 0")


def update_counts(
    spark: SparkSession,
    name: str,
    path: str,
    rows: DataFrame,
    *,
    key: str,
    group: str,
    latest: Sequence[str] = (),
    batch_id: int,
    part_bytes: int = slices.SLICE_BYTES,
) -> None:
    """Count the keys of ``rows`` in the table ``name``, which has the groups and ``total``."""
    given = rows.where(column(key).isNotNull())
    one_each = dedup_latest(given, [key], latest).select(column(key).alias("key"), column(group).alias("group"))
    now = materialise(one_each, "counted")
    known = f"{name}{KEYS}"
    counted = tables.exists(spark, name)
    if not counted or (tables.load(spark, name).agg(F.max(BATCH)).first()[0] or -1) < batch_id:
        before = now.limit(0)
        if tables.exists(spark, known):
            held = slices.holding(spark, known, f"{path}/keys", slices.in_parts(now, ["key"], part_bytes), ["key"])
            before = slices.load(spark, known, held).drop(slices.SLICE)
        _merge(spark, name, path, changes_of_counts(now, before), group, counted, batch_id)
    upsert_pruned(spark, known, now, ["key"], f"{path}/keys", only_changed=["group"], part_bytes=part_bytes)
    discard(now)


def _merge(
    spark: SparkSession, name: str, path: str, changes: DataFrame, group: str, counted: bool, batch_id: int
) -> None:
    """Add changes to the stored counts, a row per group; a row without total holds the batch if there is no other."""
    if counted:
        old = tables.load(spark, name).where("total IS NOT NULL")
        old = old.select(column(group).alias("group"), F.col("total").alias("change"))
        changes = old.unionByName(changes).groupBy("group").agg(F.sum("change").alias("change")).where("change <> 0")
    batch = F.lit(batch_id).cast("bigint").alias(BATCH)
    totals = changes.select(F.col("group").alias(group), F.col("change").cast("bigint").alias("total"), batch)
    mark = spark.range(1).select(F.lit(None).cast(totals.schema[group].dataType).alias(group), F.lit(None).cast("bigint").alias("total"), batch)
    totals = totals.union(mark)
    if counted:
        tables.replace(totals, name, f"{path}/counts")
        tables.drop_old_versions(spark, name, f"{path}/counts")
    else:
        tables.create(totals, name, f"{path}/counts")


def read_counts(spark: SparkSession, name: str) -> DataFrame:
    """Groups and their totals."""
    return tables.load(spark, name).where("total IS NOT NULL").drop(BATCH)
