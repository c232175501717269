"""Type 2 dimensions: one row per version of a business key.

A version runs from ``valid_from`` (its sequence value) to ``valid_to`` (the
next version's ``valid_from``, NULL for the current one). An event that changes
no tracked column opens no version. Events may arrive late and more than once,
so every batch goes to an append-only change log first, and the history of the
keys it touches is rebuilt from the log.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from lodestar.names import Plain, column, columns as named, fresh
from lodestar.operators.ranking import dedup_latest
from lodestar.operators.segments import (
    MAX_GROUP_ROWS,
    SEGMENT,
    attach,
    by_segment,
    first_place,
    last_place,
    lay_out,
    rows_at,
    same,
)
from lodestar.scratch import (
    delete_folder,
    discard,
    folder_exists,
    folder_names,
    materialise,
    rename_folder,
)
from lodestar.sources import tables

BATCH = "_batch"

# Batches of the log, beyond which all but the last are put into one.
COMPACT_AFTER = 64


def check_sequence(key: Sequence[str], sequence_by: str) -> None:
    if sequence_by.lower() in {k.lower() for k in key}:
        raise ValueError("sequence_by must differ from the key, else versions have no order")


def versions(
    changes: DataFrame,
    key: Sequence[str],
    sequence_by: str,
    track: Sequence[str],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The complete history of ``changes``, which holds one row per (key, sequence).

    Changes without a sequence value have no place in it and are left out.
    """
    check_sequence(key, sequence_by)
    rows = Plain(changes)
    sequence_by, group = rows.of(sequence_by), rows.all_of(key)
    tracked = F.struct(*rows.all_of(track))
    layout = lay_out(rows.df.where(F.col(sequence_by).isNotNull()), group, [F.col(sequence_by).asc()], max_group_rows)
    in_order = Window.partitionBy(*layout.keys).orderBy(sequence_by)
    events = layout.rows.withColumn("_previous", F.lag(tracked).over(in_order))
    if layout.split:
        # The first event of a segment follows the last one of the segment before.
        last = rows_at(layout.rows, last_place(layout.rows)).select(
            SEGMENT, F.lag(F.struct(*group, tracked.alias("_before"))).over(by_segment()).alias("_last")
        )
        events = attach(events, last.select(SEGMENT, "_last.*"), group)
        events = events.withColumn("_previous", F.coalesce("_previous", "_before"))
    opened = events.where(~F.col("_previous").eqNullSafe(tracked))
    opened = opened.withColumn("valid_to", F.lead(sequence_by).over(in_order))
    if layout.split:
        # The last version of a segment ends where the next segment opens one of the same key.
        first = rows_at(layout.rows, first_place(opened)).select(
            SEGMENT,
            F.lead(F.struct(*group, F.col(sequence_by).alias("_after"))).over(by_segment()).alias("_next"),
        )
        opened = attach(opened, first.select(SEGMENT, "_next.*"), group)
        opened = opened.withColumn("valid_to", F.coalesce("valid_to", "_after"))
    return opened.select(
        *(F.col(c).alias(name) for c, name in zip(rows.plain, rows.names) if c != sequence_by),
        F.col(sequence_by).alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def _touched_keys(
    batch: DataFrame, key: Sequence[str], sequence_by: str, track: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """The keys of a batch under ``names``, with ``clash``: a sequence value that has different values, if any."""
    value = F.struct(*named(track))
    at_key = [column(c).alias(n) for c, n in zip(key, names)]
    events = batch.groupBy(*at_key, column(sequence_by).alias("at")).agg(
        F.min(value).alias("low"), F.max(value).alias("high")
    )
    clash = F.max(F.when(~F.col("low").eqNullSafe(F.col("high")), F.col("at").cast("string")))
    return events.groupBy(*names).agg(clash.alias("clash"))


def _buckets_of(
    touched: DataFrame, names: Sequence[str], in_log: int, in_table: int | None
) -> tuple[list[int], list[int] | None]:
    """The buckets of log and table that hold touched keys; a clash is an error. One aggregation."""
    key = F.struct(*names)
    found = touched.agg(
        F.collect_set(tables.bucket_of(in_log, names)).alias("log"),
        F.collect_set(tables.bucket_of(in_table or 1, names)).alias("table"),
        F.max(F.when(F.col("clash").isNotNull(), F.to_json(F.struct(key.alias("key"), "clash")))).alias("clash"),
    ).first()
    if found["clash"] is not None:
        raise ValueError(f"one batch holds different values for {found['clash']}")
    return sorted(found["log"]), sorted(found["table"]) if in_table else None


def _tracked(
    columns: Sequence[str], key: Sequence[str], sequence_by: str, track: Sequence[str] | None, arrival: Sequence[str]
) -> list[str]:
    return list(track or [c for c in columns if c not in {*key, sequence_by, *arrival}])


@dataclass(frozen=True)
class Layout:
    """How the log of a dimension is kept: fixed when the dimension is created."""

    spread: int
    columns: str

    def to_json(self) -> str:
        return json.dumps({"spread": self.spread, "columns": self.columns})


#: Layouts read before, by the place they are kept at; one never changes.
_layouts: dict[str, Layout] = {}


def _written_columns(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def _layout(spark: SparkSession, name: str, path: str, schema: T.StructType, buckets: int | None) -> Layout:
    """The layout remembered beside the log; a first call fixes it, later ones must agree in types."""
    place = f"{path}/layout"
    known_layout = _layouts.get(place)
    if known_layout is not None and known_layout.columns == _written_columns(schema) and folder_exists(spark, place):
        return known_layout
    columns = _written_columns(schema)
    try:
        found = json.loads(spark.read.text(place, wholetext=True).first()[0])
    except AnalysisException:
        known = tables.bucketing(spark, name) if tables.exists(spark, name) else None
        spread = known[0] if known else 1 if tables.exists(spark, name) else buckets or 1
        made = Layout(spread, columns)
        spark.createDataFrame([(made.to_json(),)], "value string").coalesce(1).write.text(place)
        _layouts[place] = made
        return made
    layout = Layout(**found)
    if layout.columns != columns:
        raise ValueError(f"the changes have columns {columns}, the dimension has {layout.columns}")
    _layouts[place] = layout
    return layout


def scd2_create(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    *,
    key: Sequence[str],
    sequence_by: str,
    track: Sequence[str] | None = None,
    arrival: Sequence[str] = (),
    buckets: int | None = None,
) -> None:
    """Create the dimension without rows, unless it exists; ``schema`` is that of its changes."""
    if tables.exists(spark, name):
        return
    columns = [*key, sequence_by, *_tracked(schema.names, key, sequence_by, track, arrival)]
    empty = spark.createDataFrame([], schema).select(*named(columns))
    layout = _layout(spark, name, path, empty.schema, buckets)
    history = versions(empty, key, sequence_by, columns[len(key) + 1 :])
    tables.create(history, name, path, layout.spread if buckets else None, list(key))


def scd2_apply(
    spark: SparkSession,
    name: str,
    changes: DataFrame,
    path: str,
    *,
    key: Sequence[str],
    sequence_by: str,
    track: Sequence[str] | None = None,
    arrival: Sequence[str] = (),
    batch_id: int,
    buckets: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> None:
    """Apply one batch of changes to the dimension ``name`` (folder ``path``).

    Batches are numbered by the caller; a later batch wins over an earlier one
    for the same key and sequence, and a repeated number replaces that batch,
    so a batch can be replayed. Within a batch the row with the greatest
    ``arrival`` columns wins. Changes without a sequence value have no place in
    the history and are left out.

    ``buckets`` counts when the dimension is created: log and table are then
    read and written only where a batch has keys. Later calls use what was
    fixed then, whatever they pass.
    """
    check_sequence(key, sequence_by)
    key = list(key)
    track = _tracked(changes.columns, key, sequence_by, track, arrival)
    columns = [*key, sequence_by, *track]
    schema = changes.select(*named(columns)).schema
    scd2_create(
        spark, name, path, schema, key=key, sequence_by=sequence_by, track=track, buckets=buckets
    )
    layout = _layout(spark, name, path, schema, buckets)
    log, former = f"{path}/log", f"{path}/replaced/{BATCH}={batch_id}"
    folder = f"{log}/{BATCH}={batch_id}"

    rows = changes.where(column(sequence_by).isNotNull())
    if arrival:
        order = Window.partitionBy(*named(key), column(sequence_by)).orderBy(*(c.desc() for c in named(arrival)))
        arrived = fresh("_arrived", changes.columns)
        rows = rows.withColumn(arrived, F.rank().over(order)).where(F.col(arrived) == 1)
    rows = rows.select(*named(columns), tables.bucket_of(layout.spread, key).alias(tables.BUCKET))
    if layout.spread > 1:
        rows = rows.hint("rebalance", tables.BUCKET)
    if folder_exists(spark, folder):
        # Keys that only the former content of this batch had change too. They are kept until
        # the dimension is published, so a run that dies in between does not lose them.
        replaced = spark.read.schema(schema).parquet(folder).select(*named(key)).distinct()
        materialise(replaced, "replaced").write.mode("append").parquet(former)
    rows.write.mode("overwrite").partitionBy(tables.BUCKET).parquet(folder)
    folders = [T.StructField(BATCH, T.LongType()), T.StructField(tables.BUCKET, T.IntegerType())]
    logged = spark.read.schema(T.StructType([*schema.fields, *folders])).parquet(log)
    batch = logged.where(F.col(BATCH) == batch_id)
    names = [fresh(f"_touched{i}", columns) for i in range(len(key))]
    touched_keys = _touched_keys(batch, key, sequence_by, track, names)
    if folder_exists(spark, former):
        earlier = spark.read.schema(batch.select(*named(key)).schema).parquet(former).toDF(*names)
        touched_keys = touched_keys.unionByName(earlier.distinct(), allowMissingColumns=True)
    touched_keys = materialise(touched_keys, "touched-keys")
    # the table knows its own buckets, whatever those of the log are
    own = tables.bucketing(spark, name)
    in_log, in_table = _buckets_of(touched_keys, names, layout.spread, own[0] if own else None)
    touched_keys = touched_keys.drop("clash")
    if not in_log:
        return
    logged = logged.where(F.col(tables.BUCKET).isin(in_log))

    is_touched = same(named(key), [F.col(n) for n in names])
    relevant = logged.join(touched_keys, is_touched, "left_semi")
    latest = dedup_latest(relevant, [*key, sequence_by], [BATCH]).select(*named(columns))
    latest = materialise(latest, "scd2-touched")
    rebuilt = versions(latest, key, sequence_by, track, max_group_rows)
    untouched = tables.load(spark, name, only=in_table).join(touched_keys, is_touched, "left_anti")
    tables.replace(untouched.unionByName(rebuilt), name, path, touched=in_table)
    discard(latest, touched_keys)
    if folder_exists(spark, former):
        delete_folder(spark, former)
    if len(_batches(spark, log)) > COMPACT_AFTER:
        scd2_compact(spark, path, layout.spread, key, sequence_by, schema)


def _batches(spark: SparkSession, log: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in folder_names(spark, log) if name.startswith(f"{BATCH}="))


def scd2_compact(
    spark: SparkSession, path: str, spread: int, key: Sequence[str], sequence_by: str, schema: T.StructType
) -> None:
    """Put all batches of the log but the last into one, keeping the latest row of a key and sequence.

    The last one stays, as a stream may replay it; earlier ones can no longer be
    replaced afterwards. The new batch has a number below all others, so while
    old and new ones stand side by side, or after a crash, the history is the same.
    """
    log = f"{path}/log"
    *old, last = _batches(spark, log)
    if len(old) < 2:
        return
    number = min(old[0], 0) - 1
    folders = [T.StructField(BATCH, T.LongType()), T.StructField(tables.BUCKET, T.IntegerType())]
    logged = spark.read.schema(T.StructType([*schema.fields, *folders])).parquet(log)
    earlier = logged.where(F.col(BATCH) < last).drop(tables.BUCKET)
    rows = dedup_latest(earlier, [*key, sequence_by], [BATCH]).select(
        *named(schema.names), tables.bucket_of(spread, key).alias(tables.BUCKET)
    )
    # A batch counts as soon as its folder is there, so it is made complete elsewhere first.
    made = f"{path}/compacted/{BATCH}={number}"
    rows.hint("rebalance", tables.BUCKET).write.mode("overwrite").partitionBy(tables.BUCKET).parquet(made)
    rename_folder(spark, made, f"{log}/{BATCH}={number}")
    for batch in old:
        delete_folder(spark, f"{log}/{BATCH}={batch}")
