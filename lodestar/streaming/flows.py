"""Streams between tables; each runs over everything available and stops."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestar.names import column, fresh
from lodestar.operators.quality import expect_all_or_drop
from lodestar.operators.scd2 import check_sequence, scd2_apply, scd2_create
from lodestar.operators.segments import MAX_GROUP_ROWS
from lodestar.scratch import PACKED
from lodestar.sources.ingest import ALL_AGES


def start_append(
    rows: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Start appending a stream to a Parquet folder, exactly once."""
    writer = rows.writeStream.format("parquet").options(**PACKED).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> dict:
    """Append what is available; return the last progress."""
    query = start_append(rows, path, checkpoint, partition_by)
    query.awaitTermination()
    return query.lastProgress


def table_stream(spark: SparkSession, name: str) -> DataFrame:
    """A table as a stream of the rows appended to it, however old their files are."""
    return spark.readStream.options(**ALL_AGES).table(name)


def staged(stream: DataFrame, rules: Mapping[str, str], observe_as: str = "expectations") -> DataFrame:
    """The rows of a stream that pass every rule; failures are counted in its progress."""
    return expect_all_or_drop(stream, rules, observe_as)


def for_each_batch(
    stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str
) -> dict:
    """Run ``apply`` on each micro-batch of what is available; return the last progress."""
    query = (
        stream.writeStream.foreachBatch(apply)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query.lastProgress


def apply_changes_stream(
    spark: SparkSession,
    changes: DataFrame,
    name: str,
    path: str,
    checkpoint: str,
    *,
    key: Sequence[str],
    sequence_by: str,
    track: Sequence[str] | None = None,
    arrival: Sequence[str] = (),
    buckets: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> dict:
    """Apply a stream of changes to a type 2 dimension; return the last progress.

    The batch number of the stream numbers the change log, so a batch that is
    replayed after a failure replaces itself there and ends in the same table.
    The table exists afterwards, even if the stream had no rows.
    """
    check_sequence(key, sequence_by)
    scd2_create(
        spark, name, path, changes.schema, key=key, sequence_by=sequence_by, track=track,
        arrival=arrival, buckets=buckets,
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        scd2_apply(
            batch.sparkSession,
            name,
            batch,
            path,
            key=key,
            sequence_by=sequence_by,
            track=track,
            arrival=arrival,
            batch_id=batch_id,
            buckets=buckets,
            max_group_rows=max_group_rows,
        )

    return for_each_batch(changes, apply, checkpoint)


def without_repeats(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """A stream without rows that repeat the keys of another one within ``delay`` of event time.

    The keys seen are Spark's keyed state, which survives a restart with the checkpoint. A key is
    forgotten when the watermark (the greatest event time less ``delay``) has passed it. Rows older
    than the watermark cannot be told from repeats any more and are dropped, as are rows without
    an event time.
    """
    at = fresh("_event_time", stream.columns)
    # a watermark wants a timestamp with zone, whatever kind of time the rows have
    timed = stream.withColumn(at, column(event_time).cast("timestamp")).where(F.col(at).isNotNull())
    return timed.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys)).drop(at)


def dedup_append(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str, path: str, checkpoint: str
) -> dict[str, int]:
    """Append what is available without repeats; how many rows were read, repeated, late and written."""
    query = start_append(without_repeats(stream, keys, event_time, delay), path, checkpoint)
    query.awaitTermination()
    counts = dict.fromkeys(("read", "repeated", "late"), 0)
    for progress in query.recentProgress:
        counts["read"] += progress.numInputRows
        for state in progress.stateOperators:
            counts["late"] += state.numRowsDroppedByWatermark
            counts["repeated"] += state.customMetrics.get("numDroppedDuplicateRows", 0)
    return counts
