"""Type 2 dimensions into which late events are spliced, at the cost of the batch.

``scd2_apply`` rebuilds the whole history of each key that a batch touches. Here
events and versions are kept in sorted slices (``lodestar.sources.slices``), and
a batch reads only the slices its events fall into and their neighbours:

1. The batch is located among the slices of the events. A window per slice, with
   the last event of the slice before, tells which events open a version now and
   which did before. The difference is a list of versions to put and to remove:
   at most the event itself and the one after it, for each event of the batch.
2. These are located among the slices of the versions, and the versions before
   and after are cut: a version ends where the next one of its key begins.
3. Slices in which a row changed are written anew, versions first. Until the
   events are published too, a batch that is replayed finds the same difference,
   and to put or remove a version twice is the same as once.

No task holds more than a few slices, however many events a key has. A batch
that falls into most slices, or brings many times the size of a slice into one,
is not spliced: then everything is sorted anew, as for a first load.

For one key and sequence value a later batch wins, and a batch that repeats
itself changes nothing. Events without a sequence value are left out. Several
slices do not change at once for readers, and a new layout adds its slices
before it drops the old ones. Keys match NULL-safe.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lodestar.names import column, columns as named
from lodestar.operators.scd2 import check_sequence, versions
from lodestar.operators.segments import MAX_GROUP_ROWS, same
from lodestar.scratch import discard, materialise
from lodestar.sources import slices, tables
from lodestar.sources.slices import PART, POSITION, SLICE

#: Rows of a slice; one that grows to twice as many is cut.
SLICE_ROWS = 100_000
#: Rows that a task sorts when everything is laid out anew, of as many slices as that makes.
TASK_ROWS = 200_000
#: With more rows for one slice than so many slices hold, or more than this share of the slices, all is sorted anew.
NEW_SLICES, NEW_SHARE = 20, 0.5

BATCH = "_batch"
EVENTS = "_events"


@dataclass(frozen=True)
class Spliced:
    """What a batch cost: slices of events and versions that were read and written."""

    events_read: int = 0
    events_written: int = 0
    versions_read: int = 0
    versions_written: int = 0
    rebuilt: bool = False


@dataclass(frozen=True)
class _Shape:
    """Columns under plain names: keys, sequence and tracked ones."""

    key: list[str]
    sequence_by: str
    track: list[str]

    @property
    def k(self) -> list[str]:
        return [f"k{i}" for i in range(len(self.key))]

    @property
    def t(self) -> list[str]:
        return [f"t{i}" for i in range(len(self.track))]

    def plain(self, rows: DataFrame, at: str, *others: Column) -> DataFrame:
        return rows.select(
            *(column(c).alias(p) for c, p in zip(self.key, self.k)),
            column(at).alias("at"),
            *(column(c).alias(p) for c, p in zip(self.track, self.t)),
            *others,
        )

    def position(self) -> Column:
        return F.struct(*self.k, "at").alias(POSITION)

    def version(self, rows: DataFrame, *others: str) -> DataFrame:
        """Plain versions under their published names."""
        return rows.select(
            *(F.col(p).alias(c) for c, p in zip(self.key, self.k)),
            *(F.col(p).alias(c) for c, p in zip(self.track, self.t)),
            F.col("at").alias("valid_from"),
            "valid_to",
            F.col("valid_to").isNull().alias("is_current"),
            *others,
        )


@dataclass(frozen=True)
class _Store:
    """A table in sorted slices: its name and folder, and plain rows as they stand there."""

    name: str
    path: str
    order: list[str]
    out: Callable[[DataFrame], DataFrame]


def _stores(name: str, path: str, shape: _Shape) -> tuple[_Store, _Store]:
    """The tables of events and of versions."""
    kept = [*shape.k, "at", *shape.t, BATCH, SLICE]
    events = _Store(f"{name}{EVENTS}", f"{path}/events", [*shape.k, "at"], lambda rows: rows.select(*kept))
    history = _Store(name, f"{path}/versions", [*shape.key, "valid_from"], lambda rows: shape.version(rows, SLICE))
    return events, history


def _order(fence: DataFrame) -> list[str]:
    return [r[SLICE] for r in fence.select(SLICE, "at").orderBy("at").collect()]


def scd2_splice(
    spark: SparkSession,
    name: str,
    changes: DataFrame,
    path: str,
    *,
    key: Sequence[str],
    sequence_by: str,
    track: Sequence[str] | None = None,
    batch_id: int,
    slice_rows: int = SLICE_ROWS,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> Spliced:
    """Apply one batch of changes to the dimension ``name`` (folder ``path``), which need not exist.

    The events are kept in the table ``name`` + ``_events``.
    """
    check_sequence(key, sequence_by)
    known = {*key, sequence_by}
    shape = _Shape(list(key), sequence_by, list(track or [c for c in changes.columns if c not in known]))
    rows = changes.where(column(sequence_by).isNotNull())
    batch = materialise(shape.plain(rows, sequence_by, F.lit(batch_id).cast("bigint").alias(BATCH)), "batch")
    batch = _consistent(batch, shape)
    events_of, history_of = _stores(name, path, shape)
    begun = all(tables.exists(spark, s.name) and slices.names(spark, s.name) for s in (events_of, history_of))
    if not begun:
        return _rebuild(spark, events_of, history_of, batch, shape, slice_rows, max_group_rows)
    if batch.isEmpty():
        return Spliced()
    fence = slices.fences(spark, events_of.name, events_of.path)
    parts = slices.in_parts(materialise(batch.withColumn(POSITION, shape.position()), "batch"), [POSITION])
    new = materialise(slices.located(parts, fence).drop(POSITION), "located")
    order = _order(fence)
    dealt = {r[SLICE]: r["count"] for r in new.groupBy(SLICE).count().collect()}
    if len(dealt) > max(4, NEW_SHARE * len(order)) or max(dealt.values()) > NEW_SLICES * slice_rows:
        return _rebuild(spark, events_of, history_of, batch, shape, slice_rows, max_group_rows)

    context = _context(order, dealt)
    events = _merged_events(spark, events_of.name, new, context, shape, batch_id)
    opened = materialise(_differences(spark, events, context, shape), "opened")
    read, written = _splice_versions(spark, history_of, opened, shape, slice_rows)
    changed = events.where(F.col(SLICE).isin(list(dealt))).select(
        *shape.k, "at", *(F.col(f"now.{t}").alias(t) for t in shape.t), F.col("batch_now").alias(BATCH), SLICE
    )
    _write(spark, events_of, changed, shape, slice_rows)
    discard(batch, new, events, opened, fence)
    return Spliced(len(context.read), len(dealt), read, written)


def _consistent(batch: DataFrame, shape: _Shape) -> DataFrame:
    """One row per key and sequence; two with different values are an error."""
    values = F.struct(*shape.t)
    grouped = batch.groupBy(*shape.k, "at").agg(
        F.min(values).alias("low"), F.max(values).alias("high"), F.first(BATCH).alias(BATCH)
    )
    stored = materialise(grouped, "batch")
    found = stored.where(~F.col("low").eqNullSafe(F.col("high"))).first()
    if found is not None:
        raise ValueError(f"one batch holds different values for {dict(zip([*shape.key, shape.sequence_by], found))}")
    return stored.select(*shape.k, "at", "low.*", BATCH)


@dataclass(frozen=True)
class _Context:
    """Touched slices, their neighbours, and the order of all these."""

    touched: list[str]
    read: list[str]
    links: list[tuple[str, str | None, int, int]]

    def table(self, spark: SparkSession) -> DataFrame:
        """Each slice with the one before, its number, and the stretch of neighbours that it is in."""
        return spark.createDataFrame(self.links, f"{SLICE} string, _before string, _at int, _stretch int")

    def followers(self) -> list[str]:
        touched = set(self.touched)
        return [s for s, before, _, _ in self.links if before in touched]

    def open_ends(self, order: list[str]) -> list[str]:
        """Slices after which there is one that has not been read."""
        read = set(self.read)
        return [s for s, after in zip(order, order[1:]) if s in read and after not in read]


def _context(order: list[str], touched) -> _Context:
    at = {s: i for i, s in enumerate(order)}
    wanted = sorted({i for s in touched for i in (at[s] - 1, at[s], at[s] + 1) if 0 <= i < len(order)})
    links, stretch = [], 0
    for i in wanted:
        stretch += i - 1 not in wanted
        links.append((order[i], order[i - 1] if i - 1 in wanted else None, i, stretch))
    return _Context(sorted(touched, key=at.get), [order[i] for i in wanted], links)


def _merged_events(
    spark: SparkSession, name: str, new: DataFrame, context: _Context, shape: _Shape, batch_id: int
) -> DataFrame:
    """Events of the context as they were (``was``) and are (``now``), stored."""
    value = F.struct(*shape.t)
    old = slices.load(spark, name, context.read).select(
        *(F.col(k).alias(f"old_{k}") for k in [*shape.k, "at", SLICE]), value.alias("was"), F.col(BATCH).alias("batch_was")
    )
    fresh = new.select(*shape.k, "at", SLICE, value.alias("given"))
    pairs = same([F.col(k) for k in [*shape.k, "at"]], [F.col(f"old_{k}") for k in [*shape.k, "at"]])
    joined = fresh.join(old, pairs, "full_outer")
    # a later batch wins
    wins = F.col("given").isNotNull() & (F.col("batch_was").isNull() | (F.col("batch_was") <= batch_id))
    fresh_row = F.col("given").isNotNull()
    return materialise(
        joined.select(
            *(F.when(fresh_row, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c) for c in [*shape.k, "at", SLICE]),
            "was",
            F.when(wins, F.col("given")).otherwise(F.col("was")).alias("now"),
            F.when(wins, F.lit(batch_id)).otherwise(F.col("batch_was")).cast("bigint").alias("batch_now"),
        ),
        "events",
    )


def _differences(spark: SparkSession, events: DataFrame, context: _Context, shape: _Shape) -> DataFrame:
    """Versions to put (``value`` is set) and to remove, by position."""
    key = F.struct(*shape.k)
    rows = events.select(
        SLICE, *shape.k, "at", shape.position(), F.lit(True).alias("own"),
        F.col("now"), F.when(F.col("was").isNotNull(), F.struct(key.alias("key"), F.col("was").alias("value"))).alias("was"),
        F.struct(key.alias("key"), F.col("now").alias("value")).alias("is"),
    )
    # the last event of the slice before, as it is and as it was
    ends = rows.groupBy(SLICE).agg(
        F.max_by("is", POSITION).alias("is"), F.max_by("was", F.when(F.col("was").isNotNull(), F.col(POSITION))).alias("was")
    )
    links = F.broadcast(context.table(spark))  # a row per slice of the context
    before = ends.withColumnRenamed(SLICE, "_before").join(links.select(SLICE, "_before"), "_before").drop("_before")
    every = rows.unionByName(before, allowMissingColumns=True)
    in_order = Window.partitionBy(SLICE).orderBy(F.asc_nulls_first(POSITION))
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    compared = every.withColumns(
        {"last_is": F.lag("is").over(in_order), "last_was": F.last("was", ignorenulls=True).over(earlier)}
    )
    opens = ~F.col("last_is").eqNullSafe(F.col("is"))
    opened = F.col("was").isNotNull() & ~F.col("last_was").eqNullSafe(F.col("was"))
    # of neighbours only the first event can differ; those that a context begins with have no known predecessor
    decided = F.col("own") & (F.col(SLICE).isin(context.touched) | F.col(SLICE).isin(context.followers()))
    put = opens & (~opened | ~F.col("was.value").eqNullSafe(F.col("now")))
    gone = opened & ~opens
    return compared.where(decided & (put | gone)).select(
        *shape.k, "at", F.when(put, F.col("now")).alias("value")
    )


def _splice_versions(
    spark: SparkSession, store: _Store, opened: DataFrame, shape: _Shape, slice_rows: int
) -> tuple[int, int]:
    """Put and remove versions, and end each where the next begins; slices read and written."""
    if opened.isEmpty():
        return 0, 0
    fence = slices.fences(spark, store.name, store.path)
    parts = slices.in_parts(materialise(opened.withColumn(POSITION, shape.position()), "opened"), [POSITION])
    given = materialise(slices.located(parts, fence).drop(POSITION), "located")
    order = _order(fence)
    context = _context(order, {r[SLICE] for r in given.select(SLICE).distinct().collect()})
    stored = slices.load(spark, store.name, context.read)
    old = shape.plain(stored, "valid_from", F.col("valid_to"), F.col(SLICE)).select(
        *(F.col(k).alias(f"old_{k}") for k in [*shape.k, "at", SLICE]),
        F.struct(*shape.t).alias("was"), F.col("valid_to").alias("ended"),
    )
    pairs = same([F.col(k) for k in [*shape.k, "at"]], [F.col(f"old_{k}") for k in [*shape.k, "at"]])
    joined = given.withColumn("given", F.lit(True)).join(old, pairs, "full_outer")
    put = F.col("given").isNotNull()
    merged = materialise(
        joined.select(
            *(F.when(put, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c) for c in [*shape.k, "at", SLICE]),
            F.when(put, F.col("value")).otherwise(F.col("was")).alias("value"),
            "was",
            "ended",
        ),
        "versions",
    )
    kept = merged.where(F.col("value").isNotNull()).withColumn(POSITION, shape.position())
    # where the next slice of the stretch that has rows begins
    firsts = kept.groupBy(SLICE).agg(F.min(POSITION).alias("first"))
    later = Window.partitionBy("_stretch").orderBy("_at").rowsBetween(1, Window.unboundedFollowing)
    begins = context.table(spark).join(firsts, SLICE, "left").select(
        SLICE, F.first("first", ignorenulls=True).over(later).alias("_next")
    )
    in_order = Window.partitionBy(SLICE).orderBy(POSITION)
    following = F.coalesce(F.lead(POSITION).over(in_order), F.col("_next"))
    of_key = same([F.col(k) for k in shape.k], [F.col(f"following.{k}") for k in shape.k])
    # the last slice of a stretch keeps its end: what follows it has not been read
    unknown = F.col("following").isNull() & F.col(SLICE).isin(context.open_ends(order))
    ended = kept.join(F.broadcast(begins), SLICE).withColumn("following", following)
    ended = ended.withColumn(
        "valid_to",
        F.when(unknown, F.col("ended")).when(F.col("following").isNotNull() & of_key, F.col("following.at")),
    )
    ended = materialise(ended.drop("_next", "following", POSITION), "ended")
    gone = merged.where("value IS NULL AND was IS NOT NULL").select(SLICE)
    differs = ~F.col("was").eqNullSafe(F.col("value")) | ~F.col("ended").eqNullSafe(F.col("valid_to"))
    changed = sorted(r[SLICE] for r in ended.where(differs).select(SLICE).union(gone).distinct().collect())
    if changed:
        rows = ended.where(F.col(SLICE).isin(changed)).select(*shape.k, "at", "value.*", "valid_to", SLICE)
        _write(spark, store, rows, shape, slice_rows, emptied=changed)
    discard(given, merged, ended, fence)
    return len(context.read), len(changed)


def _write(
    spark: SparkSession, store: _Store, rows: DataFrame, shape: _Shape, slice_rows: int, emptied: Sequence[str] = ()
) -> None:
    """Publish the new content of slices, cutting those that have grown to twice their size.

    Slices of ``emptied`` that have no rows left are dropped; what belongs there goes to the one before.
    """
    sizes = rows.groupBy(SLICE).count().withColumnRenamed("count", "_rows")
    place = F.row_number().over(Window.partitionBy(SLICE).orderBy(shape.position())) - 1
    piece = F.when(F.col("_rows") > 2 * slice_rows, F.floor(place / slice_rows)).otherwise(0)
    dealt = rows.join(F.broadcast(sizes), SLICE).withColumn("_piece", piece)
    # the first piece stays the slice it was; others begin where their first row stands
    cut = F.concat(slices.new_names(F.col("_piece")), F.lit("-"), F.xxhash64(SLICE).cast("string"))
    of_piece = F.when(F.col("_piece") == 0, F.col(SLICE)).otherwise(cut)
    dealt = materialise(dealt.withColumn(SLICE, of_piece), "dealt")
    version, held = slices.write(store.out(dealt), store.path, store.order)
    fresh = dealt.where("_piece > 0").withColumn(POSITION, shape.position())
    added = {r[SLICE] for r in fresh.select(SLICE).distinct().collect()}
    if added:
        slices.record_fences(fresh, store.path)
    slices.publish(spark, store.name, version, [s for s in held if s not in added], sorted(added))
    slices.drop(spark, store.name, set(emptied) - set(held))
    discard(dealt)


def _rebuild(
    spark: SparkSession,
    events_of: _Store,
    history_of: _Store,
    batch: DataFrame,
    shape: _Shape,
    slice_rows: int,
    max_group_rows: int,
) -> Spliced:
    """Sort all events anew, with those of the batch, and cut them and their history into slices."""
    if tables.exists(spark, events_of.name):
        old = slices.load(spark, events_of.name).drop(SLICE)
        later = Window.partitionBy(*shape.k, "at").orderBy(F.desc(BATCH), F.desc("_given"))
        both = old.withColumn("_given", F.lit(0)).unionByName(batch.withColumn("_given", F.lit(1)))
        batch = both.withColumn("_place", F.row_number().over(later)).where("_place = 1").drop("_place", "_given")
    events = materialise(batch, "events")
    history = versions(events.drop(BATCH), shape.k, "at", shape.t, max_group_rows)
    history = materialise(history.select(*shape.k, F.col("valid_from").alias("at"), *shape.t, "valid_to"), "history")
    _lay_out(spark, history_of, history, shape, slice_rows)
    _lay_out(spark, events_of, events, shape, slice_rows)
    discard(events, history)
    return Spliced(rebuilt=True)


def _lay_out(spark: SparkSession, store: _Store, rows: DataFrame, shape: _Shape, slice_rows: int) -> None:
    """Publish sorted rows as new slices of about ``slice_rows``, and drop those there were."""
    if not tables.exists(spark, store.name):
        slices.create(store.out(rows.withColumn(SLICE, F.lit(""))).drop(SLICE), store.name, store.path)
    old = slices.names(spark, store.name)
    # a task sorts the rows of many slices; the place of a row in its task tells which one it is in
    number = max(1, -(-rows.count() // max(slice_rows, TASK_ROWS)))
    in_order = rows.repartitionByRange(number, *shape.k, "at").sortWithinPartitions(*shape.k, "at")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    cut = F.concat_ws("-", F.spark_partition_id(), F.floor(place / slice_rows))
    dealt = materialise(in_order.withColumn(SLICE, slices.new_names(cut)), "dealt")
    version, added = slices.write(store.out(dealt), store.path, store.order)
    slices.record_fences(dealt.withColumn(POSITION, shape.position()), store.path)
    slices.publish(spark, store.name, version, [], added)
    slices.drop(spark, store.name, old)
    discard(dealt)
