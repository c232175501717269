"""Update-or-insert by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, WindowSpec, functions as F

from lodestar.names import Plain, column, columns as named
from lodestar.operators.segments import same
from lodestar.scratch import discard, fits_in, materialise, stored_bytes
from lodestar.sources import slices, tables


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = True,
    only_changed: Sequence[str] = (),
    sequence: Sequence[str] = (),
    small_source: bool = False,
) -> DataFrame:
    """``target`` with rows of ``source`` written over matching keys, and the others added.

    With ``only_changed`` a matching row is replaced only if one of those
    columns differs, with ``sequence`` only if the source's row is not older by
    these columns (NULL is oldest). In general this is one full outer join. A
    ``small_source``, one below the broadcast threshold, is left-joined and its
    unmatched rows are added instead, which never shuffles the target.
    """
    if _types(source) != _types(target):
        raise ValueError(f"source {source.dtypes} differs from target {target.dtypes}")
    old, new = Plain(target), Plain(source.select(*named(target.columns)), "s")
    joined = _matched(
        old, new, keys, "left" if small_source else "full_outer", null_safe, only_changed, sequence
    )
    merged = old.back(joined.select(*_written(old, new)))
    if not small_source:
        return merged
    known, incoming = Plain(target.select(*named(keys)), "k"), new.all_of(keys)
    at_key = _at_key(known.plain, incoming, null_safe)
    found = known.df.join(new.df.select(*incoming), at_key, "left_semi")
    added = new.df.join(found, at_key, "left_anti")
    return merged.unionByName(added.toDF(*target.columns))


def _at_key(theirs: Sequence[str], ours: Sequence[str], null_safe: bool) -> Column:
    pairs = ((F.col(t), F.col(o)) for t, o in zip(theirs, ours))
    return reduce(lambda a, b: a & b, (t.eqNullSafe(o) if null_safe else t == o for t, o in pairs))


def _matched(
    old: Plain,
    new: Plain,
    keys: Sequence[str],
    how: str,
    null_safe: bool,
    only_changed: Sequence[str],
    sequence: Sequence[str],
) -> DataFrame:
    """Old and new rows side by side at their keys, and ``written``: whether the new one counts."""
    at_key = _at_key(old.all_of(keys), new.all_of(keys), null_safe)
    joined = old.df.withColumn("known", F.lit(True)).join(new.df.withColumn("given", F.lit(True)), at_key, how)
    written = F.col("given").isNotNull()
    if only_changed:
        unchanged = same(*([F.col(c) for c in side.all_of(only_changed)] for side in (old, new)))
        written = written & (F.col("known").isNull() | ~unchanged)
    if sequence:
        ours, theirs = (F.struct(*side.all_of(sequence)) for side in (old, new))
        written = written & (F.col("known").isNull() | (theirs >= ours))
    return joined.withColumn("written", written)


def _written(old: Plain, new: Plain) -> list[Column]:
    """The columns of the merged row."""
    return [F.when(F.col("written"), F.col(n)).otherwise(F.col(o)).alias(o) for o, n in zip(old.plain, new.plain)]


def _types(df: DataFrame) -> dict[str, str]:
    return {name.lower(): kind for name, kind in df.dtypes}


def _broadcast_threshold(spark: SparkSession) -> int:
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if setting.startswith("-"):  # broadcasting is switched off
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise if a key repeats; counted on the executors, one row is fetched.

    Hashes of the keys are counted first. Only keys whose hash repeats are compared themselves.
    """
    key = df.select(*(column(k).alias(f"k{i}") for i, k in enumerate(keys)))
    key = key.withColumn("hashed", F.xxhash64(*key.columns))
    again = key.groupBy("hashed").agg(F.count("*").alias("times")).where("times > 1").select("hashed")
    if again.isEmpty():
        return
    times = key.join(again, "hashed", "left_semi").groupBy(*key.columns).agg(F.count("*").alias("times"))
    repeated = times.where("times > 1").first()
    if repeated is not None:
        raise ValueError(f"{what} repeats the key {dict(zip(keys, repeated))}")


def _newest(
    rows: DataFrame, old: Plain, at_key: WindowSpec, only_changed: Sequence[str], sequence: Sequence[str]
) -> tuple[DataFrame, list[Column], Column]:
    """Of the old row and the new one at a key one row, its columns as merged, and whether the old ones stay."""
    rows = rows.withColumn("place", F.row_number().over(at_key))
    columns, stays = [F.col(c) for c in old.plain], F.lit(False)
    if only_changed or sequence:
        # the old row comes after the new one, if there is one
        rows = rows.withColumn("old", F.lead(F.struct(*old.plain)).over(at_key))
        before = lambda names: [F.col(f"old.{c}") for c in old.all_of(names)]
        after = lambda names: [F.col(c) for c in old.all_of(names)]
        if only_changed:
            stays = stays | same(after(only_changed), before(only_changed))
        if sequence:
            stays = stays | ~F.coalesce(F.struct(*after(sequence)) >= F.struct(*before(sequence)), F.lit(True))
        stays = F.col("old").isNotNull() & stays
        columns = [F.when(stays, F.col(f"old.{c}")).otherwise(F.col(c)).alias(c) for c in old.plain]
    return rows.where("place = 1"), columns, stays


def _merged_in_buckets(
    target: DataFrame,
    source: DataFrame,
    layout: tuple[int, Sequence[str]],
    keys: Sequence[str],
    only_changed: Sequence[str],
    sequence: Sequence[str],
) -> DataFrame:
    """``merge_rows`` for keys that match NULL-safe, with ``BUCKET``: rows are shuffled once, to where they are written.

    No key of the source repeats, so a key has an old row, a new one, or one of each side by side.
    """
    old = Plain(target)
    if _types(source) != _types(target):
        raise ValueError(f"source {source.dtypes} differs from target {target.dtypes}")
    new = Plain(source.select(*named(target.columns)))
    both = old.df.withColumn("given", F.lit(False)).unionAll(new.df.withColumn("given", F.lit(True)))
    rows, bucket = tables.by_bucket(both, layout[0], old.all_of(layout[1]))
    at_key = Window.partitionBy(tables.PIECE, *old.all_of(keys)).orderBy(F.desc("given"))
    rows, columns, _ = _newest(rows, old, at_key, only_changed, sequence)
    merged = rows.select(*columns, bucket)
    return old.back(merged, tables.BUCKET)


def upsert(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    path: str,
    *,
    null_safe: bool = True,
    only_changed: Sequence[str] = (),
    sequence: Sequence[str] = (),
    buckets: int | None = None,
    bucket_by: Sequence[str] | None = None,
    stored: bool = False,
    unique: bool = False,
) -> None:
    """Merge ``source`` into the table ``name`` (folder ``path``); the first load creates it.

    ``buckets`` counts on the first load: later loads rewrite only the buckets
    that hold keys of the source. ``bucket_by`` must be among the merge keys.
    A ``stored`` source is cheap to read again and not stored once more; of a
    ``unique`` one the caller knows that no key repeats, which is an error.
    """
    bucket_by = list(bucket_by or keys)
    if not {c.lower() for c in bucket_by} <= {k.lower() for k in keys}:
        raise ValueError("bucket_by must consist of merge keys")
    rows = source if stored else materialise(source, "merge-source")
    if not unique:
        require_unique(rows, keys, "the source")
    created = not tables.exists(spark, name)
    if created:
        # each task writes its rows of every bucket; to collect buckets first would shuffle all rows
        bucket = tables.bucket_of(buckets, bucket_by) if buckets else None
        tables.create(rows if bucket is None else rows.withColumn(tables.BUCKET, bucket), name, path, buckets, bucket_by)
    else:
        layout = tables.bucketing(spark, name)
        touched = tables.touched_buckets(rows, *layout) if layout else [] if rows.isEmpty() else [0]
        small = fits_in(rows, _broadcast_threshold(spark))
        if touched:
            target = tables.load(spark, name, only=touched if layout else None)
            if layout and null_safe and not small:
                merged = _merged_in_buckets(target, rows, layout, keys, only_changed, sequence)
            else:
                merged = merge_rows(
                    target,
                    rows,
                    keys,
                    null_safe=null_safe,
                    only_changed=only_changed,
                    sequence=sequence,
                    small_source=small,
                )
            tables.replace(merged, name, path)
    if not stored:
        discard(rows)


#: A load into slices takes all in its reach that hold at most so many times its rows, and are at most so many to a task.
MOST_OLD, MOST_SLICES = 2, 4


def upsert_pruned(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    path: str,
    *,
    only_changed: Sequence[str] = (),
    sequence: Sequence[str] = (),
    part_bytes: int = slices.SLICE_BYTES,
    stored: bool = False,
    unique: bool = False,
) -> None:
    """Merge ``source`` into the table ``name``, of which only slices with rows that change are rewritten.

    The record of keys (``lodestar.sources.slices``) names the slices that may
    hold keys of the source. Of those only the columns compared are read, to find
    the rows that the source matches; slices without one that changes stay as
    they are. Rows that match nothing are added as new slices, so a load of new
    keys rewrites nothing. Keys match NULL-safe. A load that is repeated changes nothing.
    A load that has no less than half the rows of all slices in its range of the
    first key asks no filters: their rows are shuffled with its own, once.
    """
    given, stored = stored, source if stored else materialise(source, "merge-source")
    if not unique:
        require_unique(stored, keys, "the source")
    if not tables.exists(spark, name):
        slices.create(stored, name, path)
        slices.add(slices.as_new(stored, keys, part_bytes), name, path, keys, spread=True)
        discard(*([] if given else [stored]))
        return
    target = slices.load(spark, name).drop(slices.SLICE)
    if _types(stored) != _types(target):
        raise ValueError(f"source {stored.dtypes} differs from target {target.dtypes}")
    reach, count = slices.in_reach(spark, name, path, stored, keys)
    old_rows, size = sum(reach.values()), stored_bytes(stored)
    size += size * old_rows // max(count, 1)
    if not reach:
        slices.add(slices.as_new(stored, keys, part_bytes), name, path, keys, spread=True)
    elif old_rows <= MOST_OLD * count and len(reach) <= MOST_SLICES * max(1, size // part_bytes):
        _merge_in_ranges(spark, name, stored, keys, path, sorted(reach), size, only_changed, sequence, part_bytes)
    else:
        _merge_held(spark, name, stored, keys, path, only_changed, sequence, part_bytes)
    discard(*([] if given else [stored]))


def _merge_in_ranges(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    path: str,
    reach: Sequence[str],
    size: int,
    only_changed: Sequence[str],
    sequence: Sequence[str],
    part_bytes: int,
) -> None:
    """Merge a load that is not small beside the slices in its ``reach``: all their rows are shuffled with it, once."""
    old_slices = slices.load(spark, name, reach)
    columns = named(c for c in old_slices.columns if c != slices.SLICE)
    old = Plain(old_slices.select(*columns, slices.SLICE))
    new = source.select(*columns, F.lit(None).cast("string")).toDF(*old.plain)
    both = old.df.withColumn("given", F.lit(False)).unionAll(new.withColumn("given", F.lit(True)))
    at_key = Window.partitionBy(*old.all_of(keys)).orderBy(F.desc("given"))
    held = F.col(old.of(slices.SLICE))
    rows = slices.in_ranges(both, old.all_of(keys), size, part_bytes).withColumn("there", F.lead(held).over(at_key))
    rows, merged, stays = _newest(rows, old, at_key, only_changed, sequence)
    place = F.coalesce("there", held, slices.new_names(F.col(slices.PART)))
    changed = F.when(F.col("given") & ~stays, F.col("there"))
    seen = Observation()
    rows = rows.select(*merged[:-1], place.alias(old.plain[-1]), changed.alias("changed"))
    rows = rows.observe(seen, F.collect_set("changed").alias("changed")).drop("changed")
    slices.exchange(old.back(rows), name, path, keys, reach, seen)


def _merge_held(
    spark: SparkSession,
    name: str,
    stored: DataFrame,
    keys: Sequence[str],
    path: str,
    only_changed: Sequence[str],
    sequence: Sequence[str],
    part_bytes: int,
) -> None:
    """Merge a load that is small beside the slices in its reach: the record of keys names those to look into."""
    parts = slices.in_parts(stored, keys, part_bytes)
    old_columns = [c for c in slices.load(spark, name).columns if c != slices.SLICE]
    fresh_slice = slices.new_names(F.col(slices.PART)).alias(slices.SLICE)
    added, hits = parts, None
    held = slices.holding(spark, name, path, parts, keys)
    if held:
        # which rows match, and which of these change: only keys and compared columns are read
        old = Plain(slices.load(spark, name, held).select(*named(old_columns), slices.SLICE))
        new = Plain(stored.select(*named(old_columns)), "s")
        matched = _matched(old, new, keys, "inner", True, only_changed, sequence)
        place = F.col(old.of(slices.SLICE)).alias(slices.SLICE)
        hits = materialise(matched.select(*new.all_of(keys), place, "written"), "hits")
        changed = [r[0] for r in hits.where("written").select(slices.SLICE).distinct().collect()]
        if changed:
            old = Plain(slices.load(spark, name, changed).select(*named(old_columns), slices.SLICE))
            merged = _matched(old, new, keys, "left", True, only_changed, sequence)
            merged = old.back(merged.select(*_written(old, new), old.of(slices.SLICE)))
            version, held = slices.write(merged, path, keys)
            slices.publish(spark, name, version, replaced=held, added=[])
        incoming = Plain(parts, "p")
        at_key = _at_key(new.all_of(keys), incoming.all_of(keys), True)
        added = incoming.back(incoming.df.join(hits.select(*new.all_of(keys)), at_key, "left_anti"))
    if hits is None or hits.count() < stored.count():
        slices.add(added.select(*named(old_columns), fresh_slice), name, path, keys)
    discard(*([hits] if hits else []))
