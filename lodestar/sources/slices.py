"""Tables in slices, of which a load reads and replaces only those that hold its keys.

A slice is a partition of the catalog table, in a folder of its own. Rows that
change stay in their slice: its new content is written beside the old one, and
the partition is pointed there. New rows become new slices. So a row is always
in exactly one slice that readers see, and all other files stay as they are.

Beside the table there is a record of the keys of each slice: the range of the
first key, and a Bloom filter of all of them in blocks of 4 KB. A load looks its
keys up there: ranges first, by parts of the sorted load, then the blocks that
its keys fall into. The filters are made and read by SQL functions.

The record is written before a slice is published and keyed by a name that is
never used again, so what a load leaves behind that dies is never looked at.
There is one writer per table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from lodestar.names import columns as named
from lodestar.scratch import PACKED, delete_folder, discard, folder_exists, folder_names, materialise, stored_bytes

SLICE = "_slice"
#: The part of a load that a row belongs to; parts are ranges of the keys.
PART = "_part"

#: Rows of a load beyond so many bytes (as stored) are dealt to several slices.
SLICE_BYTES = 64 << 20
#: Bits of a filter for each key, and how many of them a key sets.
BITS_PER_KEY, BITS_SET = 10, 4
#: Bits of a block; the size is that of Spark's bitmap functions.
BLOCK_BITS = 32768
#: Rows whose bits a task sorts when it makes filters.
ROWS_AT_ONCE = 250_000
#: Slices named in a filter on the record, or in one statement.
NAMED_AT_ONCE = 500

_VERSION = re.compile(r"/(version-[0-9a-f]{32})/")


def in_parts(rows: DataFrame, keys: Sequence[str], part_bytes: int = SLICE_BYTES) -> DataFrame:
    """``rows`` (a stored table) with ``PART``: one for a small table, else ranges of the keys, stored again."""
    if stored_bytes(rows) <= part_bytes:
        return rows.withColumn(PART, F.lit(0))
    return materialise(in_ranges(rows, keys, stored_bytes(rows), part_bytes).sortWithinPartitions(*named(keys)), "parts")


def in_ranges(rows: DataFrame, keys: Sequence[str], stored: int, part_bytes: int = SLICE_BYTES) -> DataFrame:
    """``rows`` shuffled to ranges of the keys, one to a task, with ``PART``; ``stored`` are their bytes.

    The ranges belong to the shuffle, so a task that is run again has the same one.
    """
    ranges = max(1, -(-stored // part_bytes))
    return rows.repartitionByRange(ranges, *named(keys)).withColumn(PART, F.spark_partition_id())


def as_new(rows: DataFrame, keys: Sequence[str], part_bytes: int = SLICE_BYTES) -> DataFrame:
    """``rows`` (a stored table) with the ``SLICE`` of each, all new; each slice is in one task."""
    dealt = in_ranges(rows, keys, stored_bytes(rows), part_bytes)
    return dealt.withColumn(SLICE, new_names(F.col(PART))).drop(PART)


def create(rows: DataFrame, name: str, path: str) -> None:
    """Create the table without rows; it has the columns of ``rows`` and ``SLICE``."""
    empty = rows.limit(0).withColumn(SLICE, F.lit(""))
    empty.write.format("parquet").partitionBy(SLICE).option("path", f"{path}/table").saveAsTable(name)


def is_sliced(spark: SparkSession, name: str) -> bool:
    return SLICE in spark.table(name).columns


def names(spark: SparkSession, name: str) -> list[str]:
    """The slices of a table, as the catalog has them."""
    return [r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def load(spark: SparkSession, name: str, only: Iterable[str] | None = None) -> DataFrame:
    """The rows with ``SLICE``, optionally of some slices only."""
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    return rows if only is None else rows.where(F.col(SLICE).isin(list(only)))


def new_names(part: Column) -> Column:
    """Names of new slices, one for each part of a load."""
    return F.concat(F.lit(f"{uuid.uuid4().hex}-"), part.cast("string"))


def write(rows: DataFrame, path: str, keys: Sequence[str], spread: bool = False) -> tuple[str, list[str]]:
    """Write rows that know their ``SLICE`` to a new version; its folder, and the slices it holds.

    With ``spread`` the rows of a slice are in few tasks already (``in_ranges``).
    """
    version = f"{path}/version-{uuid.uuid4().hex}"
    collected = (rows if spread else rows.hint("rebalance", SLICE)).sortWithinPartitions(SLICE, *named(keys))
    collected.write.options(**PACKED).partitionBy(SLICE).parquet(version)
    return version, sorted(n.split("=", 1)[1] for n in folder_names(rows.sparkSession, version) if n.startswith(f"{SLICE}="))


def publish(spark: SparkSession, name: str, version: str, replaced: Iterable[str], added: Iterable[str]) -> None:
    """Point slices at a version. New ones appear together; each replaced one changes at once."""
    place = lambda s: f"PARTITION ({SLICE} = '{s}')"
    folder = lambda s: f"LOCATION '{version}/{SLICE}={s}'"
    for s in replaced:
        spark.sql(f"ALTER TABLE {name} {place(s)} SET {folder(s)}")
    added = list(added)
    for i in range(0, len(added), NAMED_AT_ONCE):
        places = " ".join(f"{place(s)} {folder(s)}" for s in added[i : i + NAMED_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    spark.catalog.refreshTable(name)


def drop(spark: SparkSession, name: str, slices: Iterable[str]) -> None:
    slices = list(slices)
    for i in range(0, len(slices), NAMED_AT_ONCE):
        places = ", ".join(f"PARTITION ({SLICE} = '{s}')" for s in slices[i : i + NAMED_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {places}")
    spark.catalog.refreshTable(name)


def add(rows: DataFrame, name: str, path: str, keys: Sequence[str], spread: bool = False) -> list[str]:
    """Publish rows that know their ``SLICE`` as new slices, with a record of their keys."""
    spark = rows.sparkSession
    version, added = write(rows, path, keys, spread)
    if added:
        written = spark.read.schema(rows.select(*named(keys), SLICE).schema).parquet(version)
        record(written, path, keys)
        publish(spark, name, version, [], added)
    return added


def exchange(rows: DataFrame, name: str, path: str, keys: Sequence[str], old: Iterable[str], seen: Observation) -> None:
    """Publish rows of ``old`` slices as their new content, and all others as new slices.

    Rows know their ``SLICE`` and are dealt ``in_ranges``. ``changed`` of what is ``seen`` while they
    are written are the old slices that did change; the others stay as they are.
    """
    spark = rows.sparkSession
    version, held = write(rows, path, keys, spread=True)
    changed, kept = sorted(set(seen.get["changed"])), sorted(set(held) & set(old))
    for s in kept:
        if s not in changed:
            delete_folder(spark, f"{version}/{SLICE}={s}")
    added = [s for s in held if s not in kept]
    if added:
        written = spark.read.schema(rows.select(*named(keys), SLICE).schema).parquet(version)
        record(written.where(~F.col(SLICE).isin(kept)) if kept else written, path, keys)
    publish(spark, name, version, changed, added)


def used_versions(spark: SparkSession, name: str) -> set[str]:
    """The version folders that hold files of the table."""
    spark.catalog.refreshTable(name)
    return {m.group(1) for m in map(_VERSION.search, spark.table(name).inputFiles()) if m}


# ---------------------------------------------------------------- the record of keys


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*named(keys))


def _bits(hashed: Column) -> list[Column]:
    """The places in its block of the bits that a key sets: 15 bits of a second hash each."""
    again = F.xxhash64(hashed, F.lit(1))
    return [F.shiftrightunsigned(again, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(BITS_SET)]


def record(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Add the ranges and filters of new slices to the record; a row per slice and block."""
    first = named(keys)[0]
    ranges = rows.groupBy(SLICE).agg(
        F.count("*").alias("rows"),
        F.min(first).alias("low"),
        F.max(first).alias("high"),
        F.count_if(first.isNull()).alias("nulls"),
    )
    ranges = ranges.withColumn("blocks", F.ceil(F.col("rows") * BITS_PER_KEY / BLOCK_BITS).cast("int"))
    ranges = materialise(ranges, "ranges")
    hashed = rows.select(SLICE, _hash(keys).alias("hashed")).join(ranges.select(SLICE, "blocks"), SLICE)
    block = F.pmod("hashed", "blocks").cast("int").alias("block")
    # whole blocks of a bounded number of rows to a task, which sorts all bits of its rows
    tasks = max(1, -(-(ranges.agg(F.sum("rows")).first()[0] or 0) // ROWS_AT_ONCE))
    hashed = hashed.select(SLICE, block, "hashed").repartition(tasks, SLICE, "block")
    bits = hashed.select(SLICE, "block", F.explode(F.array(*_bits(F.col("hashed")))).alias("bit"))
    filters = bits.groupBy(SLICE, "block").agg(F.call_function("bitmap_construct_agg", "bit").alias("bits"))
    every = ranges.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows_of_record = every.join(filters, [SLICE, "block"], "left")
    rows_of_record.sortWithinPartitions(SLICE, "block").write.mode("append").parquet(f"{path}/keys")
    discard(ranges)


def in_reach(
    spark: SparkSession, name: str, path: str, rows: DataFrame, keys: Sequence[str]
) -> tuple[dict[str, int], int]:
    """Slices whose range meets that of all ``rows`` (stored), with the rows of each, and how many ``rows`` there are."""
    first = named(keys)[0]
    span = rows.agg(
        F.min(first).alias("from"), F.max(first).alias("to"), F.count_if(first.isNull()).alias("none"), F.count("*").alias("all")
    )
    if not folder_exists(spark, f"{path}/keys"):
        return {}, span.first()["all"]
    ranges = spark.read.parquet(f"{path}/keys").where("block = 0").select(SLICE, "rows", "low", "high", "nulls")
    near = span.join(ranges, _overlap(), "left").select("all", SLICE, "rows").collect()  # a row per slice
    live = set(names(spark, name))
    return {r[SLICE]: r["rows"] for r in near if r[SLICE] in live}, near[0]["all"]


def _overlap() -> Column:
    """Whether a range of rows (from, to, none) meets that of a slice (low, high, nulls)."""
    both = (F.col("low") <= F.col("to")) & (F.col("from") <= F.col("high"))
    return both | ((F.col("none") > 0) & (F.col("nulls") > 0))


def holding(spark: SparkSession, name: str, path: str, parts: DataFrame, keys: Sequence[str]) -> list[str]:
    """Slices that may hold keys of ``parts``; those that do are never missed."""
    if not folder_exists(spark, f"{path}/keys"):
        return []
    kept = spark.read.parquet(f"{path}/keys")
    live = set(names(spark, name))
    first = named(keys)[0]
    spans = parts.groupBy(PART).agg(
        F.min(first).alias("from"), F.max(first).alias("to"), F.count_if(first.isNull()).alias("none")
    )
    ranges = kept.where("block = 0").select(SLICE, "low", "high", "nulls", "blocks")
    # a row per part of the load and slice whose ranges overlap
    near = materialise(spans.join(ranges, _overlap()).select(PART, SLICE, "low", "high", "nulls", "blocks"), "near")
    possible = sorted(live & {r[SLICE] for r in near.select(SLICE).distinct().collect()})
    if not possible:
        discard(near)
        return []
    if len(possible) <= NAMED_AT_ONCE:
        near, kept = (df.where(F.col(SLICE).isin(possible)) for df in (near, kept))
    hashed = parts.select(PART, first.alias("first"), _hash(keys).alias("hashed"))
    inside = F.col("first").between(F.col("low"), F.col("high")) | (F.col("first").isNull() & (F.col("nulls") > 0))
    probes = hashed.join(near, PART).where(inside)
    probes = probes.select(SLICE, F.pmod("hashed", "blocks").cast("int").alias("block"), "hashed")
    found = probes.join(kept.select(SLICE, "block", "bits"), [SLICE, "block"])
    for bit in _bits(F.col("hashed")):
        byte = F.conv(F.hex(F.substring("bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10)
        mask = F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (bit % 8 + 1).cast("int"))
        found = found.where(byte.cast("int").bitwiseAND(mask) != 0)
    held = {r[SLICE] for r in found.select(SLICE).distinct().collect()}
    discard(near)
    return sorted(held & live)


def slice_rows(spark: SparkSession, name: str, path: str) -> DataFrame:
    """``SLICE`` and ``rows`` of the slices in use, as recorded when they were made."""
    live = spark.createDataFrame([(s,) for s in names(spark, name)], f"{SLICE} string")
    try:
        kept = spark.read.parquet(f"{path}/keys")
    except AnalysisException:
        return live.withColumn("rows", F.lit(None).cast("bigint"))
    return live.join(kept.where("block = 0").select(SLICE, "rows"), SLICE)


def compact(
    spark: SparkSession, name: str, path: str, keys: Sequence[str], small: int, part_bytes: int = SLICE_BYTES
) -> None:
    """Put all slices of fewer than ``small`` rows into few, sorted by their keys.

    The new slices are added before the old ones go, so it is for times without readers.
    """
    old = [r[SLICE] for r in slice_rows(spark, name, path).where(F.col("rows") < small).collect()]
    if len(old) < 2:
        return
    rows = materialise(load(spark, name, old).drop(SLICE), "compacted")
    parts = in_parts(rows, keys, part_bytes)
    add(parts.withColumn(SLICE, new_names(F.col(PART))).drop(PART), name, path, keys)
    drop(spark, name, old)
    discard(rows)


# ---------------------------------------------------------------- slices in order

#: Where a row stands in the order of a table whose slices are ranges of it: a struct of its key columns.
POSITION = "_position"


def record_fences(rows: DataFrame, path: str) -> None:
    """Remember where new slices begin; ``rows`` have ``SLICE`` and ``POSITION``."""
    lowest = rows.groupBy(SLICE).agg(F.min(POSITION).alias("low"))
    lowest.write.mode("append").parquet(f"{path}/fences")


def fences(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Where each slice begins (null: the first, before all), where the next one does, and its number; stored."""
    live = spark.createDataFrame([(s,) for s in names(spark, name)], f"{SLICE} string")
    known = spark.read.parquet(f"{path}/fences").join(live, SLICE).groupBy(SLICE).agg(F.min("low").alias("low"))
    in_order = Window.orderBy("low")  # a row per slice
    numbered = known.select(
        SLICE, "low", F.lead("low").over(in_order).alias("high"), F.row_number().over(in_order).alias("at")
    )
    return materialise(numbered.withColumn("low", F.when(F.col("at") > 1, F.col("low"))), "fences")


def located(rows: DataFrame, fence: DataFrame) -> DataFrame:
    """``rows`` (with ``POSITION`` and ``PART``) with the ``SLICE`` that each belongs to."""
    spans = rows.groupBy(PART).agg(F.min(POSITION).alias("from"), F.max(POSITION).alias("to"))
    begun = F.col("low").isNull() | (F.col("low") <= F.col("to"))
    near = spans.join(fence, begun & (F.col("high").isNull() | (F.col("from") < F.col("high"))))
    # fences and rows of a part in one order: a row is in the slice that began last, however many slices there are
    points = near.select(PART, F.col("low").alias(POSITION), F.col(SLICE).alias("_began"), F.lit(0).alias("_is_row"))
    every = rows.withColumn("_is_row", F.lit(1)).unionByName(points, allowMissingColumns=True)
    so_far = Window.partitionBy(PART).orderBy(F.asc_nulls_first(POSITION), "_is_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = every.withColumn(SLICE, F.last("_began", ignorenulls=True).over(so_far))
    return found.where("_is_row = 1").drop(PART, "_began", "_is_row")
