"""Published Parquet tables.

A load never changes files a reader may be using: it writes a new folder and
then moves the table's location in the session catalog. A table can be spread
over ``buckets`` (a hash of some of its merge keys, stored as the partition
column ``_bucket``); a load then writes and moves only the buckets it touches.
There is one writer per table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestar.names import columns as named, quoted
from lodestar.scratch import PACKED, delete_folder, folder_names
from lodestar.sources import slices

BUCKET = "_bucket"
#: The part of a bucket that a row is shuffled with; never stored.
PIECE = "_piece"
PIECES_OF_A_TASK = 4
_BUCKETS = "lodestar.buckets"
_BUCKET_BY = "lodestar.bucket_by"


def create_schema(spark: SparkSession, name: str, folder: str | None = None) -> None:
    location = f" LOCATION '{folder}'" if folder else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{location}")


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace the content of a folder and return a scan of it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def register(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make an existing Parquet folder a table, unless it is one already."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


def empty_like(spark: SparkSession, ddl: str) -> DataFrame:
    """An empty relation with real column types, to compare a first load with."""
    return spark.createDataFrame([], ddl)


def location(spark: SparkSession, name: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return details.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """The number of buckets and the columns they are computed from."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key").startswith("lodestar."))
    properties = {row["key"]: row["value"] for row in rows.collect()}
    if _BUCKETS not in properties:
        return None
    return int(properties[_BUCKETS]), json.loads(properties[_BUCKET_BY])


def bucket_of(buckets: int, columns: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*named(columns)), F.lit(buckets)).cast("int")


def touched_buckets(df: DataFrame, buckets: int, columns: Sequence[str]) -> list[int]:
    """The buckets that hold keys of ``df``: at most ``buckets`` numbers."""
    rows = df.select(bucket_of(buckets, columns).alias(BUCKET)).distinct().collect()
    return sorted(row[BUCKET] for row in rows)


def load(spark: SparkSession, name: str, only: Iterable[int] | None = None) -> DataFrame:
    """The table without the column of its buckets or slices, optionally just some of its buckets."""
    # A session remembers where a table was; another one may have moved it since.
    spark.catalog.refreshTable(name)
    df = spark.table(name)
    if only is not None:
        df = df.where(F.col(BUCKET).isin(list(only)))
    return df.drop(BUCKET, slices.SLICE)


def by_bucket(df: DataFrame, buckets: int, columns: Sequence[str]) -> tuple[DataFrame, Column]:
    """``df`` with ``PIECE``, shuffled so that a task holds whole pieces of few buckets, and the bucket of a piece.

    Rows that agree in ``columns`` share a piece, so windows by ``PIECE`` and those columns need no other
    shuffle, and a bucket is written to few files.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = -(-PIECES_OF_A_TASK * tasks // buckets)
    of_bucket = F.pmod(F.xxhash64(F.xxhash64(*named(columns)), F.lit(1)), F.lit(pieces))
    piece = (bucket_of(buckets, columns) * pieces + of_bucket).cast("int")
    spread = df.withColumn(PIECE, piece).repartition(PIECE)
    return spread, F.floor(F.col(PIECE) / pieces).cast("int").alias(BUCKET)


def create(
    df: DataFrame,
    name: str,
    path: str,
    buckets: int | None = None,
    bucket_by: Sequence[str] = (),
) -> None:
    """Publish the first version of a table below ``path``."""
    spark = df.sparkSession
    if buckets is None:
        df.write.options(**PACKED).option("path", _new_version(path)).format("parquet").saveAsTable(name)
        return
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields if f.name != BUCKET)
    by = json.dumps(list(bucket_by)).replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {BUCKET} INT) USING parquet"
        f" PARTITIONED BY ({BUCKET}) LOCATION '{path}'"
        f" TBLPROPERTIES ('{_BUCKETS}' = '{buckets}', '{_BUCKET_BY}' = '{by}')"
    )
    replace(df, name, path)


def replace(df: DataFrame, name: str, path: str, touched: Iterable[int] | None = None) -> None:
    """Publish ``df`` as the new content: of the whole table, or of the buckets it holds.

    Buckets of ``touched`` without rows in ``df`` become empty. Rows that come with their
    ``BUCKET`` are written as they are spread, else each bucket is collected first.
    """
    spark = df.sparkSession
    layout = bucketing(spark, name)
    if layout:
        if BUCKET in df.columns:
            move_partitions(df, name, path, touched or (), spread=True)
        else:
            _move_buckets(df, name, path, *layout, emptied=touched or ())
        return
    version = _new_version(path)
    df.write.options(**PACKED).parquet(version)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    spark.catalog.refreshTable(name)


def _new_version(path: str) -> str:
    return f"{path}/version-{uuid.uuid4().hex}"


def _move_buckets(
    df: DataFrame,
    name: str,
    path: str,
    buckets: int,
    bucket_by: Sequence[str],
    emptied: Iterable[int] = (),
) -> None:
    """Write the buckets present in ``df`` and point the table's partitions at them."""
    move_partitions(df.withColumn(BUCKET, bucket_of(buckets, bucket_by)), name, path, emptied)


def create_partitioned(df: DataFrame, name: str, path: str) -> None:
    """Create a table without rows that has the columns of ``df`` and ``BUCKET``, which the caller computes."""
    empty = df.limit(0).withColumn(BUCKET, F.lit(0))
    empty.write.format("parquet").partitionBy(BUCKET).option("path", f"{path}/table").saveAsTable(name)


def bucket_numbers(spark: SparkSession, name: str) -> list[int]:
    """The buckets that a table has, empty ones included."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return sorted(int(row["partition"].split("=")[1]) for row in rows)


def move_partitions(
    df: DataFrame,
    name: str,
    path: str,
    emptied: Iterable[int] = (),
    sort_by: Sequence[str] = (),
    spread: bool = False,
) -> None:
    """Write rows that know their ``BUCKET``, and point the table's partitions at them.

    Buckets of ``emptied`` without rows in ``df`` are dropped. With ``spread`` the rows of a bucket
    are in few tasks already (``by_bucket``).
    """
    spark = df.sparkSession
    version = _new_version(path)
    # The rebalance hint collects each bucket into few files and splits a large one.
    rows = df if spread else df.hint("rebalance", BUCKET)
    rows = rows.sortWithinPartitions(BUCKET, *sort_by) if sort_by else rows
    rows.write.options(**PACKED).partitionBy(BUCKET).parquet(version)
    known = set(bucket_numbers(spark, name))
    held = {int(n.split("=")[1]) for n in folder_names(spark, version) if n.startswith(f"{BUCKET}=")}
    for number in sorted(known & set(emptied) - held):
        spark.sql(f"ALTER TABLE {name} DROP PARTITION ({BUCKET} = {number})")
    places = {n: f"PARTITION ({BUCKET} = {n})" for n in sorted(held)}
    folders = {n: f"'{version}/{BUCKET}={n}'" for n in places}
    added = [f"{places[n]} LOCATION {folders[n]}" for n in places if n not in known]
    if added:  # all new buckets at once
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(added)}")
    for n in places:
        if n in known:
            spark.sql(f"ALTER TABLE {name} {places[n]} SET LOCATION {folders[n]}")
    spark.catalog.refreshTable(name)


def drop_old_versions(spark: SparkSession, name: str, path: str) -> None:
    """Delete version folders that no longer back any part of the table.

    Run it when no reader of an earlier version is left.
    """
    if slices.is_sliced(spark, name):
        used = slices.used_versions(spark, name)
    elif bucketing(spark, name):
        partitions = spark.sql(f"SHOW PARTITIONS {name}").collect()
        used = {
            _partition_location(spark, name, row["partition"]).rsplit("/", 1)[0].rsplit("/", 1)[-1]
            for row in partitions
        }
    else:
        used = {location(spark, name).rsplit("/", 1)[-1]}
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in system.listStatus(folder):
        version = entry.getPath().getName()
        if version.startswith("version-") and version not in used:
            delete_folder(spark, entry.getPath().toString())


def _partition_location(spark: SparkSession, name: str, partition: str) -> str:
    number = partition.split("=")[1]
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({BUCKET} = {number})")
    return details.where("col_name = 'Location'").first()["data_type"].rstrip("/")
