"""Intermediate tables in the folder that all executors share.

An intermediate result that must not be computed twice (because it carries
generated positions, or because several later steps read it) is written as
Parquet and read back. That cuts the lineage, survives lost executors, and
keeps column pruning for whoever reads it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lodestar.names import quoted

_local_folders: dict[str, str] = {}

#: How stored rows are packed: half the size of Spark's default for keys made of text, at little more time.
PACKED = {"compression": "zstd"}

#: Types whose values take one word of a row in memory.
_ONE_WORD = (T.BooleanType, T.IntegralType, T.FractionalType, T.DateType, T.TimestampType, T.TimestampNTZType)


#: Spark's setting that removes the shuffle files of a statement when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Statements started meanwhile, in streams too, remove their shuffle files when they end.

    Else these stay until the driver collects its garbage, so that a load of many steps holds on disk
    whatever one of them has shuffled. A DataFrame that is run again shuffles again.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    application = context.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="lodestar-")
    return _local_folders[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path no other run uses; nothing is created there yet."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/lodestar/{application}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    path = new_folder(df.sparkSession, label)
    df.write.options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(stored: DataFrame) -> int:
    """Size of a materialised table on disk."""
    files = stored.inputFiles()
    if not files:
        return 0
    spark = stored.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getContentSummary(folder).getLength()


def fits_in(stored: DataFrame, limit: int) -> bool:
    """Whether a materialised table takes at most ``limit`` bytes as rows in memory, where nothing is packed.

    On disk millions of numbers in order, or of equal values, may take a byte each or less.
    """
    if limit < 0 or stored_bytes(stored) > limit:
        return False
    fields = stored.schema.fields
    fixed = 8 * (len(fields) + 1)  # a word for each field, and one for what is NULL
    if fixed * stored.count() > limit:
        return False
    # only a table of few rows is read
    longer = [F.col(quoted(f.name)) for f in fields if not isinstance(f.dataType, _ONE_WORD)]
    more = sum((F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) for c in longer), F.lit(fixed))
    return (stored.agg(F.sum(more)).first()[0] or 0) <= limit


def discard(*stored: DataFrame) -> None:
    """Remove materialised tables that no later step reads."""
    for df in stored:
        folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
        for folder in folders:
            delete_folder(df.sparkSession, folder)


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    entries = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [entry.getPath().getName() for entry in entries]


def rename_folder(spark: SparkSession, path: str, to: str) -> None:
    source = spark._jvm.org.apache.hadoop.fs.Path(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system it lives on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Remove every intermediate table of this application."""
    application = spark.sparkContext.applicationId
    delete_folder(spark, f"{shared_folder(spark)}/lodestar/{application}")
