"""Incremental ingestion of Parquet files, with the files that have been read kept in a table.

The stream of ``lodestar.sources.ingest`` holds the name of every file it has
seen on the driver, and takes a file that is overwritten under its name for one
it knows. Here the *ledger* beside the checkpoint has a row per file and
reading: path, length, time, checksum and batch. What a folder holds now is
joined with it on the executors; the driver gets the names of one batch.

* A file that is not in the ledger is new.
* A file whose length or time differs from the ledger's was written again. It is
  read again, unless its checksum shows that the content is the same.
* ``current_rows`` leaves out the rows of earlier contents of a file.

A batch is complete when its folder ``_batch_id=N`` appears in the target, by a
rename. The rows that its files add to the ledger are written before that and
moved into the ledger after it; a run that dies in between is finished, or its
rows are thrown away, by the next one. So every content of a file is ingested
once, and the target never shows half of a batch.

A source without files gives an empty dataset. One run at a time per checkpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lodestar.operators.keys import assign_surrogate_keys
from lodestar.scratch import (
    delete_folder,
    discard,
    folder_exists,
    folder_names,
    materialise,
    rename_folder,
)
from lodestar.sources.ingest import (
    BATCH_ID,
    FILES_PER_BATCH,
    SOURCE_FILE,
    literal_path,
    read_files,
    read_ingested,
    remembered_schema,
    widen_schema,
)

#: Files up to this size have a checksum; larger ones are told apart by length and time.
CHECKSUM_BYTES = 256 << 20
#: Batches of the ledger, beyond which they are put into one.
COMPACT_AFTER = 64

#: ``file`` is the path as rows have it in ``_source_file``; ``ingested`` is false for a content known before.
LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("ingested", T.BooleanType()),
    ]
)


def listed_files(spark: SparkSession, source: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Path, length and time of the files in a folder; none is opened."""
    try:
        found = spark.read.format("binaryFile").options(**(options or {})).load(source)
    except AnalysisException:  # there is no such folder yet
        return spark.createDataFrame([], "path string, file string, length bigint, time timestamp")
    return found.select(
        "path", F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("time")
    )


def read_ledger(spark: SparkSession, checkpoint: str) -> DataFrame:
    """All entries; a checkpoint without ledger has none."""
    if not folder_exists(spark, f"{checkpoint}/ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(f"{checkpoint}/ledger")


def unseen(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that are new or differ from their last entry, with that entry's checksum as ``known``."""
    last = ledger.groupBy("path").agg(F.max(F.struct("batch", "length", "time", "checksum")).alias("last"))
    joined = listing.join(last, "path", "left")
    same = (F.col("last.length") == F.col("length")) & (F.col("last.time") == F.col("time"))
    return joined.where(~F.coalesce(same, F.lit(False))).select(*listing.columns, F.col("last.checksum").alias("known"))


def _checksums(spark: SparkSession, files: list[str]) -> DataFrame:
    """Path and SHA-256 of some files; each is read by one task."""
    contents = spark.read.format("binaryFile").load([literal_path(f) for f in files])
    return contents.select("path", F.sha2("content", 256).alias("checksum"))


def _move(spark: SparkSession, checkpoint: str, batch: int) -> None:
    rename_folder(spark, f"{checkpoint}/pending/batch-{batch}", f"{checkpoint}/ledger/batch-{batch}")


def _numbers(spark: SparkSession, folder: str, before: str) -> list[int]:
    """The numbers at the end of the names of what a folder holds."""
    if not folder_exists(spark, folder):
        return []
    return sorted(int(n.removeprefix(before)) for n in folder_names(spark, folder) if n.startswith(before))


def recover(spark: SparkSession, target: str, checkpoint: str) -> None:
    """Finish or forget what a run left that died."""
    done = set(_numbers(spark, target, f"{BATCH_ID}="))
    for batch in _numbers(spark, f"{checkpoint}/pending", "batch-"):
        if batch in done:
            _move(spark, checkpoint, batch)
        else:
            delete_folder(spark, f"{checkpoint}/pending/batch-{batch}")


def _make_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def _ingest_batch(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    known: T.StructType,
    files: DataFrame,
    batch: int,
    checksum_bytes: int,
    widen: bool,
) -> None:
    """Land the files of a stored batch, and enter them."""
    names = files.select("path", "length").collect()  # as many as a batch may have
    summed = [r["path"] for r in names if r["length"] <= checksum_bytes]
    if summed:
        files = files.join(_checksums(spark, summed), "path", "left")
    else:
        files = files.withColumn("checksum", F.lit(None).cast("string"))
    same = F.coalesce(F.col("known") == F.col("checksum"), F.lit(False))
    entries = files.select(
        "path", "file", "length", "time", "checksum", F.lit(batch).cast("bigint").alias("batch"), (~same).alias("ingested")
    )
    entries = materialise(entries, "entries")
    entries.coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}/pending/batch-{batch}")
    paths = sorted(literal_path(r["path"]) for r in entries.where("ingested").select("path").collect())
    if paths:
        # hidden from readers, as its name begins with a line and has no equals sign
        staged = f"{target}/_staged-{uuid.uuid4().hex}"
        known = widen_schema(spark, source, paths, checkpoint, known) if widen else known
        read_files(spark, source, paths, known).write.parquet(staged)
        rename_folder(spark, staged, f"{target}/{BATCH_ID}={batch}")
    _move(spark, checkpoint, batch)
    discard(entries)


def ingest_ledger(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    *,
    schema: T.StructType | None = None,
    max_files: int = FILES_PER_BATCH,
    options: Mapping[str, str] | None = None,
    checksum_bytes: int = CHECKSUM_BYTES,
    widen: bool = False,
) -> DataFrame:
    """Append the files that are new or written again since the last run; return the target.

    ``options`` are those of Spark's file sources; ``widen`` is that of ``ingest_stream``. Rows carry the same technical
    columns as those of ``ingest_stream``, older files come first.
    """
    known = remembered_schema(spark, source, checkpoint, schema)
    if known is None:
        return read_ingested(spark, target, None)
    _make_folder(spark, target)
    _make_folder(spark, f"{checkpoint}/ledger")
    recover(spark, target, checkpoint)
    arrived = unseen(listed_files(spark, source, options), read_ledger(spark, checkpoint))
    numbered = materialise(assign_surrogate_keys(arrived, ["time", "path"], 0, "number"), "arrived")
    ledger = f"{checkpoint}/ledger"
    used = [*_numbers(spark, target, f"{BATCH_ID}="), *_numbers(spark, ledger, "batch-"), *_numbers(spark, ledger, "all-")]
    first = max(used, default=-1) + 1
    for i in range(-(-numbered.count() // max_files)):
        files = numbered.where(F.col("number").between(i * max_files + 1, (i + 1) * max_files)).drop("number")
        _ingest_batch(spark, source, target, checkpoint, known, files, first + i, checksum_bytes, widen)
        known = remembered_schema(spark, source, checkpoint)
    discard(numbered)
    if len(_numbers(spark, f"{checkpoint}/ledger", "batch-")) > COMPACT_AFTER:
        compact_ledger(spark, checkpoint)
    return read_ingested(spark, target, known)


def compact_ledger(spark: SparkSession, checkpoint: str) -> None:
    """Put all parts of the ledger into one.

    Entries say which batch they are of, so old and new parts may stand side by side.
    """
    parts = _numbers(spark, f"{checkpoint}/ledger", "batch-")
    if len(parts) < 2:
        return
    before = _numbers(spark, f"{checkpoint}/ledger", "all-")
    made = f"{checkpoint}/compacted-{uuid.uuid4().hex}"
    read_ledger(spark, checkpoint).distinct().write.parquet(made)
    rename_folder(spark, made, f"{checkpoint}/ledger/all-{parts[-1]}")
    for name in [f"batch-{n}" for n in parts] + [f"all-{n}" for n in before]:
        delete_folder(spark, f"{checkpoint}/ledger/{name}")


def superseded(ledger: DataFrame) -> DataFrame:
    """``file`` and ``batch`` of contents that a later one under the same name has replaced."""
    read = ledger.where("ingested").select("file", "batch").distinct()
    last = read.groupBy("file").agg(F.max("batch").alias("last"), F.count("*").alias("times")).where("times > 1")
    return read.join(last, "file").where("batch < last").select("file", "batch")


def current_rows(spark: SparkSession, landed: DataFrame, checkpoint: str) -> DataFrame:
    """The rows of ``landed`` that stem from the last content of their file."""
    old = superseded(read_ledger(spark, checkpoint)).toDF("_old_file", "_old_batch")
    gone = (F.col(SOURCE_FILE) == F.col("_old_file")) & (F.col(BATCH_ID) == F.col("_old_batch"))
    return landed.join(old, gone, "left_anti")
