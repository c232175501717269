"""Incremental ingestion of Parquet files.

A stream over the source folder keeps track of which files are new. It yields
one row per file and does not open it. Each micro-batch then reads its files as a batch, after
comparing their schema with the remembered one, and writes them to its own
folder ``_batch_id=N``, so a replayed batch replaces itself.

Whatever does not fit the remembered schema is kept as JSON in ``_rescued_data``
under its own name: unknown columns, columns of a type that has none in common
with the remembered one (which are then NULL), and structs with fields of their
own, in arrays and maps too (of which the known fields are also read). Narrower
numbers are read as the wider ones remembered. No file stops the others.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lodestar.scratch import PACKED, folder_exists, folder_names, rename_folder
from lodestar.sources.widening import holds_all, known_part, widened

RESCUED = "_rescued_data"
SOURCE_FILE = "_source_file"
FILE_TIME = "_file_time"
BATCH_ID = "_batch_id"

# Columns that tell where a row came from, and in which order it arrived.
LINEAGE = [SOURCE_FILE, FILE_TIME, BATCH_ID]

# Fixed schema of a file entry; only the path is read.
FILE_ENTRY = "path string, modificationTime timestamp, length bigint, content binary"

# Beside the checkpoint, wider schemas are kept under this name and a number.
WIDENED = "schema-"

# New files per micro-batch; the driver holds their names.
FILES_PER_BATCH = 10_000

# By default a file stream ignores files that are a week older than the newest one it has
# seen. Copied files keep their times, so no age is too old here. The price is that the
# driver remembers the name of every file, some hundred bytes each.
ALL_AGES = {"maxFileAge": "36500d"}

# What Spark raises when the schemas of several files cannot be merged.
CONTRADICTION = (PySparkException, Py4JJavaError)


@dataclass(frozen=True)
class Dataset:
    """One dataset to ingest: a folder name, and optionally its schema."""

    file_name: str
    schema: T.StructType | None = None


def remembered_schema(
    spark: SparkSession, source: str, checkpoint: str, schema: T.StructType | None = None
) -> T.StructType | None:
    """The schema of the first run: given or inferred once, then kept beside the checkpoint, and widened.

    None for a folder without files, as long as no schema is given.
    """
    path = f"{checkpoint}/schema"
    wider = _widened_places(spark, checkpoint)
    try:
        text = spark.read.text(wider[-1] if wider else path, wholetext=True).first()[0]
        return T.StructType.fromJson(json.loads(text))
    except AnalysisException:
        schema = schema or _inferred_schema(spark, source)
        if schema is not None:
            spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(path)
        return schema


def _widened_places(spark: SparkSession, checkpoint: str) -> list[str]:
    """Where wider schemas are kept, the last one last."""
    if not folder_exists(spark, checkpoint):
        return []
    numbers = sorted(
        int(n.removeprefix(WIDENED)) for n in folder_names(spark, checkpoint) if n.startswith(WIDENED)
    )
    return [f"{checkpoint}/{WIDENED}{n}" for n in numbers]


def widen_schema(
    spark: SparkSession, source: str, files: list[str], checkpoint: str, known: T.StructType
) -> T.StructType:
    """The remembered schema, made as wide as some files need it, and remembered so.

    Files that were ingested before are not written anew: Spark reads narrower numbers as wider ones.
    """
    wide = known
    for _, found in readable_groups(spark, source, files):
        wide = widened(wide, found)
    if wide != known:
        place = f"{checkpoint}/{WIDENED}{len(_widened_places(spark, checkpoint)) + 1}"
        made = f"{checkpoint}/_made-{uuid.uuid4().hex}"
        spark.createDataFrame([(wide.json(),)], "value string").coalesce(1).write.text(made)
        rename_folder(spark, made, place)
    return wide


def _inferred_schema(spark: SparkSession, source: str) -> T.StructType | None:
    """The columns of all files; of one file, if their types contradict each other."""
    try:
        return spark.read.option("mergeSchema", True).parquet(source).schema
    except CONTRADICTION:
        pass
    try:
        return spark.read.parquet(source).schema
    except AnalysisException:
        return None


def literal_path(path: str) -> str:
    """The path with nothing left that reads as a pattern."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def readable_groups(
    spark: SparkSession, source: str, files: list[str]
) -> list[tuple[list[str], T.StructType]]:
    """Files in groups whose schemas can be merged: all of them, unless types contradict."""
    reader = spark.read.option("basePath", source).option("mergeSchema", True)
    try:
        return [(files, reader.parquet(*files).schema)]
    except CONTRADICTION:
        if len(files) == 1:
            raise
        half = len(files) // 2
        return [g for part in (files[:half], files[half:]) for g in readable_groups(spark, source, part)]


def _read_group(
    spark: SparkSession, source: str, files: list[str], found: T.StructType, known: T.StructType
) -> DataFrame:
    types = {f.name.lower(): f for f in known.fields}
    here = {f.name.lower(): f for f in found.fields}
    odd = [
        f
        for f in found.fields
        if f.name.lower() not in types or not holds_all(f.dataType, types[f.name.lower()].dataType)
    ]
    # a file without some of the columns has NULLs there
    absent = [f for f in known.fields if f.name.lower() not in here]
    rows = spark.read.option("basePath", source).schema(T.StructType([*found.fields, *absent])).parquet(*files)
    columns = [
        known_part(F.col(f"`{f.name}`"), here[f.name.lower()].dataType, f.dataType).alias(f.name)
        if f.name.lower() in here
        else F.col(f"`{f.name}`")
        for f in known.fields
    ]
    rescued = F.lit(None).cast("string")
    if odd:
        extra = [F.col(f"`{f.name}`") for f in odd]
        present = reduce(lambda a, b: a | b, (c.isNotNull() for c in extra))
        rescued = F.when(present, F.to_json(F.struct(*extra)))
    return rows.select(
        *columns,
        rescued.alias(RESCUED),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
    )


def read_files(
    spark: SparkSession, source: str, files: list[str], schema: T.StructType
) -> DataFrame:
    """Rows of ``files`` in the known schema, with all else packed into JSON."""
    groups = readable_groups(spark, source, files)
    parts = [_read_group(spark, source, some, found, schema) for some, found in groups]
    return reduce(DataFrame.unionAll, parts)


def start_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    *,
    schema: T.StructType | None = None,
    max_files: int = FILES_PER_BATCH,
    options: Mapping[str, str] | None = None,
    widen: bool = False,
) -> tuple[StreamingQuery | None, T.StructType | None]:
    """Start appending the files that are new since the last run; nothing starts without files.

    ``options`` are those of Spark's file sources, for example a file name pattern. With ``widen``
    the remembered schema grows where files have wider types, else such values are rescued.
    """
    known = remembered_schema(spark, source, checkpoint, schema)
    if known is None:
        return None, None
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(FILE_ENTRY)
        .options(**ALL_AGES, **(options or {}))
        .option("maxFilesPerTrigger", max_files)
        .load(source)
        .select("path")
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        files = [literal_path(row["path"]) for row in batch.collect()]
        if not files:
            return
        schema = remembered_schema(batch.sparkSession, source, checkpoint)
        if widen:
            schema = widen_schema(batch.sparkSession, source, sorted(files), checkpoint, schema)
        rows = read_files(batch.sparkSession, source, sorted(files), schema)
        rows.write.options(**PACKED).mode("overwrite").parquet(f"{target}/{BATCH_ID}={batch_id}")

    query = (
        arrivals.writeStream.foreachBatch(land)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/progress")
        .trigger(availableNow=True)
        .start()
    )
    return query, known


def ingest_stream(
    spark: SparkSession, source: str, target: str, checkpoint: str, **options
) -> DataFrame:
    """Append the files that are new since the last run, then stop; return the target.

    Progress lives in ``checkpoint``: a run without new files adds nothing.
    """
    query, known = start_ingest(spark, source, target, checkpoint, **options)
    if query is not None:
        query.awaitTermination()
        known = remembered_schema(spark, source, checkpoint)
    return read_ingested(spark, target, known)


def ingested_schema(known: T.StructType) -> T.StructType:
    """Columns of an ingested folder whose remembered schema is ``known``."""
    technical = T.StructType(
        [
            T.StructField(RESCUED, T.StringType()),
            T.StructField(SOURCE_FILE, T.StringType()),
            T.StructField(FILE_TIME, T.TimestampType()),
            T.StructField(BATCH_ID, T.LongType()),
        ]
    )
    return T.StructType([*known.fields, *technical.fields])


def read_ingested(spark: SparkSession, target: str, known: T.StructType | None) -> DataFrame:
    """What has been ingested; a dataset without any file yet has technical columns only."""
    if known is None:
        return spark.createDataFrame([], ingested_schema(T.StructType()))
    return spark.read.schema(ingested_schema(known)).parquet(target)


def ingest_all(
    spark: SparkSession, datasets: Iterable[Dataset], source: str, bronze: str, checkpoints: str
) -> dict[str, DataFrame]:
    """Ingest every dataset of the list from ``source/NAME`` to ``bronze/NAME``.

    The datasets are independent, so their streams run side by side.
    """
    started = {}
    try:
        for d in datasets:
            started[d.file_name] = start_ingest(
                spark,
                f"{source}/{d.file_name}",
                f"{bronze}/{d.file_name}",
                f"{checkpoints}/{d.file_name}",
                schema=d.schema,
            )
    finally:  # a dataset that cannot start leaves no other one running alone
        for query, _ in started.values():
            if query is not None:
                query.awaitTermination()
    return {
        name: read_ingested(spark, f"{bronze}/{name}", known)
        for name, (_, known) in started.items()
    }
