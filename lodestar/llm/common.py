"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import string
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

import lodestar
from lodestar.scratch import materialise

#: The most bytes of text that Spark hands a Python worker at a time.
BATCH_BYTES = 4 << 20


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and everything else untouched."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def column(df: DataFrame, name: str) -> Column:
    """The column called ``name``, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_shipped: set[str] = set()


def prepare_workers(spark: SparkSession) -> None:
    """Give Python workers this package, and texts in batches bounded by bytes, as rows may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="package-", dir=SparkFiles.getRootDirectory())
        package = Path(lodestar.__file__).parent
        archive = f"{folder}/lodestar.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def map_batches(
    docs: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]],
    added: Sequence[T.StructField],
) -> DataFrame:
    """``docs`` with the columns ``added``, whatever the names of its own columns.

    ``function`` gets batches whose columns stand as in ``docs``, and gives all
    columns of the result for some of the rows at a time.
    """
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    schema = T.StructType([*fields, *(T.StructField(f"a{i}", f.dataType) for i, f in enumerate(added))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            yield pa.RecordBatch.from_arrays(columns, names=names)

    plain = docs.toDF(*(f.name for f in fields))
    return plain.mapInArrow(run, schema).toDF(*docs.columns, *(f.name for f in added))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The file (as a hash of its path) and the place there: what tells rows of a table apart.
FILE, PLACE = "_file_hash", "_file_place"

#: The most rows of two numbers that are broadcast; more are shuffled.
BROADCAST_ROWS = 1_000_000


def with_places(docs: DataFrame) -> DataFrame:
    """``docs`` with ``FILE`` and ``PLACE``, which are the same whenever the result is read.

    Rows of files have a place already. Any other table is stored first. Columns of ``docs``
    keep their order; those that have one of the two names get another (``named_in``).
    """
    taken = {c.lower() for c in docs.columns}
    clashing = {c: fresh_name(docs, c + "_") for c in docs.columns if c.lower() in (FILE, PLACE)}
    marks = [
        F.xxhash64(F.col("_metadata.file_path")).alias(FILE),
        F.col("_metadata.row_index").alias(PLACE),
    ]
    names = [clashing.get(c, c) for c in docs.columns]
    if "_metadata" not in taken:
        try:
            return docs.select(*(column(docs, c).alias(n) for c, n in zip(docs.columns, names)), *marks)
        except AnalysisException:
            pass  # not a scan of files
    plain = [f"c{i}" for i in range(len(names))]
    stored = materialise(docs.toDF(*plain), "placed")
    return stored.select(*(F.col(p).alias(n) for p, n in zip(plain, names)), *marks)


def named_in(placed: DataFrame, docs: DataFrame, name: str) -> str:
    """What the column ``name`` of ``docs`` is called in ``with_places(docs)``."""
    lower = [c.lower() for c in docs.columns]
    return placed.columns[lower.index(name.lower())]


def without_rows(placed: DataFrame, dropped: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, of which ``placed`` has the places, that are not in ``dropped`` (stored FILE and PLACE)."""
    few = dropped.count() <= BROADCAST_ROWS
    side = F.broadcast(dropped) if few else dropped.hint("shuffle_hash")
    return placed.join(side, [FILE, PLACE], "left_anti").drop(FILE, PLACE).toDF(*docs.columns)
