"""Surrogate keys from blocks that loads reserve, so that several may number their rows at the same time.

``assign_surrogate_keys`` gives dense keys in key order, from one global sort and
after the greatest key there is: one load at a time. Here a load stores its rows
as they lie in its tasks, counts them per task, and claims as many blocks of
``BLOCK`` keys as it needs. A claim is an empty file named by the number of its
block, which only one load can create. Rows get the keys of their task's blocks by
their place; nothing is sorted, and no dimension is scanned.

Keys are unique over all loads that share a folder, and positive. They are
neither dense nor ordered: each task leaves the rest of its last block unused,
and so does a load that dies after claiming. The rows of a load are kept under
its name, so a load that is repeated gets the keys it had. An empty load claims
nothing.
"""

from __future__ import annotations

import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestar.names import Plain, column
from lodestar.scratch import folder_exists, folder_names, materialise, rename_folder

#: Keys of a block. Smaller ones leave smaller gaps, larger ones need fewer claims.
BLOCK = 100_000
_CLAIM = "block-"
_claiming = threading.Lock()


def claim_blocks(spark: SparkSession, path: str, wanted: int) -> list[int]:
    """The numbers of ``wanted`` blocks that nobody else has or gets."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/claims")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    taken = [int(n.removeprefix(_CLAIM)) for n in folder_names(spark, f"{path}/claims") if n.startswith(_CLAIM)]
    number, claimed = max(taken, default=-1) + 1, []
    while len(claimed) < wanted:
        file = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{_CLAIM}{number:012d}")
        try:
            with _claiming:
                system.create(file, False).close()
            claimed.append(number)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
        number += 1
    return claimed


def keys_from_blocks(
    rows: DataFrame, path: str, load: str, out: str = "surrogate_key", block: int = BLOCK
) -> DataFrame:
    """``rows`` with the key column ``out``; ``load`` names this load among those that share the folder ``path``."""
    spark = rows.sparkSession
    kept = f"{path}/loads/{load}"
    plain = Plain(rows.drop(column(out)))
    if not folder_exists(spark, kept):
        placed = plain.df.withColumn("id", F.monotonically_increasing_id())
        # the task in the upper bits, the row's place there in the lower 33
        task, place = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
        stored = materialise(placed.withColumns({"task": task, "part": F.floor(place / block), "place": place % block}), "placed")
        # a row per task and block
        parts = [tuple(r) for r in stored.select("task", "part").distinct().orderBy("task", "part").collect()]
        claimed = claim_blocks(spark, path, len(parts))
        dealt = spark.createDataFrame(
            [(*part, number) for part, number in zip(parts, claimed)], "task bigint, part bigint, block bigint"
        )
        key = F.col("block") * block + F.col("place") + 1
        keyed = stored.join(F.broadcast(dealt), ["task", "part"]).select(*plain.plain, key.alias("key"))
        made = f"{path}/made-{uuid.uuid4().hex}"
        keyed.write.parquet(made)
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/loads")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        rename_folder(spark, made, kept)
    return plain.back(spark.read.parquet(kept), out)
