"""Rows that fail quality rules, kept beside those that pass.

Each row gets a mask with a bit for every rule it fails (the first rule is bit
0), in one pass that writes it to the folder of the rows that pass or to that of
the quarantined ones. A quarantined row has an identity, batch and place in it,
under which it can be corrected: a corrected row is judged like any other, in
the batch of the correction, and takes the place of the one it corrects whether
it passes or not.

Batches are numbered by the caller, and one that is repeated replaces itself. A
rule that is NULL for a row has failed. There may be up to 62 rules. Kept and
quarantined rows together are all rows dealt, less those that were corrected.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lodestar.operators.quality import holds
from lodestar.scratch import materialise

FAILED, BATCH, ROW, CORRECTS, SINK = "_failed", "_batch", "_row", "_corrects", "_sink"
KEPT, QUARANTINED = "kept", "quarantined"
TECHNICAL = [FAILED, BATCH, ROW, CORRECTS, SINK]


def failed_rules(rules: Mapping[str, str]) -> Column:
    """A bit for each rule that a row fails, in the order of ``rules``."""
    if len(rules) > 62:
        raise ValueError("a mask holds 62 rules")
    bits = (F.when(holds(rule), F.lit(0)).otherwise(F.lit(1 << i)).cast("bigint") for i, rule in enumerate(rules.values()))
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("bigint"))


def rule_names(rules: Mapping[str, str], mask: str = FAILED) -> Column:
    """The names of the rules in a mask."""
    names = F.array(*(F.when(F.col(mask).bitwiseAND(F.lit(1 << i)) != 0, F.lit(n)) for i, n in enumerate(rules)))
    return F.array_compact(names)


def deal(rows: DataFrame, rules: Mapping[str, str], path: str, batch_id: int) -> None:
    """Write rows to the kept or the quarantined ones of a batch, in one pass."""
    taken = {c.lower() for c in rows.columns}
    clash = [t for t in TECHNICAL if t in taken and t != CORRECTS]
    if clash:
        raise ValueError(f"the columns {clash} are those of the quarantine")
    if CORRECTS not in taken:
        rows = rows.withColumn(CORRECTS, F.lit(None).cast("struct<batch:bigint,row:bigint>"))
    judged = rows.withColumn(FAILED, failed_rules(rules)).withColumn(ROW, F.monotonically_increasing_id())
    sink = F.when(F.col(FAILED) == 0, KEPT).otherwise(QUARANTINED)
    dealt = judged.withColumn(SINK, sink)
    dealt.write.mode("overwrite").partitionBy(SINK).parquet(f"{path}/{BATCH}={batch_id}")


def _all(spark: SparkSession, path: str, schema: T.StructType, sink: str) -> DataFrame:
    """Dealt rows of one kind; ``schema`` is that of the rows as they were given."""
    technical = T.StructType(
        [
            T.StructField(CORRECTS, T.StructType([T.StructField("batch", T.LongType()), T.StructField("row", T.LongType())])),
            T.StructField(FAILED, T.LongType()),
            T.StructField(ROW, T.LongType()),
            T.StructField(BATCH, T.LongType()),
            T.StructField(SINK, T.StringType()),
        ]
    )
    every = T.StructType([*schema.fields, *technical.fields])
    try:
        stored = spark.read.schema(every).parquet(path)
    except AnalysisException:  # nothing has been dealt yet
        stored = spark.createDataFrame([], every)
    return stored.where(F.col(SINK) == sink)


def kept(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows that passed, with nothing added."""
    return _all(spark, path, schema, KEPT).drop(*TECHNICAL)


def quarantined(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows that failed and have not been corrected since, with ``FAILED``, ``BATCH`` and ``ROW``."""
    both = _all(spark, path, schema, KEPT).unionByName(_all(spark, path, schema, QUARANTINED))
    done = both.where(F.col(CORRECTS).isNotNull()).select(F.col(f"{CORRECTS}.batch").alias("b"), F.col(f"{CORRECTS}.row").alias("r"))
    open_rows = _all(spark, path, schema, QUARANTINED)
    left = open_rows.join(done, (F.col(BATCH) == F.col("b")) & (F.col(ROW) == F.col("r")), "left_anti")
    return left.drop(CORRECTS, SINK)


def replay(corrected: DataFrame, rules: Mapping[str, str], path: str, batch_id: int) -> None:
    """Deal corrected rows, which still have the ``BATCH`` and ``ROW`` that they had in the quarantine."""
    identity = F.struct(F.col(BATCH).alias("batch"), F.col(ROW).alias("row"))
    rows = corrected.withColumn(CORRECTS, identity).drop(FAILED, BATCH, ROW)
    # stored, as a quarantine that is read while it is written would change under the reader
    deal(materialise(rows, "corrected"), rules, path, batch_id)
