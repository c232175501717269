"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition writes one run: the digests of its texts, sorted, with
the row they belong to. Runs then meet in rounds of ``FAN_IN`` neighbours. A
round shuffles by (parent run, digest), so each digest range of a parent is
merged by a task of its own, and the map side combines a run before it is
sent: in every round a digest arrives at most once from each child, however
many copies it has. After the last round one run is left with the row that
stays and the size of each class.

Spark's exchange stands for sending the slices of a digest range to their
parent, and its sorted aggregation for the multiway merge there; it sorts the
slices that arrive again rather than merging them as they are.

A class is verified at every level: rows meet only if the SHA-256 of the
text, a second 64-bit digest and the length all agree.

Null text counts as empty, so null and empty texts form one class. A null id
is smaller than any other. Rows that repeat the id that stays are told apart
by their place, so exactly one row of a class is kept. An empty table gives
an empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lodestar.llm.common import FILE, PLACE, column, lower_ascii, named_in, with_places, without_rows
from lodestar.scratch import discard, materialise

#: Runs that are merged at a time.
FAN_IN = 16

#: What two texts must share to be called equal.
DIGEST = ["_digest", "_check", "_length"]


def normalised(text: Column) -> Column:
    return F.coalesce(lower_ascii(text), F.lit(""))


def _digest(text: Column) -> list[Column]:
    return [
        F.unhex(F.sha2(text, 256)).alias("_digest"),
        F.xxhash64(text).alias("_check"),
        F.octet_length(text).alias("_length"),
    ]


def digest_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    more: Sequence[str] = (),
) -> DataFrame:
    """One sorted run for each partition of ``docs``, stored; ``_row`` tells rows apart."""
    rows = docs.select(
        column(docs, id_column).alias("_id"),
        normalised(column(docs, text_column)).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
        *more,
    )
    runs = rows.select("_id", "_row", *more, *_digest(F.col("_text")))
    return materialise(runs.sortWithinPartitions(*DIGEST), "digest-runs")


def merge_runs(runs: DataFrame, keep: str = "largest", fan_in: int = FAN_IN) -> DataFrame:
    """Merge all runs; a row per class with ``_keep_id``, ``_keep_row`` and ``_size``."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is largest or smallest, not {keep}")
    best = F.max if keep == "largest" else F.min
    # the place of a row has its partition in the upper bits
    run = F.shiftrightunsigned("_row", 33)
    last = runs.agg(F.max(run)).first()[0]
    level = runs.select(
        *DIGEST,
        run.alias("_node"),
        F.struct(F.col("_id").isNotNull().alias("known"), "_id", "_row").alias("_best")
        if keep == "largest"
        else F.struct(F.col("_id").isNull().alias("known"), "_id", "_row").alias("_best"),
        F.lit(1).cast("long").alias("_size"),
    )
    rounds = max(1, math.ceil(math.log((last or 0) + 1, fan_in) - 1e-9))
    for _ in range(rounds):
        parent = F.floor(F.col("_node") / fan_in).alias("_node")
        level = level.groupBy(parent, *DIGEST).agg(
            best("_best").alias("_best"), F.sum("_size").alias("_size")
        )
    return level.select(
        *DIGEST,
        F.col("_best._id").alias("_keep_id"),
        F.col("_best._row").alias("_keep_row"),
        "_size",
    )


def duplicate_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest"
) -> DataFrame:
    """One row per document: the id that stays of its class, the class size, and whether it stays."""
    runs = digest_runs(docs, id_column, text_column)
    # Stored, so that the join below may split a class that holds much of the input.
    classes = materialise(merge_runs(runs, keep).where("_size > 1"), "digest-classes")
    joined = runs.join(classes, DIGEST, "left")
    alone = F.col("_size").isNull()
    return joined.select(
        F.col("_id").alias(id_column),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def drop_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest"
) -> DataFrame:
    """``docs`` with one row of each class, all columns as they were."""
    rows = with_places(docs)
    runs = digest_runs(rows, named_in(rows, docs, id_column), named_in(rows, docs, text_column), [FILE, PLACE])
    classes = materialise(merge_runs(runs, keep).where("_size > 1"), "digest-classes")
    copies = runs.join(classes, DIGEST).where("_row <> _keep_row")
    dropped = materialise(copies.select(FILE, PLACE), "copies")
    discard(runs, classes)
    return without_rows(rows, dropped, docs)
