"""Shards of equal bytes by a K-d tree over document metadata.

Every node of the tree is split at the weighted median of its documents along
its widest dimension, until leaves are as small as wanted or there are as many
as wanted. Weights are bytes, so all leaves hold nearly the same number.

The medians are exact up to ``TOLERANCE`` and found together for all nodes of a
level, from histograms: one pass over the stored metadata cuts the values of
each node into ``CELLS`` and sums their bytes, and the cell that holds the
median is cut again, from its smallest value to its largest. So an outlier costs
a pass, and no more. Only documents of one and the same value are told apart by
other means: bits of a hash of id and text, then bits of a hash of the row, as
digits, again with a pass for each. Equal documents and even repeated rows can
so be split like any others. The driver sees a row per node and pass, never
documents.

The law is ``bytes``. Equal texts of different metadata may lie in different
shards, and a large group of equal texts is split if the sizes ask for it.

Null text has no bytes, and each document weighs its bytes plus one. Infinite
metadata stand just beyond the smallest or largest finite value, null and NaN
below all. An empty table gives no rows. Columns not named as dimensions are not
looked at.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestar.llm.common import column
from lodestar.scratch import discard, materialise

#: Cells that the values of a node are cut into in a pass, and values of a digit.
CELLS = 4096
#: Part of a node's bytes by which a split may miss the median.
TOLERANCE = 1e-4
_LARGEST = sys.float_info.max
#: Digits of each of the two hashes: 12 bits each, the upper ones first.
HASH_DIGITS = 3


#: What is known of the split of a node: bytes that shall go left; the values among which the boundary
#: is, and the bytes below them; the digits of the boundary if these are equal; and, when it is found,
#: the value there and whether documents of that value go left (null: those whose digits are not above).
SPLITS = (
    "_node bigint, dimension int, low double, high double, wanted bigint, near bigint,"
    " digits array<int>, below bigint, cut double, inclusive boolean"
)


def _value(names: Sequence[str]) -> Column:
    """A document's value along the dimension of its node's split."""
    return F.element_at(F.array(*names), F.col("dimension") + 1)


def _cell(value: Column) -> Column:
    """The cell of a value between ``low`` and ``high``; halves, as the difference may be too large for a double."""
    scaled = (value / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * CELLS
    return F.least(F.greatest(scaled, F.lit(0.0)), F.lit(CELLS - 1.0)).cast("int")


def _goes_right(names: Sequence[str]) -> Column:
    """Whether a document lies beyond the boundary of its node; false without a split."""
    value = _value(names)
    tied = F.slice("_ties", 1, F.size("digits")) > F.col("digits")
    at_cut = F.when(F.col("inclusive").isNull(), tied).otherwise(~F.col("inclusive"))
    return F.coalesce((value > F.col("cut")) | ((value == F.col("cut")) & at_cut), F.lit(False))


def _bits(key: Column) -> list[Column]:
    """The digits of a 64-bit hash of ``key``."""
    hashed = F.xxhash64(key)
    return [
        F.shiftrightunsigned(hashed, 52 - 12 * at).bitwiseAND(F.lit(CELLS - 1)).cast("int")
        for at in range(HASH_DIGITS)
    ]


def _open_splits(
    stored: DataFrame, names: Sequence[str], leaves: dict[int, int], whole: list[float]
) -> dict[int, dict]:
    """The widest dimension of every node that is to be split, and the bytes that go left."""
    ends = [f(c).alias(f"{n}_{i}") for i, c in enumerate(names) for n, f in (("low", F.min), ("high", F.max))]
    rows = stored.groupBy("_node").agg(F.sum("_size").alias("bytes"), *ends).collect()
    found = {}
    for row in rows:
        spans = [(row[f"low_{i}"], row[f"high_{i}"]) for i in range(len(names))]
        whole.extend(max(high / 2 - low / 2, 1e-9) for low, high in spans if len(whole) < len(names))
        count = leaves[row["_node"]]
        if count < 2:
            continue
        widest = max(range(len(names)), key=lambda i: (spans[i][1] / 2 - spans[i][0] / 2) / whole[i])
        found[row["_node"]] = {
            "_node": row["_node"],
            "dimension": widest,
            "low": spans[widest][0],
            "high": spans[widest][1],
            "wanted": row["bytes"] * (count // 2) // count,
            "near": max(int(row["bytes"] * TOLERANCE), 1),
            "digits": [],
            "below": 0,
            "cut": None,
            "inclusive": None,
        }
    return found


def _find_medians(stored: DataFrame, names: Sequence[str], splits: dict[int, dict]) -> None:
    """Close in on the boundaries of all nodes of a level, a pass at a time, until they are near enough."""
    spark = stored.sparkSession
    last = 2 * HASH_DIGITS
    while True:
        active = [s for s in splits.values() if s["cut"] is None]
        if not active:
            return
        known = spark.createDataFrame([tuple(s.values()) for s in active], SPLITS)
        # one row per node
        value, among = _value(names), F.size("digits")
        within = value.between(F.col("low"), F.col("high")) & (F.slice("_ties", 1, among) == F.col("digits"))
        digit = F.when(F.col("low") < F.col("high"), _cell(value)).otherwise(F.element_at("_ties", among + 1))
        place = stored.join(F.broadcast(known), "_node").where(within)
        sums = place.groupBy("_node", "wanted", "below", digit.alias("digit")).agg(
            F.sum("_size").alias("held"), F.min(value).alias("least"), F.max(value).alias("most")
        )
        upto = Window.partitionBy("_node").orderBy("digit")
        reached = sums.withColumn("upto", F.col("below") + F.sum("held").over(upto))
        first = reached.where("upto >= wanted").groupBy("_node").agg(
            F.min(F.struct("digit", "held", "upto", "least", "most")).alias("at")
        )
        for row in first.collect():
            split, (digit, held, upto_here, least, most) = splits[row["_node"]], row["at"]
            tied = split["low"] == split["high"]
            split["below"] = upto_here - held
            short, over = split["wanted"] - split["below"], upto_here - split["wanted"]
            near = min(short, over) <= split["near"] or tied and len(split["digits"]) == last - 1
            if tied:
                # the boundary lies behind this digit or before it, whichever is closer
                split["digits"].append(digit - 1 if near and over > short else digit)
                split["cut"] = least if near else None
            elif near:
                split["cut"], split["inclusive"] = (most, True) if over <= short else (least, False)
            else:
                split["low"], split["high"] = least, most


def kd_shards(
    docs: DataFrame,
    dimensions: Sequence[str],
    shards: int | None = None,
    target_bytes: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document with its id, size, checksum of the text, shard and slot.

    ``dimensions`` are numeric or string columns; strings count by their order of
    frequency. Give the number of shards, or the bytes that a shard should hold.
    """
    spark = docs.sparkSession
    stored, names = _metadata(docs, dimensions, id_column, text_column)
    summary = stored.agg(F.sum("_size"), F.count("*")).first()
    total, rows = summary[0] or 0, summary[1]
    wanted = shards or max(1, math.ceil(total / (target_bytes or total or 1)))
    leaves, whole = {0: wanted}, []
    stored = stored.withColumn("_node", F.lit(0).cast("long"))
    while rows and max(leaves.values()) > 1:
        splits = _open_splits(stored, names, leaves, whole)
        _find_medians(stored, names, splits)
        known = spark.createDataFrame([tuple(s.values()) for s in splits.values()], SPLITS)
        joined = stored.join(F.broadcast(known), "_node", "left")
        node = (F.col("_node") * 2 + F.when(_goes_right(names), 1).otherwise(0)).alias("_node")
        placed = materialise(joined.select(*(c for c in stored.columns if c != "_node"), node), "metadata")
        discard(stored)
        stored = placed
        below = {}
        for n, count in leaves.items():
            left = count // 2 if n in splits else count
            below |= {2 * n: left} | ({2 * n + 1: count - left} if left < count else {})
        leaves = below
    shard_of = spark.createDataFrame(list(zip(sorted(leaves), range(len(leaves)))), "_node bigint, shard int")
    placed = stored.join(F.broadcast(shard_of), "_node")
    return _slots(placed, rows, len(leaves), id_column)


def _metadata(docs: DataFrame, dimensions: Sequence[str], id_column: str, text_column: str):
    """Id, size, checksum and numeric dimensions of every document, stored once."""
    spark = docs.sparkSession
    text = column(docs, text_column)
    names = [f"_dimension{i}" for i in range(len(dimensions))]
    kinds = dict(docs.dtypes)
    values, ranks = [], {}
    for name, dimension in zip(names, dimensions):
        value = column(docs, dimension)
        if kinds[dimension] == "string":
            ranks[name] = value
            values.append(value.alias(name))
        else:
            values.append(value.cast("double").alias(name))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows = docs.select(
        column(docs, id_column).alias("_id"),
        size.alias("_size"),
        F.coalesce(F.crc32(text), F.lit(0)).alias("_crc"),
        F.monotonically_increasing_id().alias("_row"),
        *values,
    )
    rows = rows.select("*", F.array(*_bits(F.struct("_id", "_crc", "_size")), *_bits(F.col("_row"))).alias("_ties"))
    stored = materialise(rows, "metadata")
    for name in ranks:
        # the order of frequency, for as many values as there are cells; rarer ones share the last
        common = stored.groupBy(name).count().orderBy(F.desc("count"), name).limit(CELLS)
        listed = [row[name] for row in common.collect()]
        order = spark.createDataFrame(
            [(value, float(i)) for i, value in enumerate(listed)], "value string, place double"
        )
        stored = (
            stored.join(F.broadcast(order), F.col(name).eqNullSafe(F.col("value")), "left")
            .withColumn(name, F.coalesce("place", F.lit(float(CELLS))))
            .drop("value", "place")
        )
    # numbers: what is not finite stands beyond the finite ones
    plain = [n for n in names if n not in ranks]
    if plain:
        finite = {n: F.when(F.abs(n) < math.inf, F.col(n)) for n in plain}
        ends = stored.agg(
            *(f(finite[n]).alias(f"{end}{n}") for n in plain for end, f in (("least", F.min), ("most", F.max)))
        ).first()
        for n in plain:
            least, most = (0.0 if ends[f"{end}{n}"] is None else ends[f"{end}{n}"] for end in ("least", "most"))
            apart = max((most / 2 - least / 2) / 50, 1.0)
            lowest, low, high = (max(least - 2 * apart, -_LARGEST), max(least - apart, -_LARGEST), min(most + apart, _LARGEST))
            stored = stored.withColumn(
                n, F.when(F.col(n).isNull() | F.isnan(n), lowest).when(F.col(n) == math.inf, high)
                .when(F.col(n) == -math.inf, low).otherwise(F.col(n))
            )
    return stored, names


def _slots(placed: DataFrame, rows: int, shards: int, id_column: str) -> DataFrame:
    """Number the documents of each shard from 0, in about the root of their number of tasks' windows."""
    chunks = max(1, math.isqrt(max(rows // shards, 1)))
    chunk = F.pmod(F.xxhash64("_row"), F.lit(chunks))
    chunked = placed.withColumn("_chunk", chunk)
    sizes = chunked.groupBy("shard", "_chunk").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "shard", "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("shard", "_chunk").orderBy("_row")
    numbered = chunked.withColumn("_place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "_chunk"]).select(
        F.col("_id").alias(id_column),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_offset") + F.col("_place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
