"""What has changed between two snapshots of a table, from digests of key ranges summed up in a tree.

A table that is overwritten as a whole tells nobody which rows changed. Here its
last snapshot is kept as a table in buckets of a hash of the keys, with a tree of
digests beside it. A leaf of the tree is a range of the hash and holds the number
of its rows and two exclusive-ors of 64-bit row hashes, a parent those of its
``FAN_OUT`` children. A new snapshot is read once for its own tree. The trees
are compared from the root down, children only below nodes that differ; what
lies in equal ranges is neither joined nor, of the kept snapshot, read.

Rows of ranges that differ are compared by value. ``advance`` replaces the
buckets in which something changed. If it is not reached, the same changes come
again, so whoever takes them must bear that, as merges and histories do.

Keys match NULL-safe and may not repeat within a range that differs. Columns
must be of types that Spark can hash (no maps). An empty snapshot deletes every
row; a first one inserts every row. Column names are free.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestar.names import Plain
from lodestar.operators.merge import require_unique
from lodestar.operators.segments import same
from lodestar.scratch import delete_folder, discard, folder_exists, folder_names, materialise, rename_folder
from lodestar.sources import tables

#: Children of a node, and levels below the root.
FAN_OUT, LEVELS = 64, 3
#: Nodes that are named in a filter; more are joined.
NAMED_NUMBERS = 200
#: The column that says what happened to a row.
CHANGE = "_change"

INSERTED, UPDATED, DELETED = "inserted", "updated", "deleted"


def _leaf(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FAN_OUT**LEVELS)).cast("int")


def _bucket(leaf: Column, buckets: int) -> Column:
    """Buckets are ranges of leaves, so that a bucket is read for a few of them."""
    return F.floor(leaf * buckets / FAN_OUT**LEVELS).cast("int")


def digest_tree(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``level``, ``node``, ``rows`` and two digests for every node that has rows; the root is level 0."""
    plain = Plain(rows)
    every = F.struct(*plain.plain)
    leaves = plain.df.groupBy(_leaf(plain.all_of(keys)).alias("node")).agg(
        F.count("*").alias("rows"),
        F.bit_xor(F.xxhash64(every)).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(1), every)).alias("two"),
    )
    # a row per leaf from here on
    above = F.explode(F.array(*(F.struct(F.lit(i).alias("level"), F.lit(FAN_OUT ** (LEVELS - i)).alias("of")) for i in range(LEVELS + 1))))
    spread = leaves.withColumn("above", above)
    return spread.groupBy("above.level", F.floor(F.col("node") / F.col("above.of")).cast("int").alias("node")).agg(
        F.sum("rows").alias("rows"), F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two")
    )


def differing_leaves(old: DataFrame, new: DataFrame) -> list[int]:
    """Leaves whose rows differ, found from the root down; only children of differing nodes are looked at."""
    found: list[int] = []
    for level in range(LEVELS + 1):
        sides = []
        for tree in (old, new):
            nodes = tree.where(F.col("level") == level)
            if level:
                parents = nodes.withColumn("parent", F.floor(F.col("node") / FAN_OUT).cast("int"))
                nodes = _among(parents, "parent", found)
            sides.append(nodes.select("node", F.struct("rows", "one", "two").alias("digest")))
        one, other = (s.toDF("node", f"digest{i}") for i, s in enumerate(sides))
        differ = one.join(other, "node", "full_outer").where(~F.col("digest0").eqNullSafe(F.col("digest1")))
        found = sorted(r["node"] for r in differ.select("node").collect())
        if not found:
            return []
    return found


def _among(rows: DataFrame, name: str, numbers: Sequence[int]) -> DataFrame:
    """Rows whose ``name`` is one of ``numbers``, of which there are no more than leaves."""
    if len(numbers) <= NAMED_NUMBERS:  # a filter that the scan can use
        return rows.where(F.col(name).isin(list(numbers)))
    wanted = rows.sparkSession.createDataFrame([(n,) for n in numbers], f"{name} int")
    return rows.join(F.broadcast(wanted), name, "left_semi")


_LEAF = "leaf"


def _stored_tree(spark: SparkSession, path: str) -> DataFrame | None:
    """The tree of the kept snapshot, which is the last one that was completed."""
    folder = f"{path}/trees"
    made = sorted(n for n in folder_names(spark, folder) if n.startswith("tree-")) if folder_exists(spark, folder) else []
    return spark.read.parquet(f"{folder}/{made[-1]}") if made else None


class Snapshot:
    """A snapshot compared with the one kept under ``name`` (folder ``path``)."""

    def __init__(
        self, spark: SparkSession, name: str, path: str, rows: DataFrame, keys: Sequence[str], buckets: int = 256
    ):
        if buckets > FAN_OUT**LEVELS:
            raise ValueError("there cannot be more buckets than leaves")
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        self.keys, self.rows = list(keys), rows
        self.plain = Plain(rows)
        self.tree = materialise(digest_tree(rows, keys).orderBy("level", "node"), "tree")
        self.old_tree = _stored_tree(spark, path) if tables.exists(spark, name) else None
        if self.old_tree is None:
            self.leaves = [r["node"] for r in self.tree.where(F.col("level") == LEVELS).select("node").collect()]
        else:
            kept = tables.load(spark, name).drop(_LEAF)
            if [d for _, d in kept.dtypes] != [d for _, d in rows.dtypes]:
                raise ValueError(f"the snapshot has columns {rows.dtypes}, the one before {kept.dtypes}")
            self.leaves = differing_leaves(self.old_tree, self.tree)

    @property
    def touched(self) -> list[int]:
        """The buckets of leaves that differ."""
        return sorted({leaf * self.buckets // FAN_OUT**LEVELS for leaf in self.leaves})

    def _given(self) -> DataFrame:
        """Plain rows of the new snapshot with their leaf."""
        return self.plain.df.withColumn(_LEAF, _leaf(self.plain.all_of(self.keys)))

    def kept(self) -> DataFrame:
        """Plain rows of the kept snapshot in the ranges that differ."""
        stored = tables.load(self.spark, self.name, only=self.touched)
        return _among(stored, _LEAF, self.leaves).drop(_LEAF)

    def changes(self) -> DataFrame:
        """Rows inserted, updated (as they are now) and deleted (as they were), with ``CHANGE``."""
        new = _among(self._given(), _LEAF, self.leaves).drop(_LEAF)
        if self.old_tree is None or not self.leaves:
            return self.plain.back(new.withColumn(CHANGE, F.lit(INSERTED)), CHANGE)
        new = materialise(new, "given")
        keys = self.plain.all_of(self.keys)
        require_unique(new, keys, "the snapshot")
        old = self.kept().toDF(*(f"old_{c}" for c in self.plain.plain))
        pairs = same([F.col(k) for k in keys], [F.col(f"old_{k}") for k in keys])
        joined = new.withColumn("is", F.lit(True)).join(old.withColumn("was", F.lit(True)), pairs, "full_outer")
        values = [[F.col(f"{p}{c}") for c in self.plain.plain] for p in ("", "old_")]
        change = (
            F.when(F.col("was").isNull(), INSERTED).when(F.col("is").isNull(), DELETED).when(~same(*values), UPDATED)
        )
        told = joined.withColumn("change", change).where("change IS NOT NULL")
        row = [F.when(F.col("is").isNull(), F.col(f"old_{c}")).otherwise(F.col(c)).alias(c) for c in self.plain.plain]
        return self.plain.back(told.select(*row, "change"), CHANGE)

    def advance(self) -> None:
        """Keep the new snapshot in place of the old one, bucket by bucket where they differ."""
        if self.old_tree is not None and not self.leaves:
            return
        bucketed = self._given().withColumn(tables.BUCKET, _bucket(F.col(_LEAF), self.buckets))
        if self.old_tree is None:
            if not tables.exists(self.spark, self.name):
                tables.create_partitioned(bucketed.drop(tables.BUCKET), self.name, self.path)
            touched = tables.bucket_numbers(self.spark, self.name)
        else:
            touched = self.touched
            bucketed = bucketed.where(F.col(tables.BUCKET).isin(touched))
        tables.move_partitions(bucketed, self.name, self.path, emptied=touched, sort_by=[_LEAF])
        # the tree counts once it is there under its name; until then all is compared with the one before
        before = folder_names(self.spark, f"{self.path}/trees") if folder_exists(self.spark, f"{self.path}/trees") else []
        made = f"{self.path}/made-{uuid.uuid4().hex}"
        self.tree.write.parquet(made)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/trees")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)
        number = max((int(n.removeprefix("tree-")) for n in before if n.startswith("tree-")), default=-1) + 1
        rename_folder(self.spark, made, f"{self.path}/trees/tree-{number:09d}")
        for n in before:
            delete_folder(self.spark, f"{self.path}/trees/{n}")
        discard(self.tree)


def snapshot_changes(
    spark: SparkSession, name: str, path: str, rows: DataFrame, keys: Sequence[str], buckets: int = 256
) -> DataFrame:
    """What has changed since the snapshot kept under ``name``, which stays as it is."""
    return Snapshot(spark, name, path, rows, keys, buckets).changes()


def feed_changes(
    spark: SparkSession,
    name: str,
    path: str,
    rows: DataFrame,
    keys: Sequence[str],
    apply: Callable[[DataFrame], None],
    buckets: int = 256,
) -> list[int]:
    """Give ``apply`` what has changed since the last call, then keep this snapshot; the buckets that differed."""
    snapshot = Snapshot(spark, name, path, rows, keys, buckets)
    if snapshot.leaves or snapshot.old_tree is None:
        changes = materialise(snapshot.changes(), "changes")
        apply(changes)
        snapshot.advance()
        discard(changes)
    return snapshot.touched
