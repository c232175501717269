"""Connected components of links, by contraction.

In each round every component takes the smallest neighbouring one as its
parent, chains of parents are followed to their ends, and links inside a
component vanish. Tables are stored between rounds, so lost executors repeat
one round only, and nothing but two counts per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestar.scratch import discard, materialise


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node that can be reached) of all linked nodes.

    ``links`` has the columns ``a`` and ``b``; null ends link nothing.
    """
    links = materialise(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    roots = materialise(nodes.select("node", F.col("node").alias("root")), "roots")
    while not links.isEmpty():
        old = (links, roots)
        both = links.select("a", "b").union(links.select("b", "a"))
        parents = both.groupBy("a").agg(F.min("b").alias("b")).where("b < a")
        parents = _flattened(materialise(parents.toDF("child", "parent"), "parents"))
        roots = materialise(
            roots.join(parents, F.col("root") == F.col("child"), "left").select(
                "node", F.coalesce("parent", "root").alias("root")
            ),
            "roots",
        )
        up = parents.toDF("child", "parent")
        moved = (
            links.join(up, F.col("a") == F.col("child"), "left")
            .select(F.coalesce("parent", "a").alias("a"), "b")
            .join(up, F.col("b") == F.col("child"), "left")
            .select("a", F.coalesce("parent", "b").alias("b"))
        )
        links = materialise(moved.where("a <> b").distinct(), "links")
        discard(*old, parents)
    discard(links)
    return roots


def _flattened(parents: DataFrame) -> DataFrame:
    """Every child with the last of its chain of parents; parents are smaller than children."""
    while True:
        next_up = parents.toDF("middle", "top")
        jumped = parents.join(next_up, F.col("parent") == F.col("middle"), "left")
        jumped = materialise(
            jumped.select("child", F.coalesce("top", "parent").alias("parent"), F.col("top").isNotNull().alias("moved")),
            "parents",
        )
        discard(parents)
        parents = jumped.select("child", "parent")
        if jumped.where("moved").isEmpty():
            return parents
