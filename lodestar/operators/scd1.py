"""Type 1 dimensions: the current row per business key, under a stable surrogate key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestar.names import Plain, column, columns as named
from lodestar.operators.keys import assign_surrogate_keys, max_key
from lodestar.operators.merge import require_unique, upsert, upsert_pruned
from lodestar.operators.ranking import dedup_latest
from lodestar.scratch import discard, materialise
from lodestar.sources import tables

CREATED = "create_date"
UPDATED = "update_date"


def scd1_rows(
    incoming: DataFrame,
    dimension: DataFrame | None,
    key: str,
    surrogate: str,
    load_ts: Column | None = None,
) -> DataFrame:
    """Dimension rows for ``incoming`` (one row per key).

    Known customers keep their surrogate key and creation time, new ones get
    the next keys in key order. All rows carry ``load_ts`` as update time.
    """
    load_ts = F.current_timestamp() if load_ts is None else load_ts
    if dimension is None:
        new = assign_surrogate_keys(incoming, [key], 0, surrogate)
        return new.withColumns({UPDATED: load_ts, CREATED: load_ts})
    # One join tags the known rows with what they keep; the result is read twice and stored.
    known = dimension.select(
        column(key).alias("known"),
        column(surrogate).alias("surrogate"),
        F.to_timestamp(CREATED).alias("created")
        if dict(dimension.dtypes)[CREATED] == "string"
        else F.col(CREATED).alias("created"),
    )
    rows = Plain(incoming)
    mine = rows.of(key)
    tagged = materialise(rows.df.join(known, F.col(mine).eqNullSafe(F.col("known")), "left"), "scd1-tagged")
    require_unique(tagged, [mine], "the load or the dimension")
    new = rows.back(tagged.where("surrogate IS NULL").select(*rows.plain))
    new = assign_surrogate_keys(new, [key], max_key(dimension, surrogate), surrogate)
    new = new.withColumns({UPDATED: load_ts, CREATED: load_ts})
    existing = tagged.where("surrogate IS NOT NULL").select(*rows.plain, "surrogate", "created")
    existing = rows.back(existing, surrogate, CREATED)
    return new.unionByName(existing.withColumn(UPDATED, load_ts))


def scd1_upsert(
    spark: SparkSession,
    name: str,
    incoming: DataFrame,
    path: str,
    *,
    key: str,
    surrogate: str,
    latest: Sequence[str],
    technical: Sequence[str] = (),
    load_ts: Column | None = None,
    only_changed: bool = False,
    buckets: int | None = None,
    sliced: bool = False,
) -> None:
    """Load ``incoming`` into the dimension ``name``.

    Of several rows with one key the one with the greatest ``latest`` columns
    counts. ``technical`` columns are dropped after that. The rows are merged
    on the business key, which the surrogate key follows one to one. With
    ``only_changed`` an unchanged row keeps its update time. ``latest`` columns
    that are not technical stay in the dimension, and a row that is older by
    them than the one there changes nothing. A ``sliced`` dimension is one of
    ``upsert_pruned``, from its first load on.
    """
    rows = materialise(dedup_latest(incoming, [key], latest).drop(*named(technical)), "scd1-rows")
    dimension = tables.load(spark, name) if tables.exists(spark, name) else None
    attributes = [c for c in rows.columns if c != key] if only_changed else ()
    source = scd1_rows(rows, dimension, key, surrogate, load_ts)
    dropped = {c.lower() for c in technical}
    sequence = [c for c in latest if c.lower() not in dropped]
    if sliced:
        upsert_pruned(spark, name, source, [key], path, only_changed=attributes, sequence=sequence)
    else:
        upsert(
            spark, name, source, [key], path,
            only_changed=attributes, sequence=sequence, buckets=buckets,
        )
    discard(rows)
