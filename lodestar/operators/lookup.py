"""Dimension keys for facts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window, functions as F

from lodestar.names import Plain, column
from lodestar.operators.merge import require_unique
from lodestar.operators.segments import (
    MAX_GROUP_ROWS,
    SEGMENT,
    attach,
    by_segment,
    hashable,
    last_place,
    lay_out,
    rows_at,
)
from lodestar.scratch import materialise

# With few versions per key a join on the key may look at all of them. Beyond, the cost of
# that join would be facts times versions; the answer is the same.
MAX_JOINED_VERSIONS = 32


@dataclass(frozen=True)
class Lookup:
    """How a fact finds its key in one dimension."""

    dimension: DataFrame
    fact_column: str
    business_key: str
    key: str
    out: str
    as_of: str | None = None
    unknown: object | None = None


def lookup_keys(
    fact: DataFrame,
    lookup: Lookup,
    *,
    max_joined_versions: int = MAX_JOINED_VERSIONS,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the dimension key ``lookup.out``; every fact row stays exactly one row.

    A dimension with history is read at its current version, or at the version
    valid at the fact's ``as_of`` column. Facts without a match get ``unknown``.
    """
    dimension = lookup.dimension
    rows = Plain(fact)
    mine = rows.of(lookup.fact_column)
    if lookup.as_of:
        plain = replace(lookup, fact_column=mine, as_of=rows.of(lookup.as_of), out="found")
        found = _as_of(rows.df, plain, max_joined_versions, max_group_rows)
    else:
        if "is_current" in dimension.columns:
            dimension = dimension.where("is_current")
        names = dimension.select(column(lookup.business_key).alias("_business_key"), column(lookup.key).alias("found"))
        require_unique(names, ["_business_key"], "the dimension")
        # No hint: below the broadcast threshold Catalyst avoids the shuffle,
        # above it AQE splits the partitions of a frequent key.
        found = rows.df.join(names, F.col(mine) == F.col("_business_key"), "left")
    if lookup.unknown is not None:
        found = found.withColumn("found", F.coalesce("found", F.lit(lookup.unknown)))
    return rows.back(found.select(*rows.plain, "found"), lookup.out)


def _as_of(
    fact: DataFrame, lookup: Lookup, max_joined_versions: int, max_group_rows: int
) -> DataFrame:
    """The last version that begins at or before the fact, if it has not ended by then.

    Both ways below give the same rows, for overlapping periods and gaps too.
    A version without a beginning is never found.
    """
    periods = lookup.dimension.select(
        column(lookup.business_key).alias("_business_key"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        column(lookup.key).alias(lookup.out),
    )
    # Stored, as the checks and the lookup would each compute the history again.
    periods = materialise(
        periods.where(F.col("_business_key").isNotNull() & F.col("_from").isNotNull()), "periods"
    )
    if _check_periods(periods) > max_joined_versions:
        return _as_of_sorted(fact, periods, lookup, max_group_rows)
    # few versions per key, so this window is small
    next_begins = F.lead("_from").over(Window.partitionBy("_business_key").orderBy("_from"))
    spans = periods.withColumn("_until", next_begins)
    at = F.col(lookup.as_of)
    last_before = (
        (F.col(lookup.fact_column) == F.col("_business_key"))
        & (F.col("_from") <= at)
        & (F.col("_until").isNull() | (at < F.col("_until")))
    )
    found = fact.join(spans, last_before, "left")
    still_valid = F.col("_to").isNull() | (at < F.col("_to"))
    return found.withColumn(lookup.out, F.when(still_valid, F.col(lookup.out))).drop(
        "_business_key", "_from", "_to", "_until"
    )


def _check_periods(periods: DataFrame) -> int:
    """The most versions of a key; two that begin together are an error. One aggregation."""
    begun = periods.groupBy("_business_key", "_from").agg(F.count("*").alias("versions"))
    most = begun.groupBy("_business_key").agg(
        F.count("*").alias("versions"),
        F.max(F.when(F.col("versions") > 1, F.struct("_business_key", "_from"))).alias("repeated"),
    )
    row = most.agg(F.max("versions").alias("versions"), F.max("repeated").alias("repeated")).first()
    if row["repeated"] is not None:
        raise ValueError(f"the dimension repeats the key {row['repeated'].asDict()}")
    return row["versions"] or 0


def _as_of_sorted(
    fact: DataFrame, periods: DataFrame, lookup: Lookup, max_group_rows: int
) -> DataFrame:
    """Facts and versions in one timeline per key; each fact takes the last version before it.

    Cost grows with facts plus versions, never with their product, however many
    versions a key has.
    """
    columns = fact.columns
    facts = fact.select(
        F.col(lookup.fact_column).alias("_key"),
        F.col(lookup.as_of).alias("_at"),
        F.lit(1).alias("_is_fact"),
        F.struct(*columns).alias("_fact"),
    )
    points = periods.select(
        F.col("_business_key").alias("_key"),
        F.col("_from").alias("_at"),
        F.lit(0).alias("_is_fact"),
        F.struct(F.col(lookup.out).alias("key"), F.col("_to").alias("to")).alias("_version"),
    )
    timeline = facts.unionByName(points, allowMissingColumns=True)
    # maps cannot be hashed; they are left out of what only balances the sort
    spread = [f"_fact.`{f.name}`" for f in fact.schema.fields if hashable(f.dataType)]
    tie = F.xxhash64(*spread) if spread else F.lit(0)
    layout = lay_out(timeline, ["_key"], [F.col("_at"), F.col("_is_fact"), tie], max_group_rows)
    so_far = Window.partitionBy(*layout.keys).orderBy("_at", "_is_fact").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = layout.rows.withColumn("_seen", F.last("_version", ignorenulls=True).over(so_far))
    if layout.split:
        rows = attach(rows, _last_versions(layout.rows), ["_key"])
        rows = rows.withColumn("_seen", F.coalesce("_seen", "_before"))
    still_valid = F.col("_seen.to").isNull() | (F.col("_at") < F.col("_seen.to"))
    return rows.where("_is_fact = 1").select(
        "_fact.*", F.when(still_valid, F.col("_seen.key")).alias(lookup.out)
    )


def _last_versions(timeline: DataFrame) -> DataFrame:
    """For each segment the last version, in earlier segments, of the key it begins with."""
    last_key = rows_at(timeline, last_place(timeline)).select(SEGMENT, "_key")
    points = timeline.where("_is_fact = 0")
    last_version = rows_at(points, last_place(points)).select(
        F.col(SEGMENT).alias("_at_segment"), F.col("_key").alias("_version_key"), "_version"
    )
    ends = last_key.join(F.broadcast(last_version), F.col(SEGMENT) == F.col("_at_segment"), "left")
    # A version of another key is not the one that the next segment continues with.
    own = F.when(F.col("_version_key") == F.col("_key"), F.col("_version"))
    so_far = Window.partitionBy("_key").orderBy(SEGMENT)
    ends = ends.withColumn("_version", F.last(own, ignorenulls=True).over(so_far))
    shifted = F.lag(F.struct("_key", F.col("_version").alias("_before"))).over(by_segment())
    return ends.select(SEGMENT, shifted.alias("_end")).select(SEGMENT, "_end.*")


def build_fact(facts: DataFrame, lookups: Sequence[Lookup], *, keep_business_keys: bool = False) -> DataFrame:
    """Replace the business keys of ``facts`` by dimension keys, or add these beside them."""
    for lookup in lookups:
        facts = lookup_keys(facts, lookup)
    if keep_business_keys:
        return facts
    outputs = {lookup.out for lookup in lookups}
    return facts.drop(*(column(l.fact_column) for l in lookups if l.fact_column not in outputs))
