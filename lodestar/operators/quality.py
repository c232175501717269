"""Named quality rules."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F


def holds(rule: str) -> Column:
    """A rule that evaluates to NULL counts as failed."""
    return F.coalesce(F.expr(rule), F.lit(False))


def failures(rules: Mapping[str, str]) -> list[Column]:
    """One aggregate per rule: the number of rows that fail it."""
    return [F.count_if(~holds(rule)).alias(name) for name, rule in rules.items()]


def expect_all_or_drop(
    df: DataFrame, rules: Mapping[str, str], observe_as: Observation | str | None = None
) -> DataFrame:
    """Keep rows that pass every rule.

    With ``observe_as`` the number of failing rows per rule is measured in the
    same pass: by an ``Observation``, or by a name found in a stream's progress.
    """
    if observe_as is not None:
        df = df.observe(observe_as, F.count(F.lit(1)).alias("rows"), *failures(rules))
    return df.where(reduce(lambda a, b: a & b, map(holds, rules.values())))


def expectation_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: ``rule``, ``total`` and ``failed`` rows, counted in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("_total"), *failures(rules))
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col("_total").alias("total"), F.col(name).alias("failed"))
        for name in rules
    ]
    return counted.select(F.inline(F.array(*entries)))
