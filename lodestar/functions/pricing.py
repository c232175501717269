"""The SQL pricing function. Catalyst inlines its body, so no UDF runs."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F


def register_functions(spark: SparkSession, schema: str | None = None) -> str:
    """Define ``discount_func`` for the session, or stored in ``schema``; return its name."""
    name = f"{schema}.discount_func" if schema else "discount_func"
    kind = "FUNCTION" if schema else "TEMPORARY FUNCTION"
    spark.sql(
        f"CREATE OR REPLACE {kind} {name}(p_price DOUBLE) RETURNS DOUBLE RETURN p_price * 0.90"
    )
    return name


def discounted(price: str, function: str = "discount_func") -> Column:
    """A call of the registered function from the DataFrame API."""
    return F.expr(f"{function}(`{price}`)")
