"""Silver: narrow projections per dataset, and two small reports on customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodestar.functions import discounted, joined_name, part_at, register_functions
from lodestar.sources.ingest import RESCUED


def clean_customers(customers: DataFrame) -> DataFrame:
    """Add the e-mail ``Domain``, and ``Full_name`` in place of its two parts."""
    derived = {"Domain": part_at("email", "@", 1), "Full_name": joined_name("first_name", "last_name")}
    return customers.drop(RESCUED).withColumns(derived).drop("first_name", "last_name")


def clean_orders(orders: DataFrame) -> DataFrame:
    """Add the calendar ``year`` of the order."""
    return orders.drop(RESCUED).withColumn("year", F.year("order_date"))


def clean_products(products: DataFrame, schema: str | None = None) -> DataFrame:
    """Add ``discounted_price`` by the SQL pricing function, stored in ``schema`` if one is given."""
    function = register_functions(products.sparkSession, schema)
    return products.drop(RESCUED).withColumn("discounted_price", discounted("price", function))


def clean_regions(regions: DataFrame) -> DataFrame:
    return regions.drop(RESCUED)


def domain_counts(customers: DataFrame, domain: str = "Domain", id: str = "customer_id") -> DataFrame:
    """Customers per domain, most frequent first; rows without an id do not count."""
    counts = customers.groupBy(domain).agg(F.count(id).alias("total_customers"))
    return counts.orderBy(F.desc("total_customers"), F.asc(domain))


def in_domain(customers: DataFrame, value: str, domain: str = "Domain") -> DataFrame:
    return customers.where(F.col(domain) == value)


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in a stated order (Spark keeps ``n`` per task, then merges)."""
    return df.orderBy(*order).limit(n)
