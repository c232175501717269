"""Every operator as a query over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lodestar.functions import discounted, joined_name, part_at, register_functions
from lodestar.operators import (
    Lookup,
    assign_surrogate_keys,
    build_fact,
    dedup_latest,
    expect_all_or_drop,
    expectation_report,
    lookup_keys,
    max_key,
    merge_rows,
    rank_within,
    scd1_rows,
    scd1_upsert,
    scd2_apply,
    scd2_splice as splice_changes,
    split_new_existing,
    top_within,
    upsert,
    upsert_pruned as pruned_upsert,
    versions,
)
from lodestar.operators import quarantine as quarantines
from lodestar.operators.counts import read_counts, update_counts
from lodestar.operators.key_blocks import keys_from_blocks
from lodestar.operators.segments import MAX_GROUP_ROWS
from lodestar.operators.snapshots import feed_changes, snapshot_changes as changes_between
from lodestar.plans import clean, medallion
from lodestar.scratch import (
    PACKED,
    delete_folder,
    folder_exists,
    folder_names,
    freed_shuffles,
    materialise,
    new_folder,
    rename_folder,
)
from lodestar.sources import tables
from lodestar.sources.ingest import ingest_stream
from lodestar.sources.ledger import current_rows, ingest_ledger as ledger_ingest
from lodestar.streaming import append_stream, apply_changes_stream, dedup_append, staged, table_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SCHEMA = "lodestar_queries"


def query(sql: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def new_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """A fresh table name and the folder for its files, both shared by the cluster."""
    tables.create_schema(spark, SCHEMA, new_folder(spark, "schema"))
    return f"{SCHEMA}.{label}_{uuid.uuid4().hex}", new_folder(spark, label)


# ---------------------------------------------------------------- silver


def orders_of(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
    )


def customers_of(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.expr("c_name || '@' || c_mktsegment").alias("email"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
    )


@query(
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,"
    " o_totalprice AS total_amount, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders"
)
def order_year(spark, sf):
    return clean.clean_orders(orders_of(spark, sf))


RANKINGS = {"row_number": "row_num_col", "rank": "rank_flag", "dense_rank": "flag"}
ORDER_RANKS = """
    SELECT o_orderkey AS order_id, CAST(year(o_orderdate) AS INTEGER) AS year,
           o_totalprice AS total_amount,
           row_number() OVER (PARTITION BY year(o_orderdate)
                              ORDER BY o_totalprice DESC, o_orderkey) AS row_num_col,
           rank() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC) AS rank_flag,
           dense_rank() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC) AS flag
    FROM orders"""


def _order_ranks(spark, sf, max_group_rows):
    orders = clean.clean_orders(orders_of(spark, sf)).select("order_id", "year", "total_amount")
    return rank_within(
        orders, ["year"], "total_amount", ["order_id"], max_group_rows=max_group_rows, **RANKINGS
    )


@query(ORDER_RANKS)
def order_ranks(spark, sf):
    return _order_ranks(spark, sf, MAX_GROUP_ROWS)


@query(ORDER_RANKS)
def order_ranks_segmented(spark, sf):
    """The same rankings on the path for groups too large for one task."""
    return _order_ranks(spark, sf, max_group_rows=0)


PART_RANKS = """
    SELECT p_partkey, p_brand, p_size,
           rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS rank_flag,
           dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS flag
    FROM part"""


def _part_ranks(spark, sf, max_group_rows):
    parts = read(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    return rank_within(
        parts, ["p_brand"], "p_size", ["p_partkey"],
        rank="rank_flag", dense_rank="flag", max_group_rows=max_group_rows,
    )


@query(PART_RANKS)
def part_ranks_ties(spark, sf):
    return _part_ranks(spark, sf, MAX_GROUP_ROWS)


@query(PART_RANKS)
def part_ranks_ties_segmented(spark, sf):
    return _part_ranks(spark, sf, max_group_rows=0)


@query(
    f"SELECT order_id, year, total_amount, row_num_col FROM ({ORDER_RANKS}) WHERE row_num_col <= 3"
)
def top_orders_per_year(spark, sf):
    orders = clean.clean_orders(orders_of(spark, sf)).select("order_id", "year", "total_amount")
    return top_within(orders, ["year"], "total_amount", ["order_id"], 3)


URL_DOMAIN = "SELECT page_id, url, str_split(url, '/')[3] AS domain FROM pages"


@query(URL_DOMAIN)
def url_domain(spark, sf):
    return read(spark, sf, "pages").select("page_id", "url", part_at("url", "/", 2).alias("domain"))


@query(f"SELECT domain, count(page_id) AS total_customers FROM ({URL_DOMAIN}) GROUP BY domain")
def domain_counts(spark, sf):
    return clean.domain_counts(url_domain(spark, sf), "domain", "page_id")


@query(
    """
    SELECT segment, count(*) AS total FROM (
        SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END AS segment
        FROM customer) GROUP BY 1"""
)
def domain_counts_incremental(spark, sf):
    """Customers per segment after three loads, each of which brings some and moves others; one load comes twice."""
    customers = read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    third, fifth, tenth = (F.col("id") % n == 0 for n in (3, 5, 10))
    loads = [
        customers.where(~third),
        customers.where(fifth).withColumn("segment", F.lit("MOVED")),
        customers.where(fifth).withColumn("segment", F.lit("MOVED")),
        customers.where((third & ~fifth) | tenth).withColumn("segment", F.when(~tenth, F.col("segment"))),
    ]
    name, path = new_table(spark, "counts")
    for number, rows in zip((0, 1, 1, 2), loads):
        update_counts(spark, name, path, rows, key="id", group="segment", batch_id=number)
    return read_counts(spark, name)


@query(
    "SELECT c_custkey AS customer_id, c_name || '@' || c_mktsegment AS email,"
    " c_mktsegment AS Domain, c_mktsegment || ' ' || c_name AS Full_name"
    " FROM customer WHERE c_mktsegment = 'BUILDING'"
)
def domain_filter(spark, sf):
    return clean.in_domain(clean.clean_customers(customers_of(spark, sf)), "BUILDING", "domain")


@query("SELECT p_partkey, p_brand || ' ' || p_type AS full_name FROM part")
def full_name(spark, sf):
    parts = read(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return parts.withColumn("full_name", joined_name("p_brand", "p_type")).drop("p_brand", "p_type")


@query(
    "SELECT c_custkey AS customer_id, c_name || '@' || c_mktsegment AS email,"
    " c_mktsegment AS Domain, c_mktsegment || ' ' || c_name AS Full_name FROM customer"
)
def clean_customers(spark, sf):
    raw = customers_of(spark, sf).withColumn("_rescued_data", F.lit(None).cast("string"))
    return clean.clean_customers(raw)


@query("SELECT p_partkey, p_retailprice AS price, p_retailprice * 0.90::DOUBLE AS discounted_price FROM part")
def discount(spark, sf):
    function = register_functions(spark)
    parts = read(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("price"))
    return parts.withColumn("discounted_price", discounted("price", function))


@query(ORACLES["discount"])
def discount_sql(spark, sf):
    function = register_functions(spark)
    read(spark, sf, "part").createOrReplaceTempView("products")
    return spark.sql(
        "SELECT p_partkey, p_retailprice AS price,"
        f" {function}(p_retailprice) AS discounted_price FROM products"
    )


@query("SELECT r_regionkey, r_name FROM region")
def clean_regions(spark, sf):
    raw = read(spark, sf, "region").withColumn("_rescued_data", F.lit(None).cast("string"))
    return clean.clean_regions(raw)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 15")
def preview(spark, sf):
    customers = read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return clean.preview(customers, 15, F.desc("c_acctbal"), "c_custkey")


@query(ORACLES["discount"])
def clean_products(spark, sf):
    """The pricing function stored in a schema."""
    tables.create_schema(spark, SCHEMA, new_folder(spark, "schema"))
    parts = read(spark, sf, "part").select(
        "p_partkey", F.col("p_retailprice").alias("price"), F.lit(None).cast("string").alias("_rescued_data")
    )
    return clean.clean_products(parts, SCHEMA)


# ---------------------------------------------------------------- keys


@query(
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) AS rn
        FROM lineitem)
    WHERE rn = 1"""
)
def dedup_lines(spark, sf):
    return dedup_latest(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "SELECT o_orderkey, o_custkey, 1000 + row_number() OVER (ORDER BY o_orderkey) AS surrogate_key"
    " FROM orders"
)
def surrogate_keys(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return assign_surrogate_keys(orders, ["o_orderkey"], start=1000)


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,"
    " row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate)"
    " AS surrogate_key FROM lineitem"
)
def surrogate_keys_composite(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return assign_surrogate_keys(read(spark, sf, "lineitem").select(*columns), columns)


@query(
    "SELECT o_orderkey, o_orderkey % 2 AS load, true AS has_key, true AS has_own_key, true AS keeps_it FROM orders"
)
def surrogate_keys_blocks(spark, sf):
    """Two loads numbered from blocks, and one of them again: every row has a key of its own and keeps it."""
    orders = read(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 2).alias("load"))
    path = new_folder(spark, "key-blocks")
    loads = [keys_from_blocks(orders.where(F.col("load") == i), path, f"load{i}", "key", block=1000) for i in (0, 1)]
    again = keys_from_blocks(orders.where("load = 0"), path, "load0", "again", block=1000).drop("load")
    both = loads[0].unionByName(loads[1])
    holders = both.groupBy("key").agg(F.count("*").alias("holders"))
    joined = both.join(holders, "key", "left").join(again, "o_orderkey", "left")
    return joined.select(
        "o_orderkey", "load", (F.col("key") > 0).alias("has_key"), (F.col("holders") == 1).alias("has_own_key"),
        (F.col("again").isNull() | (F.col("again") == F.col("key"))).alias("keeps_it"),
    )


@query("SELECT max(c_custkey) + 1 AS max_surrog_key FROM customer")
def max_surrogate_key(spark, sf):
    customers = read(spark, sf, "customer").withColumn("DimCustomerKey", F.col("c_custkey") + 1)
    return spark.range(1).select(F.lit(max_key(customers, "DimCustomerKey")).cast("bigint").alias("max_surrog_key"))


def _known_customers(spark, sf):
    """A dimension that knows the customers of one market segment."""
    customers = read(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return customers.select(
        "c_custkey",
        (F.col("c_custkey") * 10 + 1).alias("DimCustomerKey"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("create_date"),
    )


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment <> 'BUILDING'")
def split_new(spark, sf):
    incoming = read(spark, sf, "customer").select("c_custkey", "c_name")
    return split_new_existing(incoming, _known_customers(spark, sf), "c_custkey", ["DimCustomerKey"])[0]


@query(
    "SELECT c_custkey, c_name, c_custkey * 10 + 1 AS DimCustomerKey,"
    " TIMESTAMP '2024-01-01 00:00:00' AS create_date FROM customer WHERE c_mktsegment = 'BUILDING'"
)
def split_existing(spark, sf):
    incoming = read(spark, sf, "customer").select("c_custkey", "c_name")
    keep = ["DimCustomerKey", "create_date"]
    return split_new_existing(incoming, _known_customers(spark, sf), "c_custkey", keep)[1]


@query("SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS DimCustomerKey FROM customer")
def first_load(spark, sf):
    """Against an empty dimension every customer is new."""
    incoming = read(spark, sf, "customer").select("c_custkey", "c_name")
    seed = tables.empty_like(spark, "c_custkey bigint, DimCustomerKey bigint")
    new, _ = split_new_existing(incoming, seed, "c_custkey", ["DimCustomerKey"])
    return assign_surrogate_keys(new, ["c_custkey"], max_key(seed, "DimCustomerKey"), "DimCustomerKey")


@query(
    "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer"
    " UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier"
)
def union_by_name(spark, sf):
    customers = read(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    suppliers = read(spark, sf, "supplier").selectExpr("s_acctbal AS Balance", "s_name AS Name", "s_suppkey AS ID")
    return customers.unionByName(suppliers)


# ---------------------------------------------------------------- merges and dimensions

UPSERT = """
    WITH target AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                           o_totalprice AS total_amount, 1 AS load
                    FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
         source AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                           o_totalprice * 2 AS total_amount, 2 AS load
                    FROM orders WHERE o_orderdate >= TIMESTAMP '1994-01-01')
    SELECT coalesce(s.order_id, t.order_id) AS order_id,
           CASE WHEN s.order_id IS NOT NULL THEN s.customer_id ELSE t.customer_id END AS customer_id,
           CASE WHEN s.order_id IS NOT NULL THEN s.total_amount ELSE t.total_amount END AS total_amount,
           CASE WHEN s.order_id IS NOT NULL THEN s.load ELSE t.load END AS load
    FROM target t FULL OUTER JOIN source s ON t.order_id = s.order_id"""


def _two_loads(spark, sf):
    orders = orders_of(spark, sf)
    target = orders.where("order_date < timestamp_ntz'1996-01-01'").select(
        "order_id", "customer_id", "total_amount", F.lit(1).alias("load")
    )
    source = orders.where("order_date >= timestamp_ntz'1994-01-01'").select(
        "order_id", "customer_id", (F.col("total_amount") * 2).alias("total_amount"), F.lit(2).alias("load")
    )
    return target, source


def _upserted(spark, sf, buckets=None):
    name, path = new_table(spark, "upsert")
    for load in _two_loads(spark, sf):
        upsert(spark, name, load, ["order_id"], path, buckets=buckets)
    return tables.load(spark, name)


@query(UPSERT)
def upsert_orders(spark, sf):
    return _upserted(spark, sf)


@query(UPSERT)
def upsert_orders_bucketed(spark, sf):
    return _upserted(spark, sf, buckets=8)


@query(UPSERT)
def upsert_pruned(spark, sf):
    """The same into a table of many slices, of which the second load rewrites those that hold its keys."""
    name, path = new_table(spark, "pruned")
    for load in _two_loads(spark, sf):
        pruned_upsert(spark, name, load, ["order_id"], path, part_bytes=100_000)
    return tables.load(spark, name)


@query(
    "SELECT (SELECT count(*) FROM orders) AS known, (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0) AS changed,"
    " CAST(0 AS BIGINT) AS replaced_by_new, CAST(1 AS BIGINT) AS replaced_by_one"
)
def upsert_pruned_slices(spark, sf):
    """How many slices a load of new keys replaces, and a load of one key, after one of every fiftieth."""
    orders = orders_of(spark, sf).select("order_id", "customer_id", F.lit(1).alias("load"))
    name, path = new_table(spark, "pruned")
    pruned_upsert(spark, name, orders, ["order_id"], path, part_bytes=100_000)
    pruned_upsert(spark, name, orders.where("order_id % 50 = 0").withColumn("load", F.lit(2)), ["order_id"], path)

    def files() -> set[str]:
        return {r[0] for r in spark.table(name).selectExpr("_metadata.file_path").distinct().collect()}

    counts = []
    largest = orders.agg(F.max("order_id")).first()[0]
    new = orders.withColumn("order_id", F.col("order_id") + largest + 1)
    for load in (new, orders.where(F.col("order_id") == largest)):
        before = files()
        pruned_upsert(spark, name, load, ["order_id"], path)
        counts.append(len(before - files()))
    table = tables.load(spark, name)
    known = table.where(F.col("order_id") <= largest)
    return known.agg(
        F.count("*").alias("known"),
        F.count_if(F.col("order_id") % 50 == 0).alias("changed"),
        F.lit(counts[0]).cast("bigint").alias("replaced_by_new"),
        F.lit(counts[1]).cast("bigint").alias("replaced_by_one"),
    )


@query(UPSERT)
def merge_orders(spark, sf):
    target, source = _two_loads(spark, sf)
    return merge_rows(target, source, ["order_id"])


SCD1 = """
    WITH first_load AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS k
                        FROM customer WHERE c_mktsegment = 'BUILDING'),
         second_load AS (SELECT c_custkey, (SELECT count(*) FROM first_load)
                                + row_number() OVER (ORDER BY c_custkey) AS k
                         FROM customer WHERE c_mktsegment <> 'BUILDING')
    SELECT c.c_custkey AS customer_id, c.c_name || '@' || c.c_mktsegment AS email,
           c.c_mktsegment AS Domain, c.c_mktsegment || ' ' || c.c_name AS Full_name,
           coalesce(f.k, s.k) AS DimCustomerKey,
           TIMESTAMP '2024-02-01 00:00:00' AS update_date,
           CASE WHEN f.k IS NULL THEN TIMESTAMP '2024-02-01 00:00:00'
                ELSE TIMESTAMP '2024-01-01 00:00:00' END AS create_date
    FROM customer c LEFT JOIN first_load f USING (c_custkey) LEFT JOIN second_load s USING (c_custkey)"""


def _scd1(spark, sf, buckets=None):
    customers = customers_of(spark, sf).withColumn("seen", F.lit(2))
    earlier = customers.where("first_name = 'BUILDING'")
    # the first load has an outdated e-mail, the second repeats it beside the valid one
    outdated = earlier.withColumns({"email": F.lit("old@old"), "seen": F.lit(1)})
    loads = [
        (outdated, "timestamp_ntz'2024-01-01 00:00:00'"),
        (customers.unionByName(outdated), "timestamp_ntz'2024-02-01 00:00:00'"),
    ]
    name, path = new_table(spark, "customers")
    for rows, load_ts in loads:
        scd1_upsert(
            spark, name, clean.clean_customers(rows), path,
            key="customer_id", surrogate="DimCustomerKey", latest=["seen"], technical=["seen"],
            load_ts=F.expr(load_ts), buckets=buckets,
        )
    return tables.load(spark, name)


@query(SCD1)
def scd1(spark, sf):
    return _scd1(spark, sf)


@query(SCD1)
def scd1_bucketed(spark, sf):
    return _scd1(spark, sf, buckets=4)


@query("SELECT c_custkey AS customer_id, c_name || '@' || c_mktsegment AS email, CAST(2 AS INTEGER) AS seen FROM customer")
def scd1_late(spark, sf):
    """The newer rows are loaded first; the older ones that come after change nothing."""
    newer = customers_of(spark, sf).select("customer_id", "email", F.lit(2).alias("seen"))
    older = newer.withColumns({"email": F.lit("old@old"), "seen": F.lit(1)})
    name, path = new_table(spark, "late_customers")
    for rows in (newer, older):
        scd1_upsert(
            spark, name, rows, path, key="customer_id", surrogate="DimCustomerKey", latest=["seen"], buckets=4
        )
    return tables.load(spark, name).select("customer_id", "email", "seen")


@query(
    """
    SELECT c_custkey AS customer_id,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '2023-05-06 07:08:09' END AS created,
           c_mktsegment = 'BUILDING' OR k > 0 AS keyed
    FROM customer, (SELECT count(*) AS k FROM customer)"""
)
def scd1_text_dates(spark, sf):
    """A dimension whose creation time is text, and new rows under the current time."""
    begun = spark.sql("SELECT current_timestamp()").first()[0]
    dimension = _known_customers(spark, sf).select(
        F.col("c_custkey").alias("customer_id"), "DimCustomerKey",
        F.lit("2023-05-06 07:08:09").alias("create_date"),
    )
    rows = scd1_rows(customers_of(spark, sf), dimension, "customer_id", "DimCustomerKey")
    written = F.date_format("create_date", "yyyy-MM-dd HH:mm:ss")
    fresh = F.col("create_date") >= F.lit(begun)
    return rows.select(
        "customer_id",
        F.when(~fresh, written).alias("created"),
        ((F.col("DimCustomerKey") > 0) & (F.col("update_date") >= F.lit(begun))).alias("keyed"),
    )


RULES = {"rule1": "event_type IS NOT NULL", "rule2": "value >= 10"}


def _events_with_gaps(spark, sf):
    events = read(spark, sf, "events").select("event_id", "event_type", "value")
    return events.withColumn("event_type", F.expr("nullif(event_type, 'error')"))


EVENTS_WITH_GAPS = "SELECT event_id, nullif(event_type, 'error') AS event_type, value FROM events"


@query(f"SELECT * FROM ({EVENTS_WITH_GAPS}) WHERE event_type IS NOT NULL AND value >= 10")
def expectations(spark, sf):
    return expect_all_or_drop(_events_with_gaps(spark, sf), RULES)


@query(
    f"""
    WITH e AS ({EVENTS_WITH_GAPS})
    SELECT 'rule1' AS rule, count(*) AS total, count(*) - count(event_type) AS failed FROM e
    UNION ALL
    SELECT 'rule2', count(*), count(*) FILTER (WHERE NOT coalesce(value >= 10, false)) FROM e"""
)
def expectations_counted(spark, sf):
    return expectation_report(_events_with_gaps(spark, sf), RULES)


@query(
    f"""
    WITH e AS ({EVENTS_WITH_GAPS}),
         f AS (SELECT *, event_type IS NULL AS f1, NOT coalesce(value >= 10, false) AS f2 FROM e)
    SELECT event_id, event_type, CASE WHEN f2 AND NOT f1 THEN 10 ELSE value END AS value,
           CASE WHEN f1 THEN 1 + CASE WHEN f2 THEN 2 ELSE 0 END ELSE 0 END::BIGINT AS failed FROM f"""
)
def quarantine(spark, sf):
    """Rows that pass and rows that do not; those whose value alone is too small are corrected and come again."""
    events = _events_with_gaps(spark, sf)
    path = new_folder(spark, "quarantine")
    quarantines.deal(events, RULES, path, 0)
    held = quarantines.quarantined(spark, path, events.schema)
    quarantines.replay(held.where("_failed = 2").withColumn("value", F.lit(10.0)), RULES, path, 1)
    left = quarantines.quarantined(spark, path, events.schema).select(*events.columns, F.col("_failed").alias("failed"))
    passed = quarantines.kept(spark, path, events.schema)
    return passed.withColumn("failed", F.lit(0).cast("bigint")).unionByName(left)


SCD2 = """
    SELECT user_id, event_type, valid_from, valid_to, valid_to IS NULL AS is_current FROM (
        SELECT user_id, event_type, ts AS valid_from,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
        FROM (SELECT user_id, event_type, ts,
                     lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS previous
              FROM events)
        WHERE event_type IS DISTINCT FROM previous)"""


def _changes(spark, sf):
    return read(spark, sf, "events").select("user_id", "event_type", "ts")


@query(SCD2)
def scd2(spark, sf):
    return versions(_changes(spark, sf), ["user_id"], "ts", ["event_type"])


@query(SCD2)
def scd2_segmented(spark, sf):
    """The same history on the path for keys too large for one task."""
    return versions(_changes(spark, sf), ["user_id"], "ts", ["event_type"], max_group_rows=0)


@query(SCD2)
def scd2_batches(spark, sf):
    """Two batches, the older events last: all of the second batch is late."""
    changes = _changes(spark, sf)
    middle = changes.agg(F.percentile_approx("ts", 0.5)).first()[0]
    name, path = new_table(spark, "history")
    for number, part in enumerate([changes.where(F.col("ts") >= middle), changes.where(F.col("ts") < middle)]):
        scd2_apply(
            spark, name, part, path, key=["user_id"], sequence_by="ts", batch_id=number, buckets=4
        )
    return tables.load(spark, name)


@query(SCD2)
def scd2_splice(spark, sf):
    """Shuffled batches, spliced into slices: nearly all events, then some late ones, then one user's."""
    changes = _changes(spark, sf)
    part = F.pmod(F.xxhash64("user_id", "ts"), F.lit(1000))
    one_user = F.col("user_id") == changes.agg(F.min("user_id")).first()[0]
    batches = [
        changes.where((part >= 30) & ~one_user),
        changes.where((part < 30) & ~one_user),
        changes.where(one_user),
    ]
    name, path = new_table(spark, "spliced")
    for number, batch in enumerate(batches):
        splice_changes(spark, name, batch, path, key=["user_id"], sequence_by="ts", batch_id=number, slice_rows=2000)
    return tables.load(spark, name)


@query(SCD2)
def scd2_stream(spark, sf):
    """Three micro-batches in arbitrary order, through the quality rules."""
    events = materialise(_changes(spark, sf).repartition(3, "ts"), "events")
    name, path = new_table(spark, "stream_history")
    source = events.inputFiles()[0].rsplit("/", 1)[0]
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    apply_changes_stream(
        spark, staged(stream, {"rule1": "user_id IS NOT NULL"}), name, path,
        new_folder(spark, "checkpoint"), key=["user_id"], sequence_by="ts",
    )
    return tables.load(spark, name)


@query(SCD2)
def scd2_rebucketed(spark, sf):
    """Three batches under different bucket counts; what the first one fixed holds."""
    changes = _changes(spark, sf)
    name, path = new_table(spark, "rebucketed")
    kinds = ("event_type = 'click'", "event_type = 'view'", "event_type NOT IN ('click', 'view')")
    for number, (kind, buckets) in enumerate(zip(kinds, (4, 8, None))):
        scd2_apply(
            spark, name, changes.where(kind), path,
            key=["user_id"], sequence_by="ts", batch_id=number, buckets=buckets,
        )
    return tables.load(spark, name)


@query(
    """
    SELECT p_partkey, CASE WHEN p_size < 10 THEN p_retailprice + 1 ELSE p_retailprice END AS price,
           CASE WHEN p_partkey % 7 = 0 THEN 'inserted' WHEN p_partkey % 11 = 0 THEN 'deleted' ELSE 'updated' END AS _change
    FROM part WHERE p_partkey % 7 = 0 AND p_partkey % 11 <> 0 AND p_size >= 10
    UNION ALL
    SELECT p_partkey, p_retailprice + 1, CASE WHEN p_partkey % 7 = 0 THEN 'inserted' ELSE 'updated' END
    FROM part WHERE p_size < 10 AND p_partkey % 11 <> 0
    UNION ALL
    SELECT p_partkey, p_retailprice, 'deleted' FROM part WHERE p_partkey % 11 = 0 AND p_partkey % 7 <> 0"""
)
def snapshot_changes(spark, sf):
    """Two snapshots: parts are added and removed, and small ones become dearer."""
    parts = read(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("price"), "p_size")
    before = parts.where("p_partkey % 7 <> 0").drop("p_size")
    dearer = F.when(F.col("p_size") < 10, F.col("price") + 1).otherwise(F.col("price"))
    after = parts.withColumn("price", dearer).where("p_partkey % 11 <> 0").drop("p_size")
    name, path = new_table(spark, "snapshots")
    feed_changes(spark, name, path, before, ["p_partkey"], lambda changes: None, buckets=16)
    return changes_between(spark, name, path, after, ["p_partkey"], buckets=16)


SNAPSHOT_HISTORY = """
    WITH c AS (SELECT c_custkey AS customer_id, c_mktsegment AS segment, c_acctbal AS balance FROM customer),
         v AS (SELECT customer_id, segment, balance, 1 AS seen FROM c
               UNION ALL SELECT customer_id, segment, balance + 100, 2 FROM c WHERE segment = 'BUILDING'
               UNION ALL SELECT customer_id, segment, balance + 300, 4 FROM c WHERE segment = 'BUILDING' AND customer_id % 3 = 0)
    SELECT customer_id, segment, balance, seen AS valid_from, n AS valid_to, n IS NULL AS is_current FROM (
        SELECT *, lead(seen) OVER (PARTITION BY customer_id ORDER BY seen) AS n FROM v)"""


@query(SNAPSHOT_HISTORY)
def snapshot_feed(spark, sf):
    """A customer table that is overwritten as a whole feeds a type 2 dimension with what has changed in it."""
    customers = read(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    building = F.col("segment") == "BUILDING"
    second = customers.withColumn("balance", F.when(building, F.col("balance") + 100).otherwise(F.col("balance")))
    third = F.when(building & (F.col("customer_id") % 3 == 0), F.col("balance") + 200).otherwise(F.col("balance"))
    (name, path), (history, folder) = new_table(spark, "snapshots"), new_table(spark, "fed")
    for seen, rows in enumerate([customers, second, second, second.withColumn("balance", third)], 1):

        def apply(changes: DataFrame, seen: int = seen) -> None:
            changes = changes.where("_change <> 'deleted'").drop("_change").withColumn("seen", F.lit(seen))
            splice_changes(spark, history, changes, folder, key=["customer_id"], sequence_by="seen", batch_id=seen)

        feed_changes(spark, name, path, rows, ["customer_id"], apply, buckets=16)
    return tables.load(spark, history)


# ---------------------------------------------------------------- facts

ASOF = f"""
    SELECT e.event_id, e.user_id, e.ts, h.event_type AS last_error_or_view
    FROM events e LEFT JOIN ({SCD2}) h
      ON e.user_id = h.user_id AND e.ts >= h.valid_from AND (h.valid_to IS NULL OR e.ts < h.valid_to)"""


def _as_of(spark, sf, **limits):
    facts = read(spark, sf, "events").select("event_id", "user_id", "ts")
    history = scd2(spark, sf)
    lookup = Lookup(history, "user_id", "user_id", "event_type", "last_error_or_view", as_of="ts")
    return lookup_keys(facts, lookup, **limits)


@query(ASOF)
def asof_lookup(spark, sf):
    return _as_of(spark, sf)


@query(ASOF)
def asof_lookup_segmented(spark, sf):
    return _as_of(spark, sf, max_joined_versions=0, max_group_rows=0)


ASOF_OVERLAP = """
    SELECT e.event_id, CASE WHEN e.ts < d.valid_to THEN d.version END AS version
    FROM events e ASOF LEFT JOIN (
        SELECT user_id, ts AS valid_from, ts + INTERVAL 2 DAY AS valid_to, event_id AS version
        FROM events WHERE event_type = 'error') d
      ON e.user_id = d.user_id AND e.ts >= d.valid_from"""


def _as_of_overlap(spark, sf, **limits):
    """Periods of two days from each error on: they overlap, and leave gaps."""
    events = read(spark, sf, "events")
    periods = events.where("event_type = 'error'").select(
        "user_id",
        F.col("ts").alias("valid_from"),
        F.expr("ts + INTERVAL 2 DAYS").alias("valid_to"),
        F.col("event_id").alias("version"),
    )
    lookup = Lookup(periods, "user_id", "user_id", "version", "version", as_of="ts")
    facts = events.select("event_id", "user_id", "ts")
    return lookup_keys(facts, lookup, **limits).select("event_id", "version")


@query(ASOF_OVERLAP)
def asof_overlap(spark, sf):
    return _as_of_overlap(spark, sf, max_joined_versions=1_000_000)


@query(ASOF_OVERLAP)
def asof_overlap_sorted(spark, sf):
    return _as_of_overlap(spark, sf, max_joined_versions=0)


@query(
    f"SELECT e.event_id, e.user_id, h.event_type AS current_type"
    f" FROM events e LEFT JOIN (SELECT * FROM ({SCD2}) WHERE is_current) h USING (user_id)"
)
def current_lookup(spark, sf):
    facts = read(spark, sf, "events").select("event_id", "user_id")
    return lookup_keys(facts, Lookup(scd2(spark, sf), "user_id", "user_id", "event_type", "current_type"))


def _order_lines(spark, sf):
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    lines = read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("shipped"),
        amount.cast("decimal(18,4)").alias("total_amount"),
    )
    orders = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
    )
    # the long text is made of its parts after the shuffle
    return lines.join(orders, "l_orderkey").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "shipped").alias("order_id"),
        F.col("l_partkey").alias("product_id"), "total_amount", "customer_id", "order_date",
    )


ORDER_LINES = """
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                     strftime(l_shipdate, '%Y-%m-%d')) AS order_id,
           l_partkey AS product_id, o_custkey AS customer_id, o_orderdate AS order_date,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                AS DECIMAL(18,4)) AS total_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

FACT = f"""
    SELECT order_id, order_date, CAST(total_amount AS DOUBLE) AS total_amount,
           CASE WHEN c_custkey IS NOT NULL THEN c_custkey * 10 + 1 END AS DimCustomerKey,
           p_partkey AS DimProductKey
    FROM ({ORDER_LINES})
    LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ON customer_id = c_custkey
    LEFT JOIN part ON product_id = p_partkey"""


def _fact(spark, sf, lines):
    customers = _known_customers(spark, sf)
    products = read(spark, sf, "part").select(F.col("p_partkey").alias("product_id"))
    return build_fact(
        lines,
        [
            Lookup(customers, "customer_id", "c_custkey", "DimCustomerKey", "DimCustomerKey"),
            Lookup(products, "product_id", "product_id", "product_id", "DimProductKey"),
        ],
    )


def _as_double(df):
    return df.withColumn("total_amount", F.col("total_amount").cast("double"))


@query(FACT)
def fact_orders(spark, sf):
    return _as_double(_fact(spark, sf, _order_lines(spark, sf)))


@query(FACT)
def fact_upsert(spark, sf):
    """Two overlapping loads, merged on three keys of which two may be NULL."""
    lines = materialise(_order_lines(spark, sf), "order-lines")
    name, path = new_table(spark, "fact")
    for part in ("order_date < timestamp_ntz'1996-01-01'", "order_date >= timestamp_ntz'1994-01-01'"):
        fact = _fact(spark, sf, lines.where(part))
        keys = ["order_id", "DimCustomerKey", "DimProductKey"]
        upsert(spark, name, fact, keys, path, buckets=8, bucket_by=["order_id"])
    return _as_double(tables.load(spark, name))


@query("SELECT o_orderkey AS order_id, o_totalprice AS total_amount, CAST(2 AS INTEGER) AS seen FROM orders")
def fact_late(spark, sf):
    """Newer orders first, then older ones, which change nothing."""
    newer = orders_of(spark, sf).select("order_id", "total_amount", F.lit(2).alias("seen"))
    older = newer.withColumns({"total_amount": F.lit(0.0), "seen": F.lit(1)})
    name, path = new_table(spark, "late_fact")
    for rows in (newer, older):
        upsert(spark, name, rows, ["order_id"], path, sequence=["seen"], buckets=8)
    return tables.load(spark, name)


# ---------------------------------------------------------------- tables, ingestion, everything


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def published_table(spark, sf):
    """Overwrite a folder, register it, read it by SQL, publish it again, read it by name."""
    customers = read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    name, path = new_table(spark, "registered")
    tables.overwrite(customers, path)
    tables.register(spark, name, path)
    again, path = new_table(spark, "published")
    tables.create(spark.sql(f"SELECT * FROM {name}"), again, path)
    return spark.read.table(again)


def _deliver(rows: DataFrame, folder: str) -> None:
    rows.write.options(**PACKED).mode("append").parquet(folder)


def _deliver_files(spark: SparkSession, stored: str, folder: str, label: str) -> None:
    """The files of a stored table, moved under a name with ``label`` rather than written again."""
    if not folder_exists(spark, stored):
        return  # a part without rows
    for name in folder_names(spark, stored):
        if name.startswith("part-"):
            rename_folder(spark, f"{stored}/{name}", f"{folder}/{label}-{name}")


def _deliver_as(rows: DataFrame, path: str) -> None:
    """One file under a given name, over one that may be there."""
    made = f"{path}-made"
    rows.coalesce(1).write.parquet(made)
    spark = rows.sparkSession
    system = spark._jvm.org.apache.hadoop.fs.Path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    file = next(n for n in folder_names(spark, made) if n.startswith("part-"))
    system.delete(spark._jvm.org.apache.hadoop.fs.Path(path), False)
    rename_folder(spark, f"{made}/{file}", path)
    delete_folder(spark, made)


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def ingest(spark, sf):
    """Two deliveries and an idle run."""
    events = read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    source, bronze, checkpoint = (new_folder(spark, p) for p in ("source", "bronze", "checkpoint"))
    for kind in ("event_type = 'click'", "event_type <> 'click'", None):
        if kind:
            _deliver(events.where(kind), source)
        landed = ingest_stream(spark, source, bronze, checkpoint)
    return landed.select(*events.columns)


@query(
    "SELECT event_id, event_type, CASE WHEN event_type <> 'click'"
    " THEN '{\"user_id\":' || user_id || '}' END AS _rescued_data FROM events"
)
def ingest_rescued(spark, sf):
    """The second delivery has a column that the first one lacked."""
    events = read(spark, sf, "events")
    source, bronze, checkpoint = (new_folder(spark, p) for p in ("source", "bronze", "checkpoint"))
    _deliver(events.where("event_type = 'click'").select("event_id", "event_type"), source)
    ingest_stream(spark, source, bronze, checkpoint)
    _deliver(events.where("event_type <> 'click'").select("event_id", "event_type", "user_id"), source)
    landed = ingest_stream(spark, source, bronze, checkpoint)
    return landed.select("event_id", "event_type", "_rescued_data")


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def ingest_backdated(spark, sf):
    """The second delivery's files are dated thirty days before the first one's."""
    events = read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    source, bronze, checkpoint = (new_folder(spark, p) for p in ("source", "bronze", "checkpoint"))
    _deliver(events.where("event_type = 'click'"), source)
    ingest_stream(spark, source, bronze, checkpoint)
    _deliver(events.where("event_type <> 'click'"), f"{source}/late")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{source}/late")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in system.listStatus(folder):
        past = entry.getModificationTime() - 30 * 24 * 3600 * 1000
        system.setTimes(entry.getPath(), past, -1)
    options = {"recursiveFileLookup": "true"}
    return ingest_stream(spark, source, bronze, checkpoint, options=options).select(*events.columns)


@query(
    "SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'click' THEN value + 1 ELSE value END AS value"
    " FROM events"
)
def ingest_ledger(spark, sf):
    """Three runs by the ledger: clicks and views, the clicks' files written again, and all others."""
    events = read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    source, bronze, checkpoint = (new_folder(spark, p) for p in ("source", "bronze", "checkpoint"))
    clicks = events.where("event_type = 'click'")
    _deliver_as(clicks, f"{source}/clicks.parquet")
    _deliver(events.where("event_type = 'view'"), f"{source}/views")
    options = {"recursiveFileLookup": "true"}
    ledger_ingest(spark, source, bronze, checkpoint, options=options)
    _deliver_as(clicks.withColumn("value", F.col("value") + 1), f"{source}/clicks.parquet")
    ledger_ingest(spark, source, bronze, checkpoint, options=options)
    _deliver(events.where("event_type NOT IN ('click', 'view')"), f"{source}/others")
    landed = ledger_ingest(spark, source, bronze, checkpoint, options=options, max_files=1)
    return current_rows(spark, landed, checkpoint).select(*events.columns)


@query(
    "SELECT event_id, CASE WHEN event_type <> 'view' THEN user_id END AS user_id,"
    " CASE WHEN event_type = 'view' THEN '{\"user_id\":\"u' || user_id || '\"}' END AS _rescued_data FROM events"
)
def ingest_type_conflict(spark, sf):
    """Files of another type beside good ones: their values are rescued, all rows arrive."""
    events = read(spark, sf, "events").select("event_id", "user_id", "event_type")
    source, bronze, checkpoint = (new_folder(spark, p) for p in ("source", "bronze", "checkpoint"))
    _deliver(events.where("event_type = 'click'").drop("event_type"), source)
    ingest_stream(spark, source, bronze, checkpoint)
    odd = events.where("event_type = 'view'").withColumn("user_id", F.concat(F.lit("u"), "user_id"))
    _deliver(odd.drop("event_type"), source)
    _deliver(events.where("event_type NOT IN ('click', 'view')").drop("event_type"), source)
    return ingest_stream(spark, source, bronze, checkpoint).select("event_id", "user_id", "_rescued_data")


@query(
    "SELECT event_id, event_type, CASE WHEN event_type <> 'click' THEN"
    " '{\"detail\":{\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}}' END"
    " AS _rescued_data FROM events"
)
def ingest_nested(spark, sf):
    """The second delivery's struct has a field that the first one's lacked."""
    events = read(spark, sf, "events")
    source, bronze, checkpoint = (new_folder(spark, p) for p in ("source", "bronze", "checkpoint"))
    first = events.where("event_type = 'click'").select("event_id", F.struct("event_type").alias("detail"))
    _deliver(first, source)
    ingest_stream(spark, source, bronze, checkpoint)
    more = F.struct("event_type", "user_id").alias("detail")
    _deliver(events.where("event_type <> 'click'").select("event_id", more), source)
    landed = ingest_stream(spark, source, bronze, checkpoint)
    return landed.select("event_id", F.col("detail.event_type").alias("event_type"), "_rescued_data")


@query(
    "SELECT event_id, CAST(user_id AS BIGINT) + CASE WHEN event_type = 'view' THEN 5000000000 ELSE 0 END AS user_id,"
    " CAST(value AS DECIMAL(12,2))::DOUBLE AS value, CASE WHEN event_type NOT IN ('click', 'view') THEN"
    " '{\"value\":\"x\"}' END AS _rescued_data FROM events WHERE event_type IN ('click', 'view')"
    " UNION ALL SELECT event_id, CAST(user_id AS BIGINT), NULL, '{\"value\":\"x\"}' FROM events"
    " WHERE event_type NOT IN ('click', 'view')"
)
def ingest_widened(spark, sf):
    """Numbers become longer from one delivery to the next, then text comes, which no number holds.

    Numbers too long for a delivery's short type come in a longer one.
    """
    events = read(spark, sf, "events")
    click, view = F.col("event_type") == "click", F.col("event_type") == "view"
    number, amount = F.col("user_id"), F.col("value").cast("decimal(12,2)")
    fits = {kind: number.isNull() | number.try_cast(kind).isNotNull() for kind in ("int", "smallint")}

    def part(rows, kind, user, value):
        return events.where(rows).select("event_id", user.cast(kind).alias("user_id"), value.alias("value"))

    first = part(click & fits["int"], "int", number, amount)
    longer = F.when(view, number.cast("bigint") + 5000000000).otherwise(number.cast("bigint"))
    second = part(view | (click & ~fits["int"]), "bigint", longer, amount.cast("decimal(16,4)"))
    third = part(~click & ~view & fits["smallint"], "smallint", number, F.lit("x"))
    fourth = part(~click & ~view & ~fits["smallint"], "bigint", number, F.lit("x"))
    source, bronze, checkpoint = (new_folder(spark, p) for p in ("source", "bronze", "checkpoint"))
    for delivery in (first, second, third, fourth):
        _deliver(delivery, source)
        landed = ingest_stream(spark, source, bronze, checkpoint, widen=True)
    return landed.select("event_id", "user_id", F.col("value").cast("double").alias("value"), "_rescued_data")


@query(
    "SELECT event_id, event_type AS kind, CAST(user_id AS BIGINT) AS id, CASE WHEN event_type <> 'click' THEN"
    " '{\"parts\":[{\"kind\":\"' || event_type || '\",\"id\":' || user_id || ',\"more\":1}]}' END AS _rescued_data FROM events"
)
def ingest_nested_array(spark, sf):
    """Structs in an array get wider numbers and a field that was not known."""
    events = read(spark, sf, "events")
    click = F.col("event_type") == "click"
    kind = F.col("event_type").alias("kind")
    short = F.array(F.struct(kind, F.col("user_id").cast("int").alias("id"))).alias("parts")
    longer = F.array(F.struct(kind, F.col("user_id").cast("bigint").alias("id"), F.lit(1).alias("more"))).alias("parts")
    source, bronze, checkpoint = (new_folder(spark, p) for p in ("source", "bronze", "checkpoint"))
    for rows in (events.where(click).select("event_id", short), events.where(~click).select("event_id", longer)):
        _deliver(rows, source)
        landed = ingest_stream(spark, source, bronze, checkpoint, widen=True)
    part = F.col("parts")[0]
    return landed.select("event_id", part["kind"].alias("kind"), part["id"].alias("id"), "_rescued_data")


@query("SELECT event_id, event_type, value FROM events WHERE value >= 10")
def table_to_stream(spark, sf):
    """A table read as a stream, filtered by rules, appended to a folder."""
    name, path = new_table(spark, "events")
    tables.create(read(spark, sf, "events").select("event_id", "event_type", "value"), name, path)
    target = new_folder(spark, "appended")
    append_stream(
        staged(table_stream(spark, name), {"rule": "value >= 10"}), target, new_folder(spark, "checkpoint")
    )
    return spark.read.parquet(target)


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def dedup_stream(spark, sf):
    """Three deliveries with a restart between, in which many rows come again."""
    events = read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    source, target, checkpoint = (new_folder(spark, p) for p in ("source", "appended", "checkpoint"))
    part = F.col("event_id") % 10
    for delivered in (part < 6, part > 2, (part == 9) | (part == 0)):
        _deliver(events.where(delivered), source)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
        dedup_append(stream, ["event_id"], "ts", "3650 days", target, checkpoint)
    return spark.read.parquet(target)


STAR = f"""
    SELECT n_name AS region_name, p_brand AS brand, CAST(year(order_date) AS INTEGER) AS year,
           count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS revenue
    FROM ({ORDER_LINES}) JOIN customer ON customer_id = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON product_id = p_partkey
    GROUP BY ALL"""


@query(STAR)
def star_summary(spark, sf):
    """Two complete loads from source files to the star schema, then a report on it.

    In the second load customers arrive late, products change their price, and
    some orders are delivered again.
    """
    return _star_report(spark, _load_twice(spark, sf))


@query(STAR)
def star_summary_incremental(spark, sf):
    """The same with more buckets; the second load reads only what is new."""
    return _star_report(spark, _load_twice(spark, sf, incremental=True, buckets=16))


@query(STAR)
def star_summary_sliced(spark, sf):
    """The same with customers and orders in slices, and no old versions kept."""
    return _star_report(spark, _load_twice(spark, sf, sliced=True, keep_versions=False))


@query(STAR)
def star_summary_full(spark, sf):
    """The same, where each load reads all silver rows and rewrites whole tables."""
    return _star_report(spark, _load_twice(spark, sf, incremental=False, buckets=None))


@query(
    """
    SELECT o_orderkey AS order_id, c_custkey IS NOT NULL AS has_customer, o_orderkey % 4 <> 0 AS has_product
    FROM orders LEFT JOIN customer ON c_custkey = CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END"""
)
def fact_open_keys(spark, sf):
    """Three loads: customers and products arrive after their orders, and some never do."""
    settings = _star_settings(spark)
    customers = customers_of(spark, sf)
    products = spark.createDataFrame(
        [(i, f"p{i}", 1.0 * i) for i in (1, 2, 3)], "product_id bigint, product_name string, price double"
    ).withColumn("updated_at", F.expr("timestamp_ntz'2024-01-01'"))
    orders = orders_of(spark, sf).select(
        "order_id",
        F.when(F.col("customer_id") % 5 != 0, F.col("customer_id")).alias("customer_id"),  # NULL, which nobody is
        (F.col("order_id") % 4).alias("product_id"),  # product 0 never arrives
        "order_date",
        "total_amount",
    )
    late = F.col("customer_id") % 2 == 0
    deliveries = [
        {"customers": customers.where(~late), "products": products.where("product_id = 1"), "orders": orders.where("order_id % 3 > 0")},
        {"customers": customers.where(late & (F.col("customer_id") % 3 == 0)), "products": products.where("product_id = 2")},
        {"customers": customers.where(late), "products": products.where("product_id = 3"), "orders": orders.where("order_id % 3 = 0")},
    ]
    for delivery in deliveries:
        for name, rows in delivery.items():
            _deliver(rows, settings.folder("source", name))
        medallion.run(spark, settings)
    fact = tables.load(spark, settings.table("gold", "FactOrders"))
    return fact.select(
        "order_id", F.col("DimCustomerKey").isNotNull().alias("has_customer"), F.col("DimProductKey").isNotNull().alias("has_product")
    )


@query(
    f"""
    SELECT p_brand AS brand, order_date >= TIMESTAMP '1995-06-01' AS dearer, count(*) AS orders,
           CAST(sum(total_amount) AS DOUBLE) AS revenue
    FROM ({ORDER_LINES}) JOIN part ON product_id = p_partkey
    WHERE order_date >= TIMESTAMP '1993-01-01' GROUP BY ALL"""
)
def star_as_of(spark, sf):
    """Each order joined with the product version that was valid at its date."""
    settings = _star_settings(spark, as_of_order_date=True)
    products = read(spark, sf, "part").selectExpr(
        "p_partkey AS product_id", "p_name AS product_name", "p_brand AS brand",
        "p_retailprice AS price", "timestamp_ntz'1993-01-01' AS updated_at",
    )
    dearer = products.withColumns(
        {"price": F.col("price") + 1, "updated_at": F.expr("timestamp_ntz'1995-06-01'")}
    )
    delivery = {
        "customers": customers_of(spark, sf),
        "products": products.unionByName(dearer),
        "orders": _order_lines(spark, sf),
    }
    for name, rows in delivery.items():
        _deliver(rows, settings.folder("source", name))
    medallion.run(spark, settings)
    fact = tables.load(spark, settings.table("gold", "FactOrders"))
    versions_of = medallion.product_versions(spark, settings).select(
        "DimProductKey", "brand", (F.col("valid_from") >= F.expr("timestamp_ntz'1995-06-01'")).alias("dearer")
    )
    return (
        fact.join(versions_of, "DimProductKey")
        .groupBy("brand", "dearer")
        .agg(F.count("*").alias("orders"), F.sum("total_amount").cast("double").alias("revenue"))
    )


def _star_report(spark: SparkSession, settings: medallion.Settings) -> DataFrame:
    fact = tables.load(spark, settings.table("gold", "FactOrders"))
    customers = tables.load(spark, settings.table("gold", "DimCustomers")).select(
        "DimCustomerKey", "region_id"
    )
    products = tables.load(spark, settings.table("gold", "DimProducts")).where("is_current").select(
        F.col("product_id").alias("DimProductKey"), "brand"
    )
    regions = spark.table(settings.table("silver", "regions_silver")).select("region_id", "region_name")
    return (
        fact.join(customers, "DimCustomerKey")
        .join(products, "DimProductKey")
        .join(regions, "region_id")
        .groupBy("region_name", "brand", "year")
        .agg(F.count("*").alias("orders"), F.sum("total_amount").cast("double").alias("revenue"))
    )


def _star_settings(spark: SparkSession, **options) -> medallion.Settings:
    unique = uuid.uuid4().hex
    schemas = {layer: f"{layer}_{unique}" for layer in ("bronze", "silver", "gold")}
    return medallion.Settings(new_folder(spark, "medallion"), schemas, **options)


def _load_twice(spark: SparkSession, sf: str, **options) -> medallion.Settings:
    settings = _star_settings(spark, **options)
    customers = customers_of(spark, sf).join(
        read(spark, sf, "customer").selectExpr("c_custkey AS customer_id", "c_nationkey AS region_id"),
        "customer_id",
    )
    products = read(spark, sf, "part").selectExpr(
        "p_partkey AS product_id", "p_name AS product_name", "p_brand AS brand",
        "p_retailprice AS price", "timestamp_ntz'2024-01-01' AS updated_at",
    )
    dearer = products.withColumns(
        {"price": F.col("price") + 1, "updated_at": F.expr("timestamp_ntz'2024-06-01'")}
    )
    # stored by delivery: those of the first one only, of both, and of the second one only
    first, second = F.col("order_date") < F.expr("timestamp_ntz'1996-01-01'"), F.col("order_date") >= F.expr("timestamp_ntz'1994-01-01'")
    lines = new_folder(spark, "order-lines")
    orders = _order_lines(spark, sf)
    when = F.when(first & second, "both").when(first, "first").when(second, "second")
    with freed_shuffles(spark):
        orders.withColumn("delivery", when).where("delivery IS NOT NULL").write.options(**PACKED).partitionBy("delivery").parquet(lines)
    stored = spark.read.schema(T.StructType([*orders.schema.fields, T.StructField("delivery", T.StringType())])).parquet(lines)
    regions = read(spark, sf, "nation").selectExpr("n_nationkey AS region_id", "n_name AS region_name")
    deliveries = [
        {
            "customers": customers.where("first_name = 'BUILDING'"),
            "products": products,
            "orders": stored.where("delivery IN ('first', 'both')").drop("delivery"),
            "regions": regions,
        },
        {
            "customers": customers,
            "products": dearer,
        },
    ]
    for number, delivery in enumerate(deliveries):
        with freed_shuffles(spark):
            for name, rows in delivery.items():
                _deliver(rows, settings.folder("source", name))
        if number:
            for part in ("both", "second"):
                _deliver_files(spark, f"{lines}/delivery={part}", settings.folder("source", "orders"), part)
        medallion.run(spark, settings)
    delete_folder(spark, lines)
    return settings
