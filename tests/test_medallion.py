"""The literal fixtures through all layers, in two deliveries."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodestar.plans import medallion
from lodestar.scratch import FREE_SHUFFLES, folder_exists, freed_shuffles
from lodestar.sources import tables

CUSTOMER = "customer_id string, email string, first_name string, last_name string"
ORDER = "order_id string, customer_id string, product_id string, order_date timestamp, total_amount double"
PRODUCT = "product_id string, product_name string, price double, updated_at timestamp"
REGION = "region_id string, region_name string"


def day(n):
    return f"2024-01-{n:02d}"


def frame(spark, data, ddl):
    """Days are given as text; timestamps are parsed here."""
    names = [c.split()[0] for c in ddl.split(", ")]
    df = spark.createDataFrame(data, ddl.replace("timestamp", "string"))
    return df.select(*(F.to_timestamp(n).alias(n) if "timestamp" in c else n for n, c in zip(names, ddl.split(", "))))


FIRST = {
    "customers": (CUSTOMER, [("C1", "ann@gmail.com", "Ann", "Lee"), ("C2", "bob@x.org", "Bob", None), ("C1", "ann@gmail.com", "Ann", "Lee")]),
    "orders": (ORDER, [("O1", "C1", "P1", day(4), 5.0), ("O2", "C9", "P1", day(9), 6.0), ("O3", "C2", "P9", day(9), 7.0)]),
    "products": (PRODUCT, [("P1", "Pen", 10.0, day(1)), (None, "Cap", 3.0, day(1)), ("P2", None, 4.0, day(1)), ("P1", "Pen", 10.0, day(5))]),
    "regions": (REGION, [("R1", "North")]),
}
SECOND = {
    "customers": (CUSTOMER, [("C2", "bob@y.org", "Bob", None), ("C9", "new@y.org", "New", "Man")]),
    "orders": (ORDER, [("O1", "C1", "P1", day(4), 50.0)]),
    "products": (PRODUCT, [("P1", "Pen", 12.0, day(3))]),
}


@pytest.mark.parametrize("buckets, incremental", [(None, False), (3, True)])
def test_two_deliveries(spark, tmp_path, buckets, incremental):
    unique = uuid.uuid4().hex
    s = medallion.Settings(
        str(tmp_path),
        {k: f"{k}_{unique}" for k in ("bronze", "silver", "gold")},
        buckets=buckets,
        incremental=incremental,
    )

    def load(delivery, ts):
        for name, (ddl, data) in delivery.items():
            frame(spark, data, ddl).coalesce(1).write.mode("append").parquet(s.folder("source", name))
        medallion.run(spark, s, load_ts=F.expr(f"timestamp'{ts}'"))

    def gold(name, *columns):
        return rows(tables.load(spark, s.table("gold", name)), *columns)

    load(FIRST, day(20))
    assert gold("DimCustomers", "DimCustomerKey", "customer_id", "Domain", "Full_name") == [
        (1, "C1", "gmail.com", "Ann Lee"), (2, "C2", "x.org", None)
    ]
    versions = ["product_id", "price", "discounted_price", "is_current"]
    assert gold("DimProducts", *versions) == [("P1", 10.0, 9.0, True)]
    fact = ["order_id", "DimCustomerKey", "DimProductKey", "total_amount", "year"]
    assert gold("FactOrders", *fact) == [
        ("O1", 1, "P1", 5.0, 2024), ("O2", None, "P1", 6.0, 2024), ("O3", 2, None, 7.0, 2024)
    ]
    assert rows(spark.table(s.table("silver", "regions_silver")), "region_id", "region_name") == [("R1", "North")]

    load(SECOND, day(21))
    assert gold("DimCustomers", "DimCustomerKey", "customer_id", "Domain", "Full_name") == [
        (1, "C1", "gmail.com", "Ann Lee"), (2, "C2", "y.org", None), (3, "C9", "y.org", "New Man")
    ]
    created = tables.load(spark, s.table("gold", "DimCustomers")).select(
        "customer_id", F.day("create_date"), F.day("update_date")
    )
    c1 = 20 if incremental else 21  # not delivered again
    assert rows(created) == [("C1", 20, c1), ("C2", 20, 21), ("C9", 21, 21)]
    periods = tables.load(spark, s.table("gold", "DimProducts")).select(
        "price", F.day("valid_from"), F.day("valid_to")
    )
    assert rows(periods) == [(10.0, 1, 3), (10.0, 5, None), (12.0, 3, 5)]
    assert gold("FactOrders", *fact) == [
        ("O1", 1, "P1", 50.0, 2024), ("O2", 3, "P1", 6.0, 2024), ("O3", 2, None, 7.0, 2024)
    ]

    bronze = spark.table(s.table("bronze", "customers"))
    assert rows(bronze.groupBy("_batch_id").count()) == [(0, 3), (1, 2)]

    load({}, day(22))  # nothing new
    assert len(gold("FactOrders")) == 3 and len(gold("DimProducts")) == 3
    assert {r[0] for r in tables.list_schemas(spark).collect()} >= set(s.schemas.values())


def test_sliced_tables_without_old_versions(spark, tmp_path):
    s = settings_of(tmp_path, sliced=True, keep_versions=False, buckets=2)
    for delivery in (FIRST, SECOND):
        deliver(spark, s, delivery)
    fact = rows(tables.load(spark, s.table("gold", "FactOrders")), "order_id", "DimCustomerKey", "DimProductKey", "total_amount")
    assert fact == [("O1", 1, "P1", 50.0), ("O2", 3, "P1", 6.0), ("O3", 2, None, 7.0)]
    assert rows(tables.load(spark, s.table("gold", "DimCustomers")), "DimCustomerKey", "email") == [
        (1, "ann@gmail.com"), (2, "bob@y.org"), (3, "new@y.org")
    ]
    for name in ("DimCustomers", "FactOrders"):
        used = {f.split("/version-")[1][:32] for f in spark.table(s.table("gold", name)).inputFiles()}
        there = {p.name.removeprefix("version-") for p in (tmp_path / "gold" / name).glob("version-*")}
        assert there == used


def test_unknown_customers_do_not_make_silver_be_read_again(spark, tmp_path, monkeypatch):
    """O2's customer comes late and O3's product never: they are looked up from beside the fact."""
    s = settings_of(tmp_path, buckets=2)
    deliver(spark, s, FIRST)
    old = set(spark.table(s.table("silver", "orders_silver")).inputFiles())
    read, real = [], medallion._fact_rows
    monkeypatch.setattr(medallion, "_fact_rows", lambda spark, s, orders: read.append(set(orders.inputFiles())) or real(spark, s, orders))
    deliver(spark, s, {"customers": SECOND["customers"]})
    assert read and not any(files & old for files in read)
    assert rows(tables.load(spark, s.table("gold", "FactOrders")), "order_id", "DimCustomerKey") == [("O1", 1), ("O2", 3), ("O3", 2)]
    assert rows(tables.load(spark, s.table("gold", "FactOrders_open")), "order_id") == [("O3",)]


def settings_of(tmp_path, **options):
    unique = uuid.uuid4().hex
    return medallion.Settings(str(tmp_path), {k: f"{k}_{unique}" for k in ("bronze", "silver", "gold")}, **options)


def deliver(spark, s, delivery):
    for name, (ddl, data) in delivery.items():
        frame(spark, data, ddl).coalesce(1).write.mode("append").parquet(s.folder("source", name))
    medallion.run(spark, s)


@pytest.mark.parametrize("incremental", [False, True])
def test_an_older_load_changes_nothing(spark, tmp_path, incremental):
    s = settings_of(tmp_path, latest=("seen",), incremental=incremental, buckets=2)
    customer, order = CUSTOMER + ", seen int", ORDER + ", seen int"
    for email, amount, seen in (("new@a.org", 2.0, 2), ("old@a.org", 1.0, 1)):
        deliver(spark, s, {
            "customers": (customer, [("C1", email, "Ann", "Lee", seen)]),
            "orders": (order, [("O1", "C1", "P1", day(4), amount, seen)]),
            "products": (PRODUCT, [("P1", "Pen", 1.0, day(1))]),
            "regions": (REGION, [("R1", "North")]),
        })
    assert rows(tables.load(spark, s.table("gold", "DimCustomers")), "customer_id", "email") == [("C1", "new@a.org")]
    assert rows(tables.load(spark, s.table("gold", "FactOrders")), "order_id", "total_amount") == [("O1", 2.0)]


def test_products_that_all_fail_the_rules_and_missing_datasets(spark, tmp_path):
    s = settings_of(tmp_path, buckets=2)
    deliver(spark, s, {"customers": FIRST["customers"], "products": (PRODUCT, [(None, "Cap", 3.0, day(1)), ("P1", "Pen", 1.0, None)])})
    assert tables.load(spark, s.table("gold", "DimProducts")).count() == 0
    deliver(spark, s, {"orders": FIRST["orders"]})
    assert rows(tables.load(spark, s.table("gold", "FactOrders")), "order_id", "DimProductKey") == [("O1", None), ("O2", None), ("O3", None)]


def test_orders_point_at_the_version_of_their_date(spark, tmp_path):
    s = settings_of(tmp_path, as_of_order_date=True, buckets=2)
    deliver(spark, s, FIRST)
    deliver(spark, s, SECOND | {"orders": (ORDER, [("O4", "C1", "P1", day(2), 1.0), ("O5", "C1", "P1", day(4), 1.0)])})
    fact = tables.load(spark, s.table("gold", "FactOrders")).where("order_id IN ('O4', 'O5')")
    joined = fact.join(medallion.product_versions(spark, s), "DimProductKey")
    assert rows(joined, "order_id", "price") == [("O4", 10.0), ("O5", 12.0)]


def test_a_correction_of_a_product_in_one_load_and_in_two(spark, tmp_path):
    first, fixed = ("P1", "Pen", 1.0, day(1)), ("P1", "Pen", 2.0, day(1))
    got = []
    for name, loads in (("one", [[first, fixed]]), ("two", [[first], [fixed]])):
        s = settings_of(tmp_path / name)
        for load in loads:
            for product in load:  # a file each, in order of arrival
                frame(spark, [product], PRODUCT).coalesce(1).write.mode("append").parquet(s.folder("source", "products"))
                time.sleep(1.1)
            medallion.run(spark, s)
        got.append(rows(tables.load(spark, s.table("gold", "DimProducts")), "product_id", "price"))
    assert got == [[("P1", 2.0)]] * 2


def test_orders_are_compared_only_where_one_repeats(spark, tmp_path, monkeypatch):
    seen, real = [], medallion.dedup_latest
    monkeypatch.setattr(medallion, "dedup_latest", lambda df, keys, latest: seen.append(keys) or real(df, keys, latest))
    s = settings_of(tmp_path, buckets=2)
    known = {"customers": (CUSTOMER, [("C1", "a@x", "A", "B")]), "products": (PRODUCT, [("P1", "Pen", 1.0, day(1))])}
    deliver(spark, s, known | {"orders": (ORDER, [("O1", "C1", "P1", day(1), 1.0), ("O2", "C8", "P1", day(1), 1.0)])})
    assert seen == []
    # O2 is open; of two deliveries of it the later one counts, and of O1 too
    again = [("O1", "C1", "P1", day(2), 2.0), ("O2", "C9", "P1", day(2), 2.0)]
    for load in (again, [(o, "C1", p, d, 3.0) for o, _, p, d, _ in again]):
        frame(spark, load, ORDER).coalesce(1).write.mode("append").parquet(s.folder("source", "orders"))
        time.sleep(1.1)
    medallion.run(spark, s)
    assert ["order_id"] in seen
    assert rows(tables.load(spark, s.table("gold", "FactOrders")), "order_id", "DimCustomerKey", "total_amount") == [("O1", 1, 3.0), ("O2", 1, 3.0)]
    assert tables.load(spark, s.table("gold", "FactOrders_open")).count() == 0


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


@pytest.mark.parametrize("incremental", [True, False])
def test_a_load_leaves_no_shuffle_files(spark, tmp_path, incremental):
    s = settings_of(tmp_path, buckets=2, incremental=incremental)
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES)
    for delivery in (FIRST, SECOND):
        deliver(spark, s, delivery)
    until = time.time() + 20  # they are removed beside what goes on
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FREE_SHUFFLES) == setting


def test_the_setting_for_shuffle_files_is_put_back(spark):
    before = spark.conf.get(FREE_SHUFFLES)
    with pytest.raises(KeyError):
        with freed_shuffles(spark), freed_shuffles(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"
            counted = spark.range(1000).groupBy(F.col("id") % 7).count()
            assert len(counted.collect()) == len(counted.collect()) == counted.count() == 7  # shuffled again
            raise KeyError
    assert spark.conf.get(FREE_SHUFFLES) == before


@pytest.mark.parametrize("incremental", [True, False])
def test_lookups_of_repeated_orders_do_not_compare_them(spark, tmp_path, monkeypatch, incremental):
    """What the comparison shuffles is done with, and gone, before the lookups shuffle."""
    plans, made, real = {}, [], medallion.materialise

    def materialise(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        made.append(real(df, label))
        return made[-1]

    monkeypatch.setattr(medallion, "materialise", materialise)
    s = settings_of(tmp_path, buckets=2, incremental=incremental)
    orders = [("O1", "C1", "P1", day(1), 1.0), ("O1", "C1", "P1", day(2), 2.0), ("O2", "C1", "P1", day(2), 3.0)]
    known = {"customers": (CUSTOMER, [("C1", "a@x", "A", "B")]), "products": (PRODUCT, [("P1", "Pen", 1.0, day(1))])}
    deliver(spark, s, known | {"orders": (ORDER, orders)})
    assert "Window" in plans["latest-orders"] and "Window" not in plans["fact-rows"]
    assert len(rows(tables.load(spark, s.table("gold", "FactOrders")), "order_id")) == 2
    assert not any(folder_exists(spark, df.inputFiles()[0].rsplit("/", 1)[0]) for df in made)


@pytest.mark.parametrize("incremental", [True, False])
def test_of_files_of_one_time_the_last_by_name_counts(spark, tmp_path, monkeypatch, incremental):
    seen, real = [], medallion.dedup_latest
    monkeypatch.setattr(medallion, "dedup_latest", lambda df, *a: seen.append(df.schema) or real(df, *a))
    s = settings_of(tmp_path, buckets=2, incremental=incremental)
    for i in range(1, 12):  # by name the ninth is the last one
        amount = [("O1", "C1", "P1", day(1), float(i))]
        frame(spark, amount, ORDER).coalesce(1).write.parquet(str(tmp_path / "made" / str(i)))
        (tmp_path / "source" / "orders").mkdir(parents=True, exist_ok=True)
        file = next((tmp_path / "made" / str(i)).glob("part-*"))
        os.utime(file, (1_700_000_000, 1_700_000_000))
        file.rename(tmp_path / "source" / "orders" / f"f{i}.parquet")
    deliver(spark, s, {"customers": (CUSTOMER, [("C1", "a@x", "A", "B")]), "products": (PRODUCT, [("P1", "Pen", 1.0, day(1))])})
    assert rows(tables.load(spark, s.table("gold", "FactOrders")), "order_id", "DimCustomerKey", "total_amount") == [("O1", 1, 9.0)]
    # they are compared by a number in place of the name
    assert [schema[medallion.SOURCE_FILE].dataType.typeName() for schema in seen] == ["integer"]
