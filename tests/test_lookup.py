import random

import pytest

from conftest import rows
from lodestar.operators import Lookup, build_fact, lookup_keys

ORDER = "order_id string, customer_id string, product_id string, at int"
ORDERS = [("O1", "C1", "P1", 4), ("O2", "C9", "P1", 1), ("O3", "C2", "P9", 9), ("O4", None, "P1", 0)]
PERIODS = [("P1", 11, 1, 3, False), ("P1", 12, 3, 5, False), ("P1", 13, 5, None, True), ("P2", 21, 1, 2, False)]
PERIOD = "product_id string, key int, valid_from int, valid_to int, is_current boolean"


@pytest.fixture
def dims(spark):
    customers = spark.createDataFrame([("C1", 1), ("C2", 2)], "customer_id string, sk int")
    return customers, spark.createDataFrame(PERIODS, PERIOD)


def test_fact_keeps_every_order_once(spark, dims):
    customers, products = dims
    fact = build_fact(
        spark.createDataFrame(ORDERS, ORDER),
        [
            Lookup(customers, "customer_id", "customer_id", "sk", "DimCustomerKey"),
            Lookup(products, "product_id", "product_id", "key", "DimProductKey"),
        ],
    )
    assert fact.columns == ["order_id", "at", "DimCustomerKey", "DimProductKey"]
    assert rows(fact, "order_id", "DimCustomerKey", "DimProductKey") == [
        ("O1", 1, 13), ("O2", None, 13), ("O3", 2, None), ("O4", None, 13)
    ]


@pytest.mark.parametrize("joined, group", [(32, 10**6), (0, 10**6), (0, 0)])
def test_as_of(spark, dims, joined, group):
    lookup = Lookup(dims[1], "product_id", "product_id", "key", "k", as_of="at", unknown=-1)
    out = lookup_keys(
        spark.createDataFrame(ORDERS, ORDER), lookup, max_joined_versions=joined, max_group_rows=group
    )
    assert rows(out, "order_id", "k") == [("O1", 12), ("O2", 11), ("O3", -1), ("O4", -1)]


def test_as_of_split_hot_key(spark):
    rnd = random.Random(5)
    starts = sorted(rnd.sample(range(3000), 40))
    periods = [("P1", i, f, t if i % 7 else t and t - 1) for i, (f, t) in enumerate(zip(starts, [*starts[1:], None]))]
    facts = [(i, rnd.choice(["P1", "P1", "P2", None]), rnd.choice([rnd.randrange(3000), None])) for i in range(2500)]

    def brute(key, at):
        found = [p[1] for p in periods if p[0] == key and at is not None and p[2] <= at and (p[3] is None or at < p[3])]
        return found[0] if found else None

    dim = spark.createDataFrame(periods, "p string, key int, valid_from int, valid_to int")
    fact = spark.createDataFrame(facts, "id int, p string, at int")
    out = lookup_keys(fact, Lookup(dim, "p", "p", "key", "k", as_of="at"), max_joined_versions=0, max_group_rows=0)
    assert rows(out, "id", "k") == [(i, brute(p, at)) for i, p, at in facts]


def test_repeated_dimension_key_is_rejected(spark):
    dim = spark.createDataFrame([("C1", 1), ("C1", 2)], "customer_id string, sk int")
    with pytest.raises(ValueError, match="repeats"):
        lookup_keys(spark.createDataFrame(ORDERS, ORDER), Lookup(dim, "customer_id", "customer_id", "sk", "k"))


def test_skewed_customer_is_split_by_aqe(spark, capsys):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 200_000, 1, 8).selectExpr("id", "case when id % 3 = 0 then 1 else id end c")
        dim = spark.range(1, 200_001).selectExpr("id as c2", "id * 10 as sk")
        out = lookup_keys(fact, Lookup(dim, "c", "c2", "sk", "k"))
        assert out.where("k = c * 10").count() == 200_000 and out.count() == 200_000
        out.collect()
        out.explain()
        assert "skew=true" in capsys.readouterr().out
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_as_of_has_one_meaning(spark):
    """Overlaps, gaps, missing beginnings and map columns: the same rows by join and by sort."""
    rnd = random.Random(11)
    begins = rnd.sample(range(200), 25)
    periods = [(rnd.choice(["P1", "P1", "P2"]), i, f, rnd.choice([None, f + 3, f + 60])) for i, f in enumerate(begins)]
    periods += [("P1", 99, None, None), (None, 98, 5, None)]
    facts = [(i, rnd.choice(["P1", "P2", "P3", None]), rnd.choice([None, *range(260)])) for i in range(300)]

    def brute(key, at):
        before = [p for p in periods if p[0] == key and p[2] is not None and at is not None and p[2] <= at and key]
        last = max(before, key=lambda p: p[2], default=None)
        return last[1] if last and (last[3] is None or at < last[3]) else None

    dimension = spark.createDataFrame(periods, "pid string, k int, valid_from int, valid_to int")
    fact = spark.createDataFrame(facts, "id int, pid2 string, at int").selectExpr("*", "map('a', id) AS extra")
    expected = sorted((i, brute(key, at)) for i, key, at in facts)
    for joined, group in ((1000, 10**6), (0, 10**6), (0, 0)):
        lookup = Lookup(dimension, "pid2", "pid", "k", "found", as_of="at")
        got = lookup_keys(fact, lookup, max_joined_versions=joined, max_group_rows=group)
        assert sorted(map(tuple, got.select("id", "found").collect())) == expected


def test_two_versions_that_begin_together_are_rejected(spark):
    twice = spark.createDataFrame([("P1", 1, 1, None), ("P1", 2, 1, None)], "pid string, k int, valid_from int, valid_to int")
    with pytest.raises(ValueError, match="repeats the key"):
        lookup_keys(spark.createDataFrame([("P1", 1)], "p string, at int"), Lookup(twice, "p", "pid", "k", "k", as_of="at"))
