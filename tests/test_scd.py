import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodestar.operators import scd1_upsert, scd2_apply, versions
from lodestar.plans.clean import clean_customers
from lodestar.sources import tables

T1, T2 = "timestamp'2024-01-01 00:00:00'", "timestamp'2024-02-01 00:00:00'"
CUSTOMER = "customer_id string, email string, first_name string, last_name string, seen int"
BATCH1 = [
    ("C1", "ann@gmail.com", "Ann", "Lee", 1),
    ("C2", "bob@x.org", "Bob", None, 1),
    ("C3", "no-at-sign", "Cy", "Poe", 1),
    ("C4", None, "Di", "Ray", 1),
    ("C1", "ann@gmail.com", "Ann", "Lee", 1),
]
BATCH2 = [("C2", "bob@old.org", "Bob", None, 1), ("C2", "bob@y.org", "Bob", None, 2), ("C5", "eve@y.org", "Eve", "Fox", 2)]


@pytest.mark.parametrize("buckets", [None, 3])
def test_type1_two_batches(spark, table, tmp_path, buckets):
    def load(data, ts):
        scd1_upsert(
            spark, table, clean_customers(spark.createDataFrame(data, CUSTOMER)), str(tmp_path / "d"),
            key="customer_id", surrogate="DimCustomerKey", latest=["seen"], technical=["seen"],
            load_ts=F.expr(ts), buckets=buckets,
        )
        out = tables.load(spark, table).withColumns({c: F.date_format(c, "MM") for c in ("create_date", "update_date")})
        return rows(out, "DimCustomerKey", "customer_id", "Domain", "create_date", "update_date")

    first = [(1, "C1", "gmail.com", "01", "01"), (2, "C2", "x.org", "01", "01"), (3, "C3", None, "01", "01"), (4, "C4", None, "01", "01")]
    assert load(BATCH1, T1) == first
    second = [first[0], (2, "C2", "y.org", "01", "02"), *first[2:], (5, "C5", "y.org", "02", "02")]
    assert load(BATCH2, T2) == second
    assert load(BATCH2, T2) == second
    assert set(tables.load(spark, table).columns) == {
        "customer_id", "email", "Domain", "Full_name", "DimCustomerKey", "create_date", "update_date"
    }


def test_type1_only_changed(spark, table, tmp_path):
    def load(data, ts):
        scd1_upsert(
            spark, table, spark.createDataFrame(data, "id string, v int"), str(tmp_path / "d"),
            key="id", surrogate="sk", latest=["v"], load_ts=F.expr(ts), only_changed=True,
        )
    load([("a", 1), ("b", 1)], T1)
    load([("a", 1), ("b", 2)], T2)
    assert rows(tables.load(spark, table).select("id", "v", F.month("update_date"))) == [("a", 1, 1), ("b", 2, 2)]


PRODUCT = "product_id string, product_name string, price double, updated_at int"
P = [("P1", "Pen", 10.0, 1), ("P1", "Pen", 10.0, 5), ("P1", "Pen", 12.0, 3)]
P_HISTORY = [("P1", 10.0, 1, 3), ("P1", 12.0, 3, 5), ("P1", 10.0, 5, None)]


def apply(spark, table, path, data, batch_id, **more):
    scd2_apply(
        spark, table, spark.createDataFrame(data, PRODUCT), path,
        key=["product_id"], sequence_by="updated_at", batch_id=batch_id, **more,
    )


def history(spark, table):
    got = tables.load(spark, table)
    assert got.where("is_current <> (valid_to IS NULL)").isEmpty()
    return sorted(tuple(r) for r in got.select("product_id", "price", "valid_from", "valid_to").collect())


@pytest.mark.parametrize("buckets", [None, 4])
@pytest.mark.parametrize("order", [[2, 1, 0], [1, 2, 0]])
def test_type2_any_arrival_order(spark, table, tmp_path, order, buckets):
    path = str(tmp_path / "d")
    for batch, i in enumerate(order):
        apply(spark, table, path, [P[i]], batch, buckets=buckets)
        apply(spark, table, path, [P[i]], batch, buckets=buckets)  # replay
    assert history(spark, table) == sorted(P_HISTORY, key=lambda t: (t[0], t[1], t[2]))


def test_type2_late_event_step_by_step(spark, table, tmp_path):
    path = str(tmp_path / "d")
    apply(spark, table, path, P[:1], 0)
    apply(spark, table, path, P[1:2] + [("P2", "Cap", 1.0, 1)], 1)
    assert history(spark, table) == [("P1", 10.0, 1, None), ("P2", 1.0, 1, None)]
    apply(spark, table, path, P[2:], 2)
    assert history(spark, table) == sorted([*P_HISTORY, ("P2", 1.0, 1, None)], key=lambda t: (t[0], t[1], t[2]))


def test_type2_conflicts(spark, table, tmp_path):
    path = str(tmp_path / "d")
    with pytest.raises(ValueError, match="different values"):
        apply(spark, table, path, [("P1", "Pen", 1.0, 1), ("P1", "Pen", 2.0, 1)], 0)
    apply(spark, table, path, [("P1", "Pen", 1.0, 1), ("P1", "Pen", 1.0, 1)], 0)
    apply(spark, table, path, [("P1", "Pen", 2.0, 1)], 1)
    assert history(spark, table) == [("P1", 2.0, 1, None)]
    with pytest.raises(ValueError, match="sequence_by"):
        scd2_apply(spark, table, spark.createDataFrame(P, PRODUCT), path, key=["product_id"], sequence_by="product_id", batch_id=2)


@pytest.mark.parametrize("first, second", [(4, 8), (None, 8), (8, None)])
def test_type2_keeps_every_key_when_another_bucket_count_is_passed(spark, table, tmp_path, first, second):
    path = str(tmp_path / "d")
    apply(spark, table, path, [(f"P{i}", "Pen", 1.0, 1) for i in range(40)], 0, buckets=first)
    apply(spark, table, path, [(f"P{i}", "Pen", 2.0, 2) for i in range(3)], 1, buckets=second)
    got = history(spark, table)
    assert len(got) == 43 and len({r[0] for r in got}) == 40


@pytest.mark.parametrize("buckets", [None, 3])
def test_type2_replaced_batch_forgets_its_former_keys(spark, table, tmp_path, buckets):
    path = str(tmp_path / "d")
    apply(spark, table, path, [("P1", "Pen", 1.0, 1), ("P2", "Cap", 2.0, 1)], 0, buckets=buckets)
    apply(spark, table, path, [("P1", "Pen", 3.0, 1)], 0, buckets=buckets)
    assert history(spark, table) == [("P1", 3.0, 1, None)]
    apply(spark, table, path, [], 0, buckets=buckets)
    assert history(spark, table) == []


def test_type2_arrival_order_and_missing_sequence(spark, tmp_path):
    """A correction in the same batch and in the next one end in the same rows."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS testing")
    first, second = ("P1", "Pen", 1.0, 1, 1), ("P1", "Pen", 2.0, 1, 2)
    got = []
    for name, batches in (("one", [[first, second]]), ("two", [[first], [second]])):
        for number, batch in enumerate([*batches, [("P2", "Cap", 1.0, None, 1)]]):
            scd2_apply(
                spark, f"testing.arrival_{name}", spark.createDataFrame(batch, PRODUCT + ", seen int"), str(tmp_path / name),
                key=["product_id"], sequence_by="updated_at", arrival=["seen"], batch_id=number,
            )
        got.append(history(spark, f"testing.arrival_{name}"))
    assert got == [[("P1", 2.0, 1, None)]] * 2


def test_type2_other_types_are_rejected_before_anything_is_written(spark, table, tmp_path):
    path = str(tmp_path / "d")
    apply(spark, table, path, [("P1", "Pen", 1.0, 1)], 0)
    odd = spark.createDataFrame([("P1", "Pen", "2", 2)], PRODUCT.replace("double", "string"))
    with pytest.raises(ValueError, match="the dimension has"):
        scd2_apply(spark, table, odd, path, key=["product_id"], sequence_by="updated_at", batch_id=1)
    assert history(spark, table) == [("P1", 1.0, 1, None)]


def test_type2_empty_first_batch_creates_the_table(spark, table, tmp_path):
    apply(spark, table, str(tmp_path / "d"), [], 0, buckets=3)
    assert history(spark, table) == []
    apply(spark, table, str(tmp_path / "d"), [("P1", "Pen", 1.0, 1)], 1, buckets=3)
    assert history(spark, table) == [("P1", 1.0, 1, None)]


@pytest.mark.parametrize("buckets", [None, 3])
def test_type1_older_load_changes_nothing(spark, table, tmp_path, buckets):
    for data in ([("a", 5, 2)], [("a", 4, 1), ("b", 1, 1)], [("b", 0, None)], [("b", 2, 1)]):
        scd1_upsert(
            spark, table, spark.createDataFrame(data, "id string, v int, seen int"), str(tmp_path / "d"),
            key="id", surrogate="sk", latest=["seen"], buckets=buckets,
        )
    assert rows(tables.load(spark, table), "id", "v", "seen", "sk") == [("a", 5, 2, 1), ("b", 2, 1, 2)]


@pytest.mark.parametrize("buckets", [None, 2])
def test_type2_compacted_log_has_the_same_history(spark, table, tmp_path, buckets, monkeypatch):
    from lodestar.operators import scd2

    monkeypatch.setattr(scd2, "COMPACT_AFTER", 3)
    rnd = random.Random(3)
    path, latest = str(tmp_path / "d"), {}
    for batch in range(9):
        rows_now = list({(k, s): (k, "Pen", float(rnd.randrange(3)), s) for k, s in ((f"P{rnd.randrange(4)}", rnd.randrange(8)) for _ in range(5))}.values())
        latest |= {(r[0], r[3]): r[2] for r in rows_now}
        apply(spark, table, path, rows_now, batch, buckets=buckets)
        apply(spark, table, path, rows_now, batch, buckets=buckets)  # replay
    assert len(scd2._batches(spark, f"{path}/log")) <= 4
    expected = brute_versions([(k, v, s) for (k, s), v in latest.items()])
    assert rows(tables.load(spark, table), "product_id", "price", "valid_from", "valid_to") == expected


def brute_versions(data):
    out = []
    for key in {d[0] for d in data}:
        kept = []
        for _, value, seq in sorted((d for d in data if d[0] == key), key=lambda d: d[2]):
            if not kept or kept[-1][0] != value:
                kept.append((value, seq))
        for i, (value, seq) in enumerate(kept):
            out.append((key, value, seq, kept[i + 1][1] if i + 1 < len(kept) else None))
    return sorted(out, key=lambda t: [(v is not None, v) for v in t])


@pytest.mark.parametrize("seed", range(4))
def test_type2_split_key_has_the_same_history(spark, seed):
    rnd = random.Random(seed)
    n = rnd.choice([5, 200, 1500])
    # one key holds most rows, and long runs of one value span whole segments
    data = [(rnd.choice([1, 1, 1, 2, None]), None if 300 < i < 900 else rnd.choice([1, 1, 1, 2, None]), i) for i in range(n)]
    df = spark.createDataFrame(data, "k int, v int, seq int")
    expected = brute_versions(data)
    for limit in (0, 5_000_000):
        got = versions(df, ["k"], "seq", ["v"], max_group_rows=limit)
        assert rows(got, "k", "v", "valid_from", "valid_to") == expected
