"""Columns with dots, backticks and the names that operators use themselves, through every operator."""

import pytest
from pyspark.sql import functions as F

from lodestar.names import Plain, column, fresh
from lodestar.operators import (
    Lookup, assign_surrogate_keys, build_fact, dedup_latest, lookup_keys, max_key, rank_within, scd1_upsert,
    scd2_apply, scd2_splice, split_new_existing, top_within, upsert, versions,
)
from lodestar.sources import tables

# what operators call columns of their own, and names that need quoting
ODD = ["a.b", "x`y", "_rank", "_row_number", "_dense_rank", "_kept", "_known", "_row", "_segment", "_position",
       "_offset", "_previous", "_before", "_after", "known", "given", "found", "c0", "s0", "kept", "number", "_batch2",
       "_business_key", "_from", "_to", "_until", "_arrived", "_times", "_touched0"]


@pytest.fixture(scope="module")
def frame(spark):
    """Five rows: `k.1` 1..5, `g.2` 0 or 1, `at` 1..5, and the odd columns holding 77."""
    rows = spark.range(1, 6).select(
        F.col("id").alias("k.1"), (F.col("id") % 2).alias("g.2"), F.col("id").alias("at"), *(F.lit(77).alias(c) for c in ODD)
    )
    return spark.createDataFrame(rows.collect(), rows.schema)


def untouched(got, frame):
    assert got.columns[: len(frame.columns)] == frame.columns
    assert all(r[c] == 77 for r in got.collect() for c in ODD)
    return [r.asDict() for r in got.collect()]


@pytest.mark.parametrize("limit", [0, 1000])
def test_rankings(frame, limit):
    got = rank_within(
        frame, ["g.2"], "k.1", ["at"], row_number="r.n", rank="r.k", dense_rank="r.d", max_group_rows=limit
    )
    rows = untouched(got, frame)
    assert {r["k.1"]: (r["r.n"], r["r.k"], r["r.d"]) for r in rows} == {5: (1,) * 3, 3: (2,) * 3, 1: (3,) * 3, 4: (1,) * 3, 2: (2,) * 3}
    assert sorted(r["k.1"] for r in untouched(top_within(frame, ["g.2"], "k.1", ["at"], 1), frame)) == [4, 5]
    assert sorted(r["k.1"] for r in untouched(dedup_latest(frame, ["g.2"], ["k.1"]), frame)) == [4, 5]


def test_keys(frame):
    keyed = untouched(assign_surrogate_keys(frame, ["k.1"], 10, "s.k"), frame)
    assert sorted((r["k.1"], r["s.k"]) for r in keyed) == [(i, 10 + i) for i in range(1, 6)]
    dimension = frame.where("`k.1` < 3").select(column("k.1"), (column("k.1") * 100).alias("s.k"))
    assert max_key(dimension, "s.k") == 200
    new, existing = split_new_existing(frame, dimension, "k.1", ["s.k"])
    assert sorted(r["k.1"] for r in untouched(new, frame)) == [3, 4, 5]
    assert sorted(r["s.k"] for r in untouched(existing, frame)) == [100, 200]
    with pytest.raises(ValueError, match="repeats the key"):
        split_new_existing(frame, dimension.union(dimension), "k.1", ["s.k"])


@pytest.mark.parametrize("limit", [0, 1000])
def test_histories_and_lookups(frame, limit):
    history = versions(frame, ["g.2"], "at", ["k.1"], max_group_rows=limit)
    rows = history.collect()
    assert len(rows) == 5 and all(r[c] == 77 for r in rows for c in ODD)
    lookup = Lookup(history.select(column("g.2"), column("k.1"), "valid_from", "valid_to"), "g.2", "g.2", "k.1", "f.k", as_of="at")
    found = lookup_keys(frame, lookup, max_joined_versions=limit, max_group_rows=limit)
    assert all(r["f.k"] == r["k.1"] for r in untouched(found, frame))
    plain = frame.select(column("k.1"), (column("k.1") * 2).alias("d.k"))
    assert all(r["out.k"] == 2 * r["k.1"] for r in untouched(lookup_keys(frame, Lookup(plain, "k.1", "k.1", "d.k", "out.k")), frame))
    assert "k.1" not in build_fact(frame, [Lookup(plain, "k.1", "k.1", "d.k", "out.k")]).columns


def test_tables(spark, frame, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS testing")
    names = [f"testing.odd{i}_{id(tmp_path)}" for i in range(4)]
    for i in range(2):
        rows = frame.withColumn("at", F.col("at") + 10 * i)
        upsert(spark, names[0], rows, ["k.1", "a.b"], str(tmp_path / "u"), buckets=3, bucket_by=["k.1"], sequence=["at"])
        scd1_upsert(spark, names[1], rows.drop("_row"), str(tmp_path / "s"), key="k.1", surrogate="s.k", latest=["at"], technical=["x`y"])
        scd2_apply(spark, names[2], rows, str(tmp_path / "h"), key=["g.2"], sequence_by="at", arrival=["_arrived"], batch_id=i, buckets=2)
        scd2_splice(spark, names[3], rows, str(tmp_path / "p"), key=["g.2"], sequence_by="at", batch_id=i)
    assert sorted(r["at"] for r in untouched(tables.load(spark, names[0]), frame)) == [11, 12, 13, 14, 15]
    first = tables.load(spark, names[1])
    assert sorted((r["k.1"], r["s.k"], r["at"]) for r in first.collect()) == [(i, i, 10 + i) for i in range(1, 6)]
    assert tables.load(spark, names[2]).count() == tables.load(spark, names[3]).count() == 10


def test_helpers(frame):
    assert fresh("a", ["A", "a_"]) == "a__"
    plain = Plain(frame)
    assert plain.of("K.1") == "c0" and plain.back(plain.df).columns == frame.columns
    with pytest.raises(ValueError, match="no column"):
        plain.of("missing")
