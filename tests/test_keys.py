import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodestar.operators import assign_surrogate_keys, max_key, split_new_existing


@pytest.mark.parametrize("n", [0, 1, 3, 5000])
def test_dense_in_key_order(spark, n):
    df = spark.range(n).select((F.col("id") * 7 % 5003).alias("k")).repartition(5)
    out = assign_surrogate_keys(df, ["k"], start=100, out="sk")
    got = rows(out, "sk", "k")
    assert [sk for sk, _ in got] == list(range(101, 101 + n))
    assert [k for _, k in got] == sorted(k for _, k in got)


def test_composite_and_null_keys(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("a", 1)], "x string, y int")
    out = assign_surrogate_keys(df, ["x", "y"], out="sk")
    assert rows(out, "sk", "x", "y") == [(1, None, 3), (2, "a", 1), (3, "a", 2), (4, "b", 1)]


def test_keys_do_not_change_between_reads(spark):
    out = assign_surrogate_keys(spark.range(2000).repartition(7), ["id"], out="sk")
    assert out.join(out.withColumnRenamed("sk", "again"), "id").where("sk <> again").isEmpty()


def test_split(spark):
    incoming = spark.createDataFrame([("C1", 1), ("C2", 2), (None, 3)], "id string, v int")
    dimension = spark.createDataFrame([("C2", 10, "x"), (None, 11, "y"), ("C9", 12, "z")], "id string, sk int, other string")
    new, existing = split_new_existing(incoming, dimension, "id", ["sk"])
    assert rows(new) == [("C1", 1)]
    assert rows(existing, "id", "v", "sk") == [(None, 3, 11), ("C2", 2, 10)]


def test_small_load_does_not_shuffle_the_dimension(spark, tmp_path, capsys):
    spark.range(200_000).select("id", (F.col("id") + 1).alias("sk")).write.parquet(str(tmp_path / "d"))
    spark.range(10).select("id").write.parquet(str(tmp_path / "i"))
    new, existing = split_new_existing(
        spark.read.parquet(str(tmp_path / "i")), spark.read.parquet(str(tmp_path / "d")), "id", ["sk"]
    )
    existing.explain()
    assert "SortMergeJoin" not in capsys.readouterr().out
    new.explain()  # only the load and its matches are exchanged
    assert capsys.readouterr().out.count("BroadcastHashJoin") == 1


def test_max_key_of_nothing(spark):
    assert max_key(spark.createDataFrame([], "sk bigint"), "sk") == 0
