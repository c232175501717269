import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodestar.sources.ingest import Dataset, ingest_all, ingest_stream


def put(df, folder, name):
    """One Parquet file of a given name."""
    df.toPandas().to_parquet(f"{folder}/{name}.parquet", index=False)


@pytest.fixture
def places(tmp_path):
    (tmp_path / "source").mkdir()
    return [str(tmp_path / p) for p in ("source", "bronze", "checkpoint")]


def test_two_batches_and_an_idle_run(spark, places):
    source, bronze, checkpoint = places
    put(spark.range(600).selectExpr("id", "'x' a"), source, "first [batch] 100%")
    assert ingest_stream(spark, source, bronze, checkpoint).count() == 600
    put(spark.range(600, 1000).selectExpr("id", "'y' a"), source, "second")
    assert ingest_stream(spark, source, bronze, checkpoint).count() == 1000
    got = ingest_stream(spark, source, bronze, checkpoint)
    assert got.count() == 1000 and got.select("id").distinct().count() == 1000
    assert rows(got.select("_batch_id").distinct()) == [(0,), (1,)]
    assert got.where("_file_time IS NULL OR _source_file IS NULL").isEmpty()


def test_unknown_columns_are_rescued(spark, places):
    source, bronze, checkpoint = places
    put(spark.createDataFrame([(1, "x")], "id int, a string"), source, "f1")
    ingest_stream(spark, source, bronze, checkpoint)
    put(spark.createDataFrame([(2, "y", 1)], "id int, a string, b int"), source, "f2")
    put(spark.createDataFrame([(3,)], "id int"), source, "f3")
    got = ingest_stream(spark, source, bronze, checkpoint)
    assert rows(got, "id", "a", "_rescued_data") == [(1, "x", None), (2, "y", '{"b":1}'), (3, None, None)]


def test_values_of_another_type_are_rescued_and_stop_nothing(spark, places):
    source, bronze, checkpoint = places
    put(spark.createDataFrame([(1, "x")], "id int, a string"), source, "f1")
    ingest_stream(spark, source, bronze, checkpoint)
    put(spark.createDataFrame([(2, 5)], "id int, a int"), source, "f2")
    put(spark.createDataFrame([(4, "y")], "id int, a string"), source, "f3")
    put(spark.createDataFrame([(5, 1.5, 7)], "id int, a double, b int"), source, "f4")
    got = ingest_stream(spark, source, bronze, checkpoint)
    rescued = rows(got, "id", "a", "_rescued_data")
    assert rescued == [(1, "x", None), (2, None, '{"a":5}'), (4, "y", None), (5, None, '{"a":1.5,"b":7}')]
    assert ingest_stream(spark, source, bronze, checkpoint).count() == 4


def test_added_fields_of_a_struct_are_rescued(spark, places):
    source, bronze, checkpoint = places
    spark.sql("SELECT 1 id, named_struct('x', 1) s").coalesce(1).write.mode("append").parquet(source)
    ingest_stream(spark, source, bronze, checkpoint)
    spark.sql("SELECT 2 id, named_struct('x', 2, 'y', 'z') s").coalesce(1).write.mode("append").parquet(source)
    got = ingest_stream(spark, source, bronze, checkpoint)
    assert rows(got, "id", "s.x", "_rescued_data") == [(1, 1, None), (2, 2, '{"s":{"x":2,"y":"z"}}')]


def test_schema_is_inferred_from_all_files(spark, places):
    source, bronze, checkpoint = places
    put(spark.createDataFrame([(1,)], "id int"), source, "a")
    put(spark.createDataFrame([(2, 5)], "id int, b int"), source, "b")
    assert rows(ingest_stream(spark, source, bronze, checkpoint), "id", "b", "_rescued_data") == [(1, None, None), (2, 5, None)]


def test_old_files_arrive_too(spark, places):
    import os

    source, bronze, checkpoint = places
    put(spark.range(5).toDF("id"), source, "new")
    ingest_stream(spark, source, bronze, checkpoint)
    put(spark.range(5, 10).toDF("id"), source, "old")
    month_ago = os.path.getmtime(f"{source}/new.parquet") - 30 * 24 * 3600
    os.utime(f"{source}/old.parquet", (month_ago, month_ago))
    assert ingest_stream(spark, source, bronze, checkpoint).count() == 10


def test_a_folder_without_files_is_an_empty_dataset(spark, places):
    source, bronze, checkpoint = places
    assert ingest_stream(spark, source, bronze, checkpoint).count() == 0
    put(spark.range(2).toDF("id"), source, "one")
    assert ingest_stream(spark, source, bronze, checkpoint).count() == 2


def test_file_limit_makes_several_batches(spark, places):
    source, bronze, checkpoint = places
    for i in range(5):
        put(spark.createDataFrame([(i,)], "id int"), source, f"f{i}")
    got = ingest_stream(spark, source, bronze, checkpoint, max_files=2)
    assert got.count() == 5
    assert got.select(F.max("_batch_id")).first()[0] == 2


def test_dataset_list(spark, tmp_path):
    for name in ("orders", "regions"):
        (tmp_path / "source" / name).mkdir(parents=True)
        put(spark.range(3).toDF("id"), f"{tmp_path}/source/{name}", "one")
    out = ingest_all(
        spark, [Dataset("orders"), Dataset("regions")], f"{tmp_path}/source", f"{tmp_path}/bronze", f"{tmp_path}/cp"
    )
    assert {k: v.count() for k, v in out.items()} == {"orders": 3, "regions": 3}


def test_partitioned_source(spark, places):
    source, bronze, checkpoint = places
    spark.range(10).selectExpr("id", "id % 2 AS day").write.partitionBy("day").parquet(source, mode="overwrite")
    got = ingest_stream(spark, source, bronze, checkpoint)
    assert rows(got, "id", "day") == [(i, i % 2) for i in range(10)]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace as Fake

    from lodestar.scratch import shared_folder

    cluster = Fake(master="yarn", applicationId="a1")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Fake(conf={}, sparkContext=cluster))
    assert shared_folder(Fake(conf={"spark.checkpoint.dir": "hdfs:///x/"}, sparkContext=cluster)) == "hdfs:///x"
