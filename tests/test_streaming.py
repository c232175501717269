from pyspark.sql import functions as F

from conftest import rows
from lodestar.operators.scd2 import versions
from lodestar.sources import tables
from lodestar.streaming import append_stream, apply_changes_stream, dedup_append, staged, table_stream


def test_failures_are_counted_in_the_progress(spark, table, tmp_path):
    data = spark.createDataFrame([("P1", "Pen"), (None, "Cap"), ("P2", None)], "product_id string, product_name string")
    tables.create(data, table, str(tmp_path / "t"))
    rules = {"rule1": "product_id IS NOT NULL", "rule2": "product_name IS NOT NULL"}
    stream = staged(table_stream(spark, table), rules)
    progress = append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("P1", "Pen")]
    assert progress.observedMetrics["expectations"].asDict() == {"rows": 3, "rule1": 1, "rule2": 1}


def test_replay_of_the_last_batch_changes_nothing(spark, table, tmp_path):
    """A crash after publishing and before the commit makes Spark run the batch again."""
    changes = spark.range(300).select(
        (F.col("id") % 7).alias("k"), (F.col("id") * 37 % 300).alias("seq"), (F.col("id") % 4).alias("v")
    )
    source, checkpoint = tmp_path / "source", tmp_path / "cp"
    changes.repartition(3).write.parquet(str(source))

    def run():
        stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        apply_changes_stream(
            spark, stream, table, str(tmp_path / "dim"), str(checkpoint), key=["k"], sequence_by="seq", buckets=2
        )
        return rows(tables.load(spark, table), "k", "v", "valid_from", "valid_to", "is_current")

    expected = rows(versions(changes, ["k"], "seq", ["v"]), "k", "v", "valid_from", "valid_to", "is_current")
    assert run() == expected
    for commit in (checkpoint / "commits").glob("*2*"):
        commit.unlink()
    assert run() == expected


def test_repeats_are_dropped_and_late_rows_counted(spark, tmp_path):
    """Three runs with a restart between each: keyed state survives, what is older than the watermark is counted."""
    schema = "k int, at timestamp, v string"
    source, target, checkpoint = (str(tmp_path / p) for p in ("source", "out", "cp"))

    def run(data):
        made = spark.createDataFrame(data, "k int, at string, v string").withColumn("at", F.to_timestamp("at"))
        made.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        return dedup_append(stream, ["k"], "at", "1 hour", target, checkpoint)

    assert run([(1, "2024-01-01 10:00", "a"), (1, "2024-01-01 10:05", "b"), (2, "2024-01-01 10:10", "c")])["repeated"] == 1
    second = run([(2, "2024-01-01 10:20", "d"), (3, "2024-01-01 12:00", "e"), (None, None, "f")])
    assert (second["read"], second["repeated"]) == (3, 1)
    third = run([(4, "2024-01-01 09:00", "late"), (3, "2024-01-01 12:01", "g"), (5, "2024-01-01 11:30", "h")])
    assert third["late"] == 1 and third["repeated"] == 1
    assert [r[0] for r in rows(spark.read.parquet(target), "k")] == [1, 2, 3, 5]
    assert run([])["read"] == 0
