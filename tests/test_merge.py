import uuid

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import rows
from pyspark.sql import functions as F

from lodestar.operators import merge_rows, upsert, upsert_pruned
from lodestar.scratch import fits_in, materialise, stored_bytes
from lodestar.sources import slices, tables

DDL = "id string, k int, v int"


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


@pytest.mark.parametrize("buckets", [None, 4])
def test_update_and_insert(spark, table, tmp_path, buckets):
    path = str(tmp_path / "t")
    upsert(spark, table, frame(spark, [("a", 1, 1), ("b", None, 2)]), ["id", "k"], path, buckets=buckets, bucket_by=["id"])
    second = frame(spark, [("b", None, 20), ("c", 3, 30)])
    for _ in range(2):
        upsert(spark, table, second, ["id", "k"], path)
        assert rows(tables.load(spark, table)) == [("a", 1, 1), ("b", None, 20), ("c", 3, 30)]
    tables.drop_old_versions(spark, table, path)
    assert rows(tables.load(spark, table)) == [("a", 1, 1), ("b", None, 20), ("c", 3, 30)]


@pytest.mark.parametrize("small", [False, True])
def test_plain_equality_inserts_null_keys_again(spark, small):
    target = frame(spark, [("b", None, 2)])
    source = frame(spark, [("b", None, 3)])
    merged = merge_rows(target, source, ["id", "k"], null_safe=False, small_source=small)
    assert rows(merged) == [("b", None, 2), ("b", None, 3)]


def test_repeated_source_key_is_rejected(spark, table, tmp_path):
    with pytest.raises(ValueError, match="repeats the key"):
        upsert(spark, table, frame(spark, [("a", 1, 1), ("a", 1, 2)]), ["id", "k"], str(tmp_path / "t"))
    assert not tables.exists(spark, table)


def test_schema_must_agree(spark):
    with pytest.raises(ValueError, match="differs"):
        merge_rows(frame(spark, []), spark.createDataFrame([], "id string, k bigint, v int"), ["id"])


def test_only_touched_buckets_are_rewritten(spark, table, tmp_path):
    path = str(tmp_path / "t")
    data = spark.range(100).selectExpr("cast(id as string) id", "cast(id as int) k", "1 v")
    upsert(spark, table, data, ["id"], path, buckets=8)
    before = {r[0] for r in spark.table(table).selectExpr("_metadata.file_path").distinct().collect()}
    upsert(spark, table, frame(spark, [("7", 7, 2)]), ["id"], path)
    after = {r[0] for r in spark.table(table).selectExpr("_metadata.file_path").distinct().collect()}
    assert len(after - before) == 1 and len(before & after) >= 6
    assert tables.load(spark, table).where("v = 2").count() == 1
    assert tables.load(spark, table).count() == 100


@pytest.mark.parametrize("small", [False, True])
def test_only_changed(spark, small):
    target = spark.createDataFrame([("a", 1, "t1"), ("b", 2, "t1")], "id string, v int, at string")
    source = spark.createDataFrame([("a", 1, "t2"), ("b", 3, "t2")], "id string, v int, at string")
    source = source.unionByName(spark.createDataFrame([("c", None, "t2")], source.schema))
    merged = merge_rows(target, source, ["id"], only_changed=["v"], small_source=small)
    assert rows(merged) == [("a", 1, "t1"), ("b", 3, "t2"), ("c", None, "t2")]


def test_small_source_does_not_shuffle_the_target(spark, tmp_path, capsys):
    spark.range(300_000).selectExpr("id", "id v").write.parquet(str(tmp_path / "t"))
    spark.range(10).selectExpr("id", "0L v").write.parquet(str(tmp_path / "s"))
    merged = merge_rows(
        spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s")), ["id"], small_source=True
    )
    merged.explain()
    joins = capsys.readouterr().out
    # both joins that read the target broadcast the source
    assert joins.count("BroadcastHashJoin") >= 2 and "SortMergeJoin [id" not in joins
    assert merged.where("v = 0").count() == 10


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.integers(0, 20), st.integers()), st.dictionaries(st.integers(0, 20), st.integers()))
def test_merge_is_a_dictionary_update(spark, old, new):
    ddl = "id long, v decimal(38,0)"
    target = spark.createDataFrame([], ddl) if not old else spark.createDataFrame([(k, str(v)) for k, v in old.items()], "id long, v string")
    target = target.selectExpr("id", "cast(v as string) v")
    source = spark.createDataFrame([(k, str(v)) for k, v in new.items()], "id long, v string")
    expected = sorted((k, str(v)) for k, v in {**old, **new}.items())
    once = merge_rows(target, source, ["id"], small_source=True)
    assert rows(once) == expected
    assert rows(merge_rows(once, source, ["id"])) == expected


# ---------------------------------------------------------------- sliced tables


def files_of(spark, table):
    return {r[0] for r in spark.table(table).selectExpr("_metadata.file_path").distinct().collect()}


def numbers(spark, start, stop, v=1):
    return spark.range(start, stop).selectExpr("cast(id as string) id", "cast(id as int) k", f"{v} v")


@pytest.fixture
def sliced(spark, table, tmp_path):
    """A table of 3000 rows in several slices."""
    path = str(tmp_path / "t")
    upsert_pruned(spark, table, numbers(spark, 0, 3000), ["k"], path, part_bytes=2000)
    assert len(slices.names(spark, table)) > 5
    return table, path


def test_one_row_replaces_one_file_and_new_rows_none(spark, sliced):
    table, path = sliced
    before = files_of(spark, table)
    upsert_pruned(spark, table, numbers(spark, 1234, 1235, 2), ["k"], path)
    after = files_of(spark, table)
    assert len(before - after) == len(after - before) == 1
    upsert_pruned(spark, table, numbers(spark, 5000, 5010, 3), ["k"], path)
    last = files_of(spark, table)
    assert after < last and len(last - after) == 1
    upsert_pruned(spark, table, numbers(spark, 5000, 5011, 3), ["k"], path, only_changed=["v"])
    assert last < files_of(spark, table)  # unchanged rows rewrite nothing
    got = {r["k"]: r["v"] for r in tables.load(spark, table).collect()}
    assert got == {**dict.fromkeys(range(3000), 1), 1234: 2, **dict.fromkeys(range(5000, 5011), 3)}


def test_old_versions_of_a_sliced_table(spark, sliced):
    import os

    table, path = sliced
    upsert_pruned(spark, table, numbers(spark, 0, 3000, 2), ["k"], path)
    versions = [f for f in os.listdir(path) if f.startswith("version-")]
    tables.drop_old_versions(spark, table, path)
    assert len(versions) == 2 and len([f for f in os.listdir(path) if f.startswith("version-")]) == 1
    assert tables.load(spark, table).where("v = 2").count() == 3000


def test_small_slices_are_put_together(spark, sliced):
    table, path = sliced
    for i in range(4):
        upsert_pruned(spark, table, numbers(spark, 4000 + i, 4001 + i), ["k"], path)
    before = slices.names(spark, table)
    slices.compact(spark, table, path, ["k"], small=10)
    assert len(slices.names(spark, table)) == len(before) - 3
    upsert_pruned(spark, table, numbers(spark, 4000, 4008, 7), ["k"], path)
    assert sorted(r[0] for r in tables.load(spark, table).where("v = 7").select("k").collect()) == list(range(4000, 4008))
    assert tables.load(spark, table).count() == 3008


def test_filters_tell_slices_of_one_range_apart(spark, table, tmp_path):
    """Loads whose ranges overlap entirely: the filters alone decide."""
    path = str(tmp_path / "t")
    for part in range(6):
        rows = spark.range(3000).where(f"id % 6 = {part}").selectExpr("cast(id as string) id", "cast(id as int) k", "1 v")
        upsert_pruned(spark, table, rows, ["id", "k"], path)
    before = files_of(spark, table)
    key = slices.in_parts(slices.materialise(numbers(spark, 601, 602), "key"), ["id", "k"])
    assert len(slices.holding(spark, table, path, key, ["id", "k"])) <= 2
    upsert_pruned(spark, table, numbers(spark, 601, 602, 9), ["id", "k"], path)
    assert len(before - files_of(spark, table)) == 1
    assert rows_of(spark, table)[601] == 9 and len(rows_of(spark, table)) == 3000


def rows_of(spark, table):
    return {r["k"]: r["v"] for r in tables.load(spark, table).collect()}


def test_an_interrupted_load_leaves_nothing_behind(spark, sliced, monkeypatch):
    table, path = sliced
    expected = rows_of(spark, table)

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(slices, "publish", dies)
        with pytest.raises(RuntimeError):
            upsert_pruned(spark, table, numbers(spark, 6000, 6100), ["k"], path)
    assert rows_of(spark, table) == expected
    upsert_pruned(spark, table, numbers(spark, 6000, 6100), ["k"], path)
    assert rows_of(spark, table) == {**expected, **dict.fromkeys(range(6000, 6100), 1)}


@pytest.mark.parametrize("limits", [{}, {"only_changed": ["v"]}, {"sequence": ["v"]}])
def test_a_load_as_large_as_the_slices_in_its_range_is_shuffled_once(spark, sliced, monkeypatch, limits):
    table, path = sliced
    upsert_pruned(spark, table, numbers(spark, 9000, 9010), ["k"], path)
    before, versions = files_of(spark, table), []
    write = slices.write
    monkeypatch.setattr(slices, "write", lambda rows, *a, **k: versions.append(rows) or write(rows, *a, **k))
    monkeypatch.setattr(slices, "holding", lambda *_: pytest.fail("the filters are asked"))
    # older than what is there, the same, and newer or new
    load = numbers(spark, 0, 1000, 0).unionAll(numbers(spark, 1000, 2000)).unionAll(numbers(spark, 2000, 5000, 2))
    expected = rows_of(spark, table) | dict.fromkeys(range(2000, 5000), 2) | ({} if "sequence" in limits else dict.fromkeys(range(1000), 0))
    upsert_pruned(spark, table, load, ["k"], path, part_bytes=2000, **limits)
    assert rows_of(spark, table) == expected and tables.load(spark, table).count() == 5010
    assert len(versions) == 1
    plan = versions[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning") == 1
    same_files = before & files_of(spark, table)
    assert len(same_files) == (1 if not limits else len(same_files)) and same_files  # that of 9000 and more
    assert "only_changed" not in limits or len(same_files) > 1
    monkeypatch.undo()
    # the record of the new slices is as good as that of the old ones
    upsert_pruned(spark, table, numbers(spark, 4321, 4322, 7), ["k"], path)
    assert rows_of(spark, table) == expected | {4321: 7}


def test_a_large_load_leaves_slices_without_changes(spark, sliced):
    table, path = sliced
    before = files_of(spark, table)
    upsert_pruned(spark, table, numbers(spark, 0, 3000), ["k"], path, part_bytes=2000, only_changed=["v"])
    assert files_of(spark, table) == before
    upsert_pruned(spark, table, numbers(spark, 0, 3000, 2), ["k"], path, part_bytes=2000, only_changed=["v"])
    assert not files_of(spark, table) & before


NAMES = "`a.b` string, `_row` int, known int, `s0` int, written int, _part2 int, `x``y` int"


def test_any_column_names(spark, table, tmp_path):
    old = spark.createDataFrame([("a", None, 1, 1, 1, 1, 1), ("b", 2, 1, 1, 1, 1, 1)], NAMES)
    new = spark.createDataFrame([("a", None, 2, 3, 4, 5, 6), ("c", 2, 2, 3, 4, 5, 6)], NAMES)
    expected = [("a", None, 2, 3, 4, 5, 6), ("b", 2, 1, 1, 1, 1, 1), ("c", 2, 2, 3, 4, 5, 6)]
    for small in (False, True):
        got = merge_rows(old, new, ["a.b", "_row"], sequence=["known"], small_source=small)
        assert sorted(map(tuple, got.collect()), key=repr) == expected and got.columns == old.columns
    for load in (old, new, new):
        upsert_pruned(spark, table, load, ["a.b", "_row"], str(tmp_path / "t"), sequence=["x`y"])
    assert sorted(map(tuple, tables.load(spark, table).collect()), key=repr) == expected


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(st.one_of(st.none(), st.integers(0, 40)), st.integers(0, 5)), min_size=1, max_size=4))
def test_pruned_upserts_are_dictionary_updates(spark, tmp_path_factory, loads):
    path, name = str(tmp_path_factory.mktemp("p") / "t"), f"testing.p{uuid.uuid4().hex}"
    spark.sql("CREATE SCHEMA IF NOT EXISTS testing")
    expected = {}
    for load in loads:
        rows = spark.createDataFrame(list(load.items()), "k bigint, v bigint")
        upsert_pruned(spark, name, rows, ["k"], path, part_bytes=300)
        expected.update(load)
    assert rows_of(spark, name) == expected


# ---------------------------------------------------------------- merges into buckets


@pytest.mark.parametrize("limits", [{}, {"only_changed": ["v"]}, {"sequence": ["k"]}])
def test_a_bucketed_merge_shuffles_once_and_equals_the_join(spark, capsys, limits):
    from lodestar.operators.merge import _merged_in_buckets

    old = frame(spark, [("a", 1, 1), ("b", 2, 2), (None, 3, 3), ("d", 4, 4)])
    new = frame(spark, [("a", 1, 1), ("b", 1, 20), (None, 3, 30), ("e", None, 5)])
    merged = _merged_in_buckets(old, new, (3, ["id"]), ["id"], limits.get("only_changed", ()), limits.get("sequence", ()))
    assert rows(merged.drop(tables.BUCKET)) == rows(merge_rows(old, new, ["id"], **limits))
    assert merged.where(tables.bucket_of(3, ["id"]) != merged[tables.BUCKET]).isEmpty()
    merged.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1


def test_a_large_load_into_buckets(spark, table, tmp_path):
    path, setting = str(tmp_path / "t"), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, -1)
    try:
        for load in (numbers(spark, 0, 500), numbers(spark, 400, 900, 2), numbers(spark, 400, 900, 2)):
            upsert(spark, table, load, ["id"], path, buckets=5)
        with pytest.raises(ValueError, match="repeats the key"):
            upsert(spark, table, numbers(spark, 0, 5).unionAll(numbers(spark, 4, 5, 7)), ["id"], path)
    finally:
        spark.conf.set(setting, before)
    assert rows_of(spark, table) == {**dict.fromkeys(range(400), 1), **dict.fromkeys(range(400, 900), 2)}


@pytest.mark.parametrize("buckets", [None, 4])
def test_many_rows_that_are_short_on_disk_are_not_broadcast(spark, table, tmp_path, monkeypatch, buckets):
    path, setting, merged = str(tmp_path / "t"), "spark.sql.autoBroadcastJoinThreshold", []
    load = spark.range(0, 40_000, 1, 2).selectExpr("id", "1L v", "1L w")
    upsert(spark, table, load.where("id < 100"), ["id"], path, buckets=buckets)
    replace, before = tables.replace, spark.conf.get(setting)
    monkeypatch.setattr(tables, "replace", lambda df, *a, **k: merged.append(df) or replace(df, *a, **k))
    spark.conf.set(setting, "400k")
    try:
        assert stored_bytes(materialise(load, "test")) < 400 << 10  # and four words a row in memory
        for part in (load, load.where("id < 10")):
            upsert(spark, table, part, ["id"], path)
            plan = merged[-1]._jdf.queryExecution().executedPlan().toString()
            assert ("Broadcast" in plan) == (part is not load)
    finally:
        spark.conf.set(setting, before)
    assert tables.load(spark, table).count() == 40_000


def test_rows_are_measured_as_they_are_in_memory(spark):
    texts = materialise(spark.range(0, 100, 1, 1).select(F.lit("x" * 1000).alias("a.b"), F.array("id").alias("c")), "test")
    assert stored_bytes(texts) < 10_000 and not fits_in(texts, 100_000) and fits_in(texts, 110_000)
    none = materialise(spark.createDataFrame([], "a string"), "test")
    assert fits_in(none, 10_000) and not fits_in(none, -1)


def test_filters_are_made_of_a_bounded_number_of_rows_a_task(spark, tmp_path, monkeypatch):
    tasks = []
    monkeypatch.setattr(slices, "ROWS_AT_ONCE", 100)
    rows = spark.range(1000).selectExpr("id k", "concat('s', id % 3) _slice")
    frame_class = type(rows)
    repartition = frame_class.repartition
    monkeypatch.setattr(frame_class, "repartition", lambda df, n, *by: tasks.append(n) or repartition(df, n, *by))
    slices.record(rows, str(tmp_path), ["k"])
    assert tasks == [10]
    kept = spark.read.parquet(f"{tmp_path}/keys")
    assert kept.count() == 3 and kept.where("bits IS NULL").isEmpty()
    assert kept.selectExpr("sum(bitmap_count(bits))").first()[0] > 3900  # four bits a key, of which few meet
