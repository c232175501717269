import pytest
from pyspark.sql import types as T

from conftest import rows
from lodestar.sources.ingest import ingest_stream
from lodestar.sources.ledger import ingest_ledger
from lodestar.sources.widening import common_type, holds_all, widened


def kind(text):
    return T.StructType.fromDDL(f"x {text}")["x"].dataType


@pytest.mark.parametrize(
    "known, found, common",
    [
        ("int", "int", "int"), ("smallint", "int", "int"), ("int", "bigint", "bigint"), ("float", "double", "double"),
        ("int", "double", "double"), ("bigint", "double", None), ("float", "smallint", "double"), ("int", "string", None),
        ("int", "decimal(12,2)", "decimal(12,2)"), ("bigint", "decimal(12,2)", "decimal(22,2)"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,10)", None),
        ("date", "timestamp_ntz", "timestamp_ntz"), ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,double>", "map<string,double>"), ("map<int,int>", "map<bigint,int>", None),
        ("struct<a:int,b:string>", "struct<a:bigint,c:int>", "struct<a:bigint,b:string>"), ("array<int>", "int", None),
    ],
)
def test_common_types(spark, known, found, common):
    got = common_type(kind(known), kind(found))
    assert got == (kind(common) if common else None)
    if common and "struct" not in common:
        assert common_type(kind(found), kind(known)) == got and holds_all(kind(found), got) and holds_all(kind(known), got)


def test_widened_keeps_what_has_nothing_in_common(spark):
    known, found = (T.StructType.fromDDL(d) for d in ("a int, B smallint, c string", "A string, b bigint, d int"))
    assert widened(known, found).simpleString() == "struct<a:int,B:bigint,c:string>"


@pytest.mark.parametrize("ingest", [ingest_stream, ingest_ledger])
def test_schemas_grow_and_old_files_stay(spark, tmp_path, ingest):
    source, bronze, checkpoint = (str(tmp_path / p) for p in ("source", "bronze", "checkpoint"))
    loads = ["SELECT 1 id, 1S n, array(1) l", "SELECT 2L id, 70000 n, array(5000000000L) l", "SELECT 3S id, 2.5D n, array(1) l", "SELECT 4 id, 'x' n, array('y') l"]
    for sql in loads:
        spark.sql(sql).coalesce(1).write.mode("append").parquet(source)
        got = ingest(spark, source, bronze, checkpoint, widen=True)
    assert [got.schema[c].dataType.simpleString() for c in ("id", "n", "l")] == ["bigint", "double", "array<bigint>"]
    assert rows(got, "id", "n", "_rescued_data") == [
        (1, 1.0, None), (2, 70000.0, None), (3, 2.5, None), (4, None, '{"n":"x","l":["y"]}')
    ]
    assert rows(got.where("id < 4"), "id", "l") == [(1, [1]), (2, [5000000000]), (3, [1])]


def test_without_widening_only_narrower_values_fit(spark, tmp_path):
    source, bronze, checkpoint = (str(tmp_path / p) for p in ("source", "bronze", "checkpoint"))
    for sql in ("SELECT 1 id", "SELECT 2S id", "SELECT 3L id"):
        spark.sql(sql).coalesce(1).write.mode("append").parquet(source)
        got = ingest_stream(spark, source, bronze, checkpoint)
    assert rows(got, "id", "_rescued_data") == [(None, '{"id":3}'), (1, None), (2, None)]
