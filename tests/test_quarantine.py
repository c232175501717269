import pytest

from lodestar.operators import quarantine
from lodestar.operators.quarantine import deal, kept, quarantined, replay, rule_names

RULES = {"has id": "id IS NOT NULL", "positive": "`v.x` > 0", "short": "length(name) < 4"}
DDL = "id int, `v.x` int, name string"
DATA = [(1, 5, "abc"), (None, 5, "abc"), (2, -1, "long name"), (3, None, "x"), (None, None, None), (4, 1, "y")]


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_every_row_is_in_one_place(spark, tmp_path):
    path, rows = str(tmp_path / "q"), spark.createDataFrame(DATA, DDL)
    for _ in range(2):  # a batch that is repeated replaces itself
        deal(rows, RULES, path, 0)
    good, bad = kept(spark, path, rows.schema), quarantined(spark, path, rows.schema)
    assert good.columns == rows.columns
    masks = {(r["id"], r["v.x"], r["name"]): r["_failed"] for r in bad.collect()}
    assert masks == {(None, 5, "abc"): 1, (2, -1, "long name"): 6, (3, None, "x"): 2, (None, None, None): 7}
    assert listed(good, *("`v.x`", "name")) == [(1, "y"), (5, "abc")]
    names = {r["id"]: r["names"] for r in bad.where("id IS NOT NULL").withColumn("names", rule_names(RULES)).collect()}
    assert names == {2: ["positive", "short"], 3: ["positive"]}


def test_corrected_rows_take_the_place_of_theirs(spark, tmp_path):
    path, rows = str(tmp_path / "q"), spark.createDataFrame(DATA, DDL)
    deal(rows, RULES, path, 0)
    held = quarantined(spark, path, rows.schema)
    replay(held.where("id = 3").withColumn("v.x", held["`v.x`"] * 0 + 1), RULES, path, 1)  # still NULL
    replay(held.where("id = 2").selectExpr("id", "abs(`v.x`) AS `v.x`", "'ok' AS name", "_failed", "_batch", "_row"), RULES, path, 2)
    left = quarantined(spark, path, rows.schema)
    assert sorted((r["_batch"], r["_failed"]) for r in left.collect()) == [(0, 1), (0, 7), (1, 2)]
    assert listed(kept(spark, path, rows.schema).where("id = 2"), "id", "`v.x`", "name") == [(2, 1, "ok")]
    assert left.count() + kept(spark, path, rows.schema).count() == len(DATA)


def test_edges(spark, tmp_path):
    rows = spark.createDataFrame([], DDL)
    assert kept(spark, str(tmp_path / "none"), rows.schema).count() == 0
    deal(rows, RULES, str(tmp_path / "q"), 0)
    assert quarantined(spark, str(tmp_path / "q"), rows.schema).count() == 0
    with pytest.raises(ValueError, match="columns"):
        deal(spark.sql("SELECT 1 AS _row"), {}, str(tmp_path / "q"), 1)
    with pytest.raises(ValueError, match="62"):
        quarantine.failed_rules({str(i): "true" for i in range(63)})
