from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from lodestar.operators import dedup_latest, rank_within, top_within

NAMES = {"row_number": "rn", "rank": "rk", "dense_rank": "dr"}


def brute_rankings(data):
    """data: (group, value, id); value descending with NULL last, id breaks ties."""
    out = []
    for g in {d[0] for d in data}:
        group = sorted(
            (d for d in data if d[0] == g), key=lambda d: (d[1] is None, -(d[1] or 0), d[2])
        )
        values = []
        for i, d in enumerate(group):
            if not values or values[-1] != d[1]:
                values.append(d[1])
                first = i + 1
            out.append((*d, i + 1, first, len(values)))
    return sorted(out, key=lambda t: [(v is not None, v) for v in t])


def test_fixture(spark):
    df = spark.createDataFrame([(2024, 50, "O1"), (2024, 50, "O2"), (2024, 40, "O3")], "year int, amount int, id string")
    out = rank_within(df, ["year"], "amount", ["id"], **NAMES)
    assert rows(out, "id", "rn", "rk", "dr") == [("O1", 1, 1, 1), ("O2", 2, 1, 1), ("O3", 3, 3, 2)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.sampled_from([5, 5, 5, 7, 8, None])), min_size=1, max_size=60))
def test_split_groups_rank_like_whole_ones(spark, pairs):
    data = [(g, v, i) for i, (g, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "g int, v int, id int")
    expected = brute_rankings(data)
    assert rows(rank_within(df, ["g"], "v", ["id"], max_group_rows=0, **NAMES)) == expected
    assert rows(rank_within(df, ["g"], "v", ["id"], **NAMES)) == expected


def test_split_on_one_hot_value(spark):
    df = spark.range(3000).select(
        F.lit(1).alias("g"), F.when(F.col("id") < 2500, 7).otherwise(F.col("id") % 5).cast("int").alias("v"), "id"
    )
    split = rank_within(df, ["g"], "v", ["id"], max_group_rows=100, **NAMES)
    whole = rank_within(df, ["g"], "v", ["id"], **NAMES)
    assert rows(split) == rows(whole)


def test_split_without_a_unique_tie_break(spark):
    """Equal rows may take any order, but numbers neither repeat nor go missing."""
    data = [(i % 2, i % 3) for i in range(400)]
    df = spark.createDataFrame(data, "g int, v int")
    out = rows(rank_within(df, ["g"], "v", ["v"], max_group_rows=0, **NAMES), "g", "rn", "v", "rk", "dr")
    expected = brute_rankings([(g, v, i) for i, (g, v) in enumerate(data)])
    assert out == sorted((g, rn, v, rk, dr) for g, v, _, rn, rk, dr in expected)


def test_whole_groups_need_one_shuffle(spark, sf, capsys):
    orders = spark.read.parquet(f"{sf}/orders.parquet").withColumn("year", F.year("o_orderdate"))
    rank_within(orders, ["year"], "o_totalprice", ["o_orderkey"], **NAMES).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_top_is_limited_before_the_shuffle(spark, sf, capsys):
    orders = spark.read.parquet(f"{sf}/orders.parquet").withColumn("year", F.year("o_orderdate"))
    top = top_within(orders, ["year"], "o_totalprice", ["o_orderkey"], 3)
    top.explain()
    assert "Partial" in capsys.readouterr().out
    assert top.count() == 3 * orders.select("year").distinct().count()


def test_dedup_keeps_the_latest(spark, capsys):
    df = spark.createDataFrame(
        [("C1", 1, "a"), ("C1", 2, "b"), ("C2", 1, "z"), ("C2", 1, "y"), (None, 1, "n"), (None, 3, "m")],
        "id string, t int, v string",
    )
    kept = dedup_latest(df, ["id"], ["t"])
    assert rows(kept) == [(None, 3, "m"), ("C1", 2, "b"), ("C2", 1, "z")]
    kept.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out
