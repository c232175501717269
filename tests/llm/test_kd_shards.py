import zlib

import pytest

from lodestar.llm import kd_shards


def check(got, rows, shards, slack):
    got = got.toPandas()
    sizes = sorted((len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted(zip(got["size"], got.text_crc32)) == sizes
    assert set(got.shard) <= set(range(shards))
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    held = got.groupby("shard")["size"].sum()
    mean = sum(s for s, _ in sizes) / shards
    assert (abs(held - mean) <= slack).all() and len(held) == shards


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_bytes_are_even(spark, shards):
    rows = [(i, "x" * (i * 37 % 400)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "length(text) AS n_chars", "cast(doc_id % 3 AS string) AS lang")
    check(kd_shards.kd_shards(docs, ["n_chars", "lang", "doc_id"], shards), rows, shards, 6 * 400)


def test_equal_values_and_repeated_rows_are_split(spark):
    rows = [(7, "same text")] * 900 + [(None, None)] * 60
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1.0 AS n_chars", "cast(NULL AS string) AS lang")
    check(kd_shards.kd_shards(docs, ["n_chars", "lang", "doc_id"], 8), rows, 8, 60)


def test_target_bytes(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "repeat('y', 99) AS text")
    got = kd_shards.kd_shards(docs, ["doc_id"], target_bytes=25_000)
    assert sorted(r[1] for r in got.groupBy("shard").count().collect()) == pytest.approx([250] * 4, abs=3)


def test_edge_documents(edge_docs, edge_rows, no_docs):
    got = kd_shards.kd_shards(edge_docs, ["n_chars", "lang", "source", "doc_id"], shards=2)
    assert got.count() == len(edge_rows) and set(r[0] for r in got.select("shard").distinct().collect()) == {0, 1}
    assert kd_shards.kd_shards(no_docs, ["n_chars", "lang"], shards=4).count() == 0


def test_split_follows_the_widest_dimension(spark):
    """Leaves of a plane are boxes: two points of different leaves are told apart by one split."""
    docs = spark.range(4096).selectExpr("id AS doc_id", "'t' AS text", "id % 64 AS x", "id div 64 AS y")
    got = kd_shards.kd_shards(docs, ["x", "y"], shards=4).toPandas()
    boxes = [(p.doc_id % 64, p.doc_id // 64) for _, p in got.groupby("shard")]
    assert all(len(x) == 1024 and x.max() - x.min() <= 32 and y.max() - y.min() <= 32 for x, y in boxes)


def brute_force(points, weights, shards):
    """The boxes of a K-d tree whose splits are the weighted medians along the widest dimension."""
    whole = [max(p[i] for p in points) - min(p[i] for p in points) for i in range(len(points[0]))]

    def split(members, count):
        if count < 2:
            return [sorted(members)]
        spans = [max(points[m][i] for m in members) - min(points[m][i] for m in members) for i in range(len(whole))]
        widest = max(range(len(whole)), key=lambda i: spans[i] / (whole[i] or 1e-9))
        wanted = sum(weights[m] for m in members) * (count // 2) // count
        below, left = 0, []
        values = sorted({points[m][widest] for m in members})
        for v in values:
            held = sum(weights[m] for m in members if points[m][widest] == v)
            if below + held > wanted and (below + held - wanted > wanted - below):
                break
            left += [m for m in members if points[m][widest] == v]
            below += held
        right = [m for m in members if m not in set(left)]
        return split(left, count // 2) + split(right, count - count // 2)

    return split(list(range(len(points))), shards)


@pytest.mark.parametrize("seed", range(2))
def test_leaves_are_those_of_a_plain_tree(spark, seed, monkeypatch):
    """Distinct values, some of them far away, so that every median is a value."""
    import random

    monkeypatch.setattr(kd_shards, "TOLERANCE", 0.0)
    rnd = random.Random(seed)
    n = 300
    points = [(rnd.random() * 10 ** rnd.choice([0, 1, 2, 9]), rnd.gauss(0, 1) ** 3) for _ in range(n)]
    sizes = [rnd.randrange(1, 90) for _ in range(n)]
    rows = [(i, "x" * (sizes[i] - 1), *points[i]) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, x double, y double").repartition(3)
    got = kd_shards.kd_shards(docs, ["x", "y"], 5).toPandas()
    leaves = sorted(sorted(p.doc_id.tolist()) for _, p in got.groupby("shard"))
    assert leaves == sorted(brute_force(points, sizes, 5))


def test_an_outlier_does_not_hide_the_values(spark):
    docs = spark.range(4096).selectExpr("id AS doc_id", "'t' AS text", "cast(if(id = 4095, 1e12, id) AS double) AS x")
    got = kd_shards.kd_shards(docs, ["x"], 2).toPandas()
    sides = sorted((p.doc_id.min(), p.doc_id.max()) for _, p in got.groupby("shard"))
    assert sides == [(0, 2047), (2048, 4095)]


def test_values_that_are_not_finite(spark):
    odd = ["double('nan')", "double('infinity')", "double('-infinity')", "cast(NULL AS double)", "1.7e308D", "-1.7e308D"]
    docs = spark.range(600).selectExpr("id AS doc_id", "'t' AS text", f"element_at(array({', '.join(odd)}), cast(id % 6 + 1 AS int)) AS x")
    got = kd_shards.kd_shards(docs, ["x"], 6).toPandas()
    assert sorted(got.groupby("shard").size()) == [100] * 6
    for _, part in got.groupby("shard"):
        assert part.doc_id.mod(6).nunique() == 1 or set(part.doc_id.mod(6)) == {0, 3}
