from concurrent.futures import ThreadPoolExecutor

from lodestar.operators import key_blocks
from lodestar.operators.key_blocks import claim_blocks, keys_from_blocks


def test_loads_at_the_same_time_share_no_key(spark, tmp_path):
    path = str(tmp_path / "k")
    loads = {f"load{i}": spark.range(i * 1000, i * 1000 + 700).selectExpr("id", "7 AS task", "8 AS `block.x`").repartition(3) for i in range(4)}
    with ThreadPoolExecutor(4) as pool:
        keyed = dict(zip(loads, pool.map(lambda n: keys_from_blocks(loads[n], path, n, "s.k", block=100), loads)))
    rows = {n: {r["id"]: r["s.k"] for r in df.collect()} for n, df in keyed.items()}
    every = [k for keys in rows.values() for k in keys.values()]
    assert len(every) == len(set(every)) == 2800 and min(every) >= 1
    assert keyed["load0"].columns == ["id", "task", "block.x", "s.k"]
    # a load that is repeated gets the same keys, whatever rows it brings
    again = keys_from_blocks(loads["load2"], path, "load2", "s.k", block=100)
    assert {r["id"]: r["s.k"] for r in again.collect()} == rows["load2"]


def test_gaps_are_bounded_and_empty_loads_claim_nothing(spark, tmp_path):
    path = str(tmp_path / "k")
    got = keys_from_blocks(spark.range(1000).repartition(2), path, "a", block=300)
    assert max(r["surrogate_key"] for r in got.collect()) <= 1000 + 2 * 300
    assert keys_from_blocks(spark.range(0), path, "b").count() == 0
    used = claim_blocks(spark, path, 2)
    assert claim_blocks(spark, path, 0) == [] and claim_blocks(spark, path, 1) == [used[-1] + 1]


def test_a_load_that_dies_leaves_a_gap(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "k")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(key_blocks, "rename_folder", dies)
        try:
            keys_from_blocks(spark.range(10), path, "a", block=50)
        except RuntimeError:
            pass
    first = {r["surrogate_key"] for r in keys_from_blocks(spark.range(10), path, "a", block=50).collect()}
    second = {r["surrogate_key"] for r in keys_from_blocks(spark.range(10), path, "b", block=50).collect()}
    assert len(first) == len(second) == 10 and not first & second
