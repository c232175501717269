import random
from collections import Counter

import pytest

from lodestar.operators import counts
from lodestar.operators.counts import KEYS, read_counts, update_counts
from lodestar.sources import slices

DDL = "`k.1` int, `g.2` string, seen int"


def load(spark, table, path, rows, batch, **options):
    frame = spark.createDataFrame(rows, DDL).repartition(2)
    update_counts(spark, table, path, frame, key="k.1", group="g.2", latest=["seen"], batch_id=batch, **options)


def listed(spark, table):
    return {r["g.2"]: r["total"] for r in read_counts(spark, table).collect()}


def test_counts_follow_every_load(spark, table, tmp_path):
    rnd, path, groups = random.Random(1), str(tmp_path / "t"), {}
    for batch in range(4):
        rows = [(rnd.choice([None, *range(60)]), rnd.choice(["a", "b", None, f"only{batch}"]), i) for i in range(50)]
        for _ in range(2):  # each load comes twice
            load(spark, table, path, rows, batch, part_bytes=300)
        groups.update({k: g for k, g, _ in rows if k is not None})
        assert listed(spark, table) == dict(Counter(groups.values()))


def test_a_load_that_dies_is_finished_by_its_replay(spark, table, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    load(spark, table, path, [(1, "a", 1), (2, "a", 1)], 0)

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(counts, "upsert_pruned", dies)
        with pytest.raises(RuntimeError):
            load(spark, table, path, [(2, "b", 2), (3, "b", 2)], 1)
    for _ in range(2):
        load(spark, table, path, [(2, "b", 2), (3, "b", 2)], 1)
    assert listed(spark, table) == {"a": 1, "b": 2}
    load(spark, table, path, [(1, "b", 3)], 2)
    assert listed(spark, table) == {"b": 3}


def test_only_slices_with_keys_are_read(spark, table, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    load(spark, table, path, [(i, f"g{i % 5}", 1) for i in range(4000)], 0, part_bytes=3000)
    read, real = [], slices.load
    monkeypatch.setattr(slices, "load", lambda s, n, only=None: read.append(only) or real(s, n, only))
    load(spark, table, path, [(1234, "g0", 2)], 1)
    total = len(slices.names(spark, f"{table}{KEYS}"))
    assert total > 5 and all(only is None or len(only) <= 1 for only in read)
    assert listed(spark, table) == {"g0": 801, "g1": 800, "g2": 800, "g3": 800, "g4": 799}


def test_empty_loads(spark, table, tmp_path):
    load(spark, table, str(tmp_path / "t"), [], 0)
    assert listed(spark, table) == {}
    load(spark, table, str(tmp_path / "t"), [(None, "a", 1), (1, None, 1)], 1)
    assert listed(spark, table) == {None: 1}
