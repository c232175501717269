import random

import pytest

from lodestar.llm.components import connected


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rnd = random.Random(seed)
    links = [(i, i + 1) for i in range(40)] + [(rnd.randrange(100, 160), rnd.randrange(100, 160)) for _ in range(30)]
    links += [(500, i) for i in range(501, 520)] + [(i, 900) for i in range(880, 900)] + [(7, 7)]
    rnd.shuffle(links)
    parent = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = connected(spark.createDataFrame(links, "a bigint, b bigint"))
    assert sorted(map(tuple, got.select("node", "root").collect())) == sorted((n, find(n)) for n in nodes)


def test_no_links(spark):
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
