import random

import pytest

from quern.llm import components as C


@pytest.mark.parametrize("links", [50_000, 7])
def test_equals_union_find(spark, monkeypatch, links):
    monkeypatch.setattr(C, "LINKS", links)
    rng = random.Random(3)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5)]
    top = {x: x for p in pairs for x in p}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = {r.node: r.component for r in C.components(spark.createDataFrame(pairs, "a long, b long").repartition(4)).collect()}
    assert got == {x: find(x) for x in linked}


def test_no_links(spark):
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0
