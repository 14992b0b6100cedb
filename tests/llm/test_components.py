import random

from tidewatch.llm.components import components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in parent)


def test_components_match_union_find(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(-5, 60)]
    hub = [(1000, 1000 + i) for i in range(1, 80)]
    noise = [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(90)]
    edges = chain + hub + noise + [(7, 7), (None, 3), (4, None), (1, 0), (1, 0)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert sorted(map(tuple, got.collect())) == brute(edges)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
