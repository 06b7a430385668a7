import random

from almacen.llm.common import components


def brute(edges):
    comp = {}

    def root(x):
        while comp.setdefault(x, x) != x:
            x = comp[x]
        return x

    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        comp[hi] = lo
    return sorted((x, root(x)) for x in comp)


def test_components_equal_brute_force(spark):
    rnd = random.Random(7)
    cases = [
        [], [(1, 2)], [(2, 1), (1, 2), (2, 3)],
        [(i, i + 1) for i in range(-5, 40)],  # a chain
        [(100, i) for i in range(60)],  # a hub that is the greatest
        [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)],
    ]
    for edges in cases:
        edges = [(a, b) for a, b in edges if a != b]
        got = components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert sorted(map(tuple, got)) == brute(edges)
