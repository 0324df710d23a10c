import random

from dimload.llm.components import connected_components


def test_random_graph(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)]
    edges += [(5000, 5001 + i) for i in range(500)] + [(7, 7), (1000, 1001)]
    group = {n: n for e in edges for n in e}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in edges:
        ra, rb = root(a), root(b)
        group[max(ra, rb)] = min(ra, rb)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((n, root(n)) for n in linked)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
