import random

from aeris.llm.components import connected_components


def brute(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_against_union_find(spark):
    rnd = random.Random(9)
    chain = [(i, i + 1) for i in range(1000, 1100)]
    star = [(-5, i) for i in range(2000, 2300)]
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)] + chain + star + star[:50] + [(b, a) for a, b in chain[:20]]
    want = brute([(a, b) for a, b in pairs if a != b])
    edges = spark.createDataFrame(pairs + [(None, 3), (4, None)], "a long, b long").repartition(4)
    rows = connected_components(edges).collect()
    assert len(rows) == len(want) and {r.node: r.component for r in rows} == want


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([(1, 1), (None, None)], "a long, b long")).count() == 0
