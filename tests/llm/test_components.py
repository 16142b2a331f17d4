"""Components of random graphs, long paths and stars against union-find."""

import random

from pairlab.llm.components import components


def test_against_union_find(spark):
    r = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(300)]
    links += [(r.randrange(500, 700), r.randrange(500, 700)) for _ in range(120)] + [(7, 7), (None, 3), (9, None), (40, 39)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    got = {n.node: n.root for n in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
