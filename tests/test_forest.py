import random

import pytest

from textloom.operators import forest


def grouped(nodes, edges):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[top(a)] = top(b)
    out = {}
    for n in nodes:
        out.setdefault(top(n), set()).add(n)
    return {frozenset(v) for v in out.values()}


@pytest.mark.parametrize("small", [0, 12, forest.SMALL])
@pytest.mark.parametrize("n,m,seed", [(40, 25, 1), (40, 60, 2), (60, 59, 3)])
def test_groups_and_forest(spark, n, m, seed, small):
    r = random.Random(seed)
    edges = [(f"n{r.randrange(n)}", f"n{r.randrange(n)}") for _ in range(m)]
    if seed == 3:
        edges = [(f"n{i}", f"n{i + 1}") for i in range(n - 1)]  # one long chain
    df = spark.createDataFrame([*edges, *edges[:3], ("n0", "n0"), (None, "n1")], "u string, v string")
    members, tree = forest.spanning_forest(df, small)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    got = {}
    for x in members.collect():
        got.setdefault(x.root, set()).add(x.node)
    want = grouped(nodes, [e for e in edges if e[0] != e[1]])
    assert {frozenset(v) for v in got.values()} == want
    t = [(x.u, x.v) for x in tree.collect()]
    assert len(t) == len(nodes) - len(want) and grouped(nodes, t) == want


def test_no_edges(spark):
    members, tree = forest.spanning_forest(spark.createDataFrame([], "u string, v string"))
    assert members.count() == 0 and tree.count() == 0


def test_the_forest_is_the_same_either_way(spark):
    r = random.Random(7)
    df = spark.createDataFrame([(f"n{r.randrange(50)}", f"n{r.randrange(50)}") for _ in range(120)], "u string, v string")
    forests = [{tuple(sorted((e.u, e.v))) for e in forest.spanning_forest(df, small)[1].collect()} for small in (0, 30, forest.SMALL)]
    assert forests[0] == forests[1] == forests[2]
