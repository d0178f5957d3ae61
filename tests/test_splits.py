import hashlib
import random

import pytest

from textloom.operators import splits

SHARES = (0.8, 0.1, 0.1)


def h(text, seed=0, kind=hashlib.sha1):
    return kind(f"{seed}\0{text}".encode()).hexdigest()


def groups(rows):
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for q, p in rows:
        parent[top("q:" + q)] = top("p:" + p)
    sets = {}
    for x in list(parent):
        sets.setdefault(top(x), set()).add(x)
    return {i: h(min(sets[top("q:" + q)]))[:20] for i, (q, p) in enumerate(rows)}


def prepared(spark, rows):
    return spark.createDataFrame([(i, q, p) for i, (q, p) in enumerate(rows)], "_row long, query_norm string, positive_norm string")


@pytest.fixture(scope="module")
def random_rows():
    r = random.Random(5)
    return [(f"q{r.randrange(60)}", f"p{r.randrange(70)}") for _ in range(90)] + [("same", "same"), ("p1", "q1")]


def test_components(spark, random_rows):
    got = {r._row: r.component for r in splits.components(prepared(spark, random_rows)).collect()}
    assert got == groups(random_rows)


def test_replayed_components_group_alike(spark, random_rows):
    got = {r._row: r.component for r in splits.components(prepared(spark, random_rows), "replay").collect()}
    want = groups(random_rows)
    assert len({(got[i], want[i]) for i in want}) == len(set(got.values())) == len(set(want.values()))
    three = splits.components(prepared(spark, [("a", "x"), ("b", "y"), ("b", "x")]), "replay").first()
    assert three.component == h("q:b")[:20]  # the last union has two groups of two and keeps the left root


def test_greedy_split(spark, random_rows):
    g = splits.components(prepared(spark, random_rows))
    size = {}
    for c in groups(random_rows).values():
        size[c] = size.get(c, 0) + 1
    n, have, want = sum(size.values()), [0, 0, 0], {}
    for c in sorted(size, key=lambda c: h(c, 42)):
        k = max(range(3), key=lambda i: ((n * SHARES[i] - have[i]) / max(n * SHARES[i], 1), -i))
        have[k] += size[c]
        want[c] = splits.NAMES[k]
    assert {r.component: r.split for r in splits.greedy_split(g).collect()} == want
    joined = g.join(splits.greedy_split(g).select("component", "split"), "component")
    assert {r.shared for r in splits.isolation(joined).collect()} == {0}
    with pytest.raises(ValueError):
        splits.greedy_split(g, fractions=(0.5, 0.1, 0.1))


def test_isolation_counts(spark):
    df = spark.createDataFrame([("train", "a"), ("test", "a"), ("train", "b"), ("validation", "b"), ("test", "b"), ("train", None), ("test", None)], "split string, v string")
    assert {(r.split_a, r.split_b): r.shared for r in splits.isolation(df, ("v",)).collect()} == {("train", "validation"): 1, ("train", "test"): 2, ("validation", "test"): 1}


def test_cap(spark):
    rows = spark.createDataFrame([(f"c{i}",) for i in range(30) for _ in range(i % 4 + 1)], "component string")
    order = sorted(range(30), key=lambda i: h(f"c{i}", 42))
    want, total = set(), 0
    for i in order:
        if total < 20:
            want.add(f"c{i}")
        total += i % 4 + 1
    assert {r.component for r in splits.cap_components(rows, 20).collect()} == want
    assert splits.cap_components(rows, 1000).count() == 30


@pytest.mark.parametrize("n", [3, 4, 10, 25])
def test_ordered_split(spark, n):
    df = spark.createDataFrame([(f"k{i}",) for i in range(n)], "k string")
    got = {r.k: (r.position, r.split) for r in splits.ordered_split(df, "k").collect()}
    order = sorted((f"k{i}" for i in range(n)), key=lambda k: h(k, 42, hashlib.sha256))
    tr, va = max(1, round(n * 0.8)), max(1, round(n * 0.1))
    if tr + va >= n:
        tr, va = max(1, n - 2), 1
    assert got == {k: (i + 1, "train" if i < tr else "validation" if i < tr + va else "test") for i, k in enumerate(order)}


def test_ordered_split_needs_three(spark):
    with pytest.raises(Exception, match="three"):
        splits.ordered_split(spark.createDataFrame([("a",), ("b",)], "k string"), "k").collect()
    assert splits.ordered_split(spark.createDataFrame([], "k string"), "k").count() == 0


def test_isolation_is_required(spark):
    rows = spark.createDataFrame([("train", "a"), ("test", "b"), ("test", "b")], "split string, conversation_id string")
    assert splits.require_isolated(rows).count() == 3
    with pytest.raises(ValueError, match="1 of conversation_id by train and test"):
        splits.require_isolated(rows.union(spark.createDataFrame([("train", "b")], rows.schema)))
