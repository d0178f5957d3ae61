import pytest
from pyspark.sql import functions as F

from textloom.llm import related
from textloom.operators import forest


@pytest.mark.parametrize("hot", [2, 10_000])
def test_stars(spark, hot):
    pairs = [(f"m{i}", f"k{i % 3}") for i in range(12)] + [("m1", None), (None, "k1"), ("m0", "k1")]
    edges = related.star_edges(spark.createDataFrame(pairs, "member string, key string"), hot, 4)
    members, _ = forest.spanning_forest(edges)
    got = {}
    for x in members.filter("node LIKE 'm%'").collect():
        got.setdefault(x.root, set()).add(x.node)
    assert {frozenset(v) for v in got.values()} == {frozenset(f"m{i}" for i in range(12) if i % 3 != 2), frozenset(f"m{i}" for i in range(12) if i % 3 == 2)}


@pytest.mark.parametrize("hot", [1, 10_000])
def test_continuations(spark, hot):
    ids = ["conv_1", "conv_12", "conv_1/2", "conv_1/2~3", "conv_12_b", "conv_9.x", "ä-1", "ä"]
    got = {(r.u, r.v) for r in related.continuation_edges(spark.createDataFrame([(i,) for i in ids], "id string"), hot).collect()}
    assert got >= {("conv_1/2", "conv_1"), ("conv_1/2~3", "conv_1/2"), ("conv_12_b", "conv_12"), ("ä-1", "ä")}
    assert got <= {("conv_1/2", "conv_1"), ("conv_1/2~3", "conv_1/2"), ("conv_1/2~3", "conv_1"), ("conv_12_b", "conv_12"), ("ä-1", "ä")}


def test_names_in_any_case(spark):
    ids = spark.createDataFrame([("a",), ("A",), ("b",)], "id string")
    got = {(r.u, r.v) for r in related.named_edges(spark.createDataFrame([("x", "A"), ("y", "B"), ("z", "none"), ("w", None), ("w", "")], "id string, other string"), ids).collect()}
    assert got == {("x", "A"), ("y", "b"), ("z", "none")}


def test_dealing(spark):
    g = spark.createDataFrame([(f"r{i}", 1 if i < 3000 else 2 + i % 7) for i in range(4000)], "root string, size long")
    dealt = related.deal_splits(g, {"train": 0.8, "validation": 0.1, "test": 0.1}, per_bucket=500)
    assert dealt.count() == 4000
    got = {r.split: r.n for r in dealt.join(g, "root").groupBy("split").agg(F.sum("size").alias("n")).collect()}
    total = sum(got.values())
    assert got["train"] / total == pytest.approx(0.8, abs=0.01) and got["test"] / total == pytest.approx(0.1, abs=0.01)
    assert {(r.root, r.split) for r in dealt.collect()} == {(r.root, r.split) for r in related.deal_splits(g.repartition(7), {"train": 0.8, "validation": 0.1, "test": 0.1}, per_bucket=500).collect()}


def test_related_conversations(spark):
    m = spark.createDataFrame([(" c1 ", "acct-1"), ("c2", "ACCT_1"), ("c3", "guest"), ("c4", None), (None, "acct-1"), ("c5", "acct-2")], "conversation_id string, account_id string")
    t = spark.createDataFrame([("c3", "C4"), ("c5/2", None), ("c6", None), ("c6", None), ("c7", "missing"), ("c8", "missing")], "conversation_id string, parent_id string")
    got = {}
    groups, tree = related.related_conversations(m, t)
    for r in groups.collect():
        got.setdefault(r.root, set()).add(r.conversation_id)
    assert sorted(map(sorted, got.values())) == [["c1", "c2"], ["c3", "c4"], ["c5", "c5/2"], ["c6"], ["c7", "c8"]]
    edges = [(r.u, r.v) for r in tree.collect()]
    nodes = {x for e in edges for x in e}
    # a forest: as many edges as nodes less trees; c1 and c2 hang on their account, c7 and c8 on a parent that is nowhere
    assert len(edges) == len(nodes) - 4 and {"c1", "c2", "c3", "C4".lower(), "c5", "c5/2", "c7", "c8", "missing"} <= nodes


@pytest.mark.parametrize("sizes", [[70_000] + [1] * 5000, [300] + [1] * 600, [150] + [1] * 300, [40, 30, 20, 10], [1] * 10, [], [5]])
def test_one_large_group(spark, sizes):
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    g = spark.createDataFrame([(f"r{i}", n) for i, n in enumerate(sizes)], "root string, size long")
    got = dict.fromkeys(shares, 0)
    for r in related.deal_splits(g, shares).join(g, "root").collect():
        got[r.split] += r.size
    total = sum(sizes)
    assert sum(got.values()) == total
    for k, f in shares.items():
        assert abs(got[k] - f * total) <= max(0.01 * total, max(sizes, default=0))
