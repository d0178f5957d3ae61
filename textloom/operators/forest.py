"""Connected groups by minimum-edge contraction, with the spanning forest it leaves behind.

Every round each component picks its least edge (weights are hashes of the edge, so the order is total and two
components that pick each other picked the same edge), the picks are hooked together, and the edges between the new
components go into the next round. Rounds are written to the shared folder: a lost executor costs one round, not the run.
Components at least halve each round, and nothing but counts reaches the driver. Once no more than SMALL edges are left
they are contracted in one task, in the order of their weights, which gives the same forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize, release, ship

SMALL = 100_000  # edges that one task contracts, about 20 MB


def _contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (u, v, a, b) by rising weight to (kind, x, y): kind 0 a node and its root, kind 1 an edge a, b of the forest."""
    up: dict[str, str] = {}
    picked: list[tuple[str, str]] = []

    def top(x: str) -> str:
        path = []
        while (p := up.setdefault(x, x)) != x:
            path.append(x)
            x = p
        for y in path:
            up[y] = x
        return x

    for pdf in frames:
        for u, v, a, b in pdf[["u", "v", "a", "b"]].itertuples(index=False):
            x, y = top(u), top(v)
            if x != y:
                up[max(x, y)] = min(x, y)
                picked.append((a, b))
    rows = [(0, x, top(x)) for x in list(up)] + [(1, a, b) for a, b in picked]
    yield pd.DataFrame(rows, columns=["kind", "x", "y"]).astype({"kind": "int32"})


def _flatten(hooks: DataFrame) -> DataFrame:
    """(u, p) hooks without cycles except roots (u = p), shortened until every p is a root."""
    p, last = hooks, None
    while True:
        up = p.select(F.col("u").alias("p"), F.col("p").alias("q"))
        j = materialize(p.join(up, "p", "left").select("u", F.coalesce("q", "p").alias("p"), (F.coalesce("q", "p") != F.col("p")).alias("moved")), "jump")
        if last is not None:
            release(last)
        if not j.filter("moved").limit(1).count():
            return j.select("u", "p")
        p, last = j.select("u", "p"), j


def spanning_forest(edges: DataFrame, small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """(members: node, root) over the nodes of ``edges`` (u, v: strings), and (forest: u, v), the edges that hold them together.

    Loops, repeated edges and either direction are fine; an edge with a null end is ignored. ``root`` is a node of its group.
    """
    lo, hi = F.least("u", "v"), F.greatest("u", "v")
    e = edges.select("u", "v").dropna().filter("u <> v").select(lo.alias("a"), hi.alias("b")).distinct()
    e = materialize(e.select(F.col("a").alias("u"), F.col("b").alias("v"), F.struct(F.xxhash64("a", "b").alias("h"), "a", "b").alias("w")), "edges")
    parents: list[DataFrame] = []
    picked: list[DataFrame] = []
    picks: list[DataFrame] = []
    while n := e.count():
        if n <= small:
            ship(edges.sparkSession)
            order = e.select("u", "v", "w.*").repartition(1).sortWithinPartitions("h", "a", "b").select("u", "v", "a", "b")
            last = materialize(order.mapInPandas(_contract, "kind int, x string, y string"), "rest")
            parents.append(last.filter("kind = 0").select(F.col("x").alias("u"), F.col("y").alias("p")))
            picked.append(last.filter("kind = 1").select(F.col("x").alias("a"), F.col("y").alias("b")))
            break
        ends = e.select(F.explode(F.array(F.struct("u", "v", "w"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"), "w"))).alias("x")).select("x.*")
        pick = materialize(ends.groupBy("u").agg(F.min(F.struct("w", "v")).alias("m")).select("u", "m.v", "m.w"), "pick")
        back = pick.select(F.col("u").alias("v"), F.col("w").alias("w2"))
        # of two components that picked the same edge the lesser one becomes the root
        hooks = pick.join(back, "v", "left").select("u", F.when((F.col("w") == F.col("w2")) & (F.col("u") < F.col("v")), F.col("u")).otherwise(F.col("v")).alias("p"))
        flat = _flatten(hooks)
        parents.append(flat)
        picked.append(pick.select("w.a", "w.b"))
        picks.append(pick)
        pu, pv = flat.select("u", F.col("p").alias("pu")), flat.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        nxt = e.join(pu, "u").join(pv, "v").filter("pu <> pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"), "w")
        last, e = e, materialize(nxt.groupBy("u", "v").agg(F.min("w").alias("w")), "edges")
        release(last)
    if not parents:
        none = edges.sparkSession.createDataFrame([], "u string, p string")
        return none.toDF("node", "root"), none.toDF("u", "v")
    # composed from the last, smallest round backwards
    members = parents[-1]
    for level in reversed(parents[:-1]):
        up = members.select(F.col("u").alias("p"), F.col("p").alias("q"))
        members = level.join(up, "p", "left").select("u", F.coalesce("q", "p").alias("p"))
    forest = materialize(reduce(DataFrame.unionByName, picked).distinct(), "forest")
    for pick in picks:
        release(pick)
    return members.toDF("node", "root"), forest.toDF("u", "v")
