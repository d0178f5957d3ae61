"""Splits that keep related records together: groups by minimum-edge contraction, whose forest is kept, dealt by size band."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.forest import spanning_forest
from textloom.session import materialize, release, ship

DENSE = 2_000  # groups that a size band must have to be dealt by a fixed step


def star_edges(pairs: DataFrame, hot: int = 10_000, arms: int = 64) -> DataFrame:
    """Edges from (member, key) rows to one hub per key, instead of all pairs. Null members and keys relate nothing.

    A key with more than ``hot`` members gets ``arms`` hubs under one, so no node has all its edges. The hot keys meet the
    rows by a join that Spark plans by their size.
    """
    p = pairs.select("member", "key").dropna().distinct()
    big = p.groupBy("key").count().filter(F.col("count") > hot).select("key", F.lit(True).alias("big"))
    x = p.join(big, "key", "left")
    hub = F.concat(F.lit("\x01"), "key")
    arm = F.when(F.col("big"), F.concat(hub, F.lit("\x01"), F.pmod(F.xxhash64("member"), F.lit(arms)).cast("string")))
    x = x.select(F.col("member").alias("u"), F.coalesce(arm, hub).alias("v"), F.when(F.col("big"), hub).alias("up"))
    return x.select("u", "v").unionByName(x.filter("up IS NOT NULL").select(F.col("v").alias("u"), F.col("up").alias("v")).distinct())


def continuation_edges(ids: DataFrame, hot: int = 10_000) -> DataFrame:
    """Edges from each id to every other whole id that it continues: that id, then a marker that starts with neither letter nor digit.

    ``ids``: distinct column id. A beginning that more than ``hot`` ids share without being an id itself (a common prefix)
    is taken out before the join with the ids.
    """
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.length("id") - 1, F.lit(1))), lambda i: (i < F.length("id")) & F.col("id").substr(i + 1, F.lit(1)).rlike(r"[^\p{L}\p{N}]"))
    cut = ids.select("id", F.explode(F.transform(at, lambda i: F.col("id").substr(F.lit(1), i))).alias("base"))
    common = cut.groupBy("base").count().filter(F.col("count") > hot).select("base").join(ids.select(F.col("id").alias("base")), "base", "left_anti")
    return cut.join(common, "base", "left_anti").join(ids.select(F.col("id").alias("base")), "base").select(F.col("id").alias("u"), F.col("base").alias("v"))


def named_edges(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges (u, v) from (id, other) rows whose ``other`` names an id, in any case; the exactly equal id first.

    A name that is no id stays a node of its own, so that two rows naming it are still related.
    """
    p = pairs.select("id", "other").dropna().filter("other <> ''").distinct().withColumn("k", F.lower("other"))
    known = ids.select(F.col("id").alias("named"), F.lower("id").alias("k"))
    best = p.join(known, "k", "left").groupBy("id", "other").agg(F.min_by("named", F.struct(F.col("named") != F.col("other"), F.col("named"))).alias("named"))
    return best.select(F.col("id").alias("u"), F.coalesce("named", "other").alias("v"))


def _by_deficit(names: list[str], wanted: list[float]) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lack = list(wanted)
        for pdf in frames:
            out = []
            for n in pdf["size"]:
                k = max(range(len(lack)), key=lambda i: (lack[i], -i))
                lack[k] -= n
                out.append(names[k])
            yield pdf.assign(split=out)[["root", "size", "split"]]

    return run


def deal_splits(groups: DataFrame, fractions: dict[str, float], seed: int = 42, per_bucket: int = 5_000, dense: int = DENSE) -> DataFrame:
    """(root, split) for ``groups`` (root, size): whole groups, so that every split gets its share of the records.

    Bands are powers of two of the size. The few groups of sparse bands (fewer than ``dense`` groups; there are at most 64
    bands, so this is a bounded table) are dealt one by one, the largest first, each to the split that lacks most records.
    What is then still missing is the target of the dense bands: within one, groups stand by size and hash and are dealt
    by a fixed step, so any stretch of the order is divided as asked; they are worked in hash buckets of about
    ``per_bucket`` groups. A split can miss its share by no more than the largest group, or by a few groups of a bucket.
    """
    if abs(sum(fractions.values()) - 1) > 1e-9:
        raise ValueError("fractions must sum to 1")
    ship(groups.sparkSession)
    names = list(fractions)
    h = F.xxhash64("root", F.lit(seed))
    bands = materialize(groups.select("root", F.col("size").cast("bigint").alias("size"), h.alias("h"), F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)))).cast("int").alias("band")), "bands")
    stats = {r.band: (r.n, r.records) for r in bands.groupBy("band").agg(F.count("*").alias("n"), F.sum("size").alias("records")).collect()}  # one row per power of two
    total = sum(r for _, r in stats.values())
    wanted = {k: total * f for k, f in fractions.items()}
    sparse = [b for b, (n, _) in stats.items() if n < dense]
    few = bands.filter(F.col("band").isin(sparse)) if sparse else bands.filter(F.lit(False))
    few = materialize(few.repartition(1).sortWithinPartitions(F.desc("size"), "h", "root").select("root", "size").mapInPandas(_by_deficit(names, list(wanted.values())), "root string, size bigint, split string"), "few")
    for r in few.groupBy("split").agg(F.sum("size").alias("n")).collect():
        wanted[r.split] -= r.n
    lack = [max(0.0, x) for x in wanted.values()]
    whole = sum(lack)
    share = [x / whole if whole else f for x, f in zip(lack, fractions.values(), strict=True)]
    rest = bands.filter(~F.col("band").isin(sparse)) if sparse else bands
    buckets = F.create_map(*(F.lit(v) for b, (n, _) in stats.items() for v in (b, max(1, n // per_bucket)))) if stats else F.create_map(F.lit(0), F.lit(1))
    x = rest.withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 20), buckets[F.col("band")]))
    k = F.row_number().over(W.partitionBy("band", "bucket").orderBy("size", "h", "root"))
    # the golden step spreads any run of k evenly over [0, 1)
    at = (F.pmod(F.xxhash64("band", "bucket", F.lit(seed)), F.lit(1000)) / 1000 + k * 0.6180339887498949) % 1
    split, upto = None, 0.0
    for name, part in zip(names[:-1], share[:-1], strict=True):
        upto += part
        split = F.when(at < upto, name) if split is None else split.when(at < upto, name)
    last = next((n for n, p in zip(reversed(names), reversed(share), strict=True) if p > 0), names[-1])
    return few.select("root", "split").unionByName(x.select("root", (F.lit(last) if split is None else split.otherwise(last)).alias("split")))


def related_conversations(messages: DataFrame, threads: DataFrame, others: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(conversation_id, root) for every conversation of the tables: same account, parent, or continuing id, along chains;
    and (u, v), the spanning forest that holds the groups together, kept as a table. Its nodes are conversations, parents
    that are no conversation, and hubs of accounts (their names begin with U+0001)."""
    cid = T.label(F.col("conversation_id"))
    owned = messages.select(cid.alias("member"), T.account(F.col("account_id")).alias("key")).filter("member <> ''").distinct()
    owned = materialize(owned, "owned")
    ids = owned.select(F.col("member").alias("id")).unionByName(threads.select(cid.alias("id")))
    if others is not None:
        ids = ids.unionByName(others.select(cid.alias("id")))
    ids = materialize(ids.filter("id <> ''").distinct(), "ids")
    parents = threads.select(cid.alias("id"), T.label(F.col("parent_id")).alias("other")).filter("id <> ''")
    edges = star_edges(owned).unionByName(named_edges(parents, ids)).unionByName(continuation_edges(ids))
    members, forest = spanning_forest(edges)
    release(owned)
    groups = ids.join(members, ids["id"] == members["node"], "left").select(F.col("id").alias("conversation_id"), F.coalesce("root", "id").alias("root"))
    return groups, forest
