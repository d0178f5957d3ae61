"""Components of pairs and deterministic splits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.forest import spanning_forest
from textloom.session import materialize, ship

NAMES = ("train", "validation", "test")


def check_fractions(fractions: tuple[float, ...]) -> None:
    if abs(sum(fractions) - 1) > 1e-9:
        raise ValueError("fractions must sum to 1")


def components(prepared: DataFrame, mode: str = "canonical") -> DataFrame:
    """``prepared`` with ``component``: pairs that share a query or a passage, along chains, have the same one.

    The id hashes the group's root label: the least label ("canonical", independent of partitioning), or the root that
    union by size reaches when the pairs are taken in _row order ("replay"; groups are independent, each is replayed on its own, over 48 bytes a pair).
    Texts are handled as hashes; only the least label of a group is carried whole.
    """
    if mode not in ("canonical", "replay"):
        raise ValueError(mode)
    q, p = F.concat(F.lit("q:"), "query_norm"), F.concat(F.lit("p:"), "positive_norm")
    x = prepared.withColumn("_u", F.sha1(q.cast("binary"))).withColumn("_v", F.sha1(p.cast("binary")))
    members, _ = spanning_forest(x.select(F.col("_u").alias("u"), F.col("_v").alias("v")))
    x = x.join(members.select(F.col("node").alias("_u"), F.col("root").alias("_root")), "_u")
    if mode == "replay":
        ship(prepared.sparkSession)
        # only hashes are gathered; the label's text is fetched by its hash
        order = x.select("_root", "_row", "_u", "_v").groupBy("_root").applyInPandas(_replay, "_root string, _label string")
        ends = x.select("_root", F.explode(F.array(F.struct(F.col("_u").alias("_label"), q.alias("label")), F.struct(F.col("_v").alias("_label"), p.alias("label")))).alias("e")).select("_root", "e.*")
        roots = ends.join(order, ["_root", "_label"]).groupBy("_root").agg(F.min("label").alias("label"))
    else:
        roots = x.groupBy("_root").agg(F.least(F.min(q), F.min(p)).alias("label"))
    ids = roots.select("_root", F.substring(T.sha1_seeded(F.col("label")), 1, 20).alias("component"))
    return x.join(ids, "_root").drop("_u", "_v", "_root")


def _replay(pdf: pd.DataFrame) -> pd.DataFrame:
    """Union by size over the hashed pairs of one group in _row order: the root that it reaches."""
    pdf = pdf.sort_values("_row")
    codes, names = pd.factorize(pd.concat([pdf["_u"], pdf["_v"]], ignore_index=True))
    n = len(pdf)
    parent, size = list(range(len(names))), [1] * len(names)

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(codes[:n].tolist(), codes[n:].tolist(), strict=True):
        big, small = top(a), top(b)
        if big != small:
            if size[big] < size[small]:
                big, small = small, big
            parent[small] = big
            size[big] += size[small]
    return pd.DataFrame({"_root": [pdf["_root"].iloc[0]], "_label": [names[top(int(codes[0]))]]})


def sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("component").agg(F.count("*").alias("size"))


def _dealer(total: int, fractions: tuple[float, ...]) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        want = [total * f for f in fractions]
        have = [0] * len(want)
        for pdf in frames:
            out = []
            for n in pdf["size"]:
                k = max(range(len(want)), key=lambda i: ((want[i] - have[i]) / max(want[i], 1), -i))
                have[k] += n
                out.append(NAMES[k])
            yield pdf.assign(split=out)[["component", "size", "split"]]

    return run


def greedy_split(rows: DataFrame, seed: int = 42, fractions: tuple[float, float, float] = (0.8, 0.1, 0.1)) -> DataFrame:
    """(component, size, split): components in hash order, each to the split that lacks the greatest share of its target; ties to the first.

    Each decision rests on all before it, so this is a fold by definition: it streams, in constant memory, over one small
    row per component, sorted by Spark (which spills). Everything per pair stays distributed.
    """
    check_fractions(fractions)
    ship(rows.sparkSession)
    s = materialize(sizes(rows), "sizes")
    total = s.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    order = s.withColumn("h", T.sha1_seeded(F.col("component"), seed))
    return order.repartition(1).sortWithinPartitions("h", "component").mapInPandas(_dealer(total, fractions), "component string, size bigint, split string")


def cap_components(rows: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """Components kept under a row cap: (component, size). In hash order whole components are taken while fewer than ``most`` rows precede; all, if all fit.

    Running totals are built by hash range: ranges are summed first, so no window spans the table.
    """
    from pyspark.sql import Window as W

    s = materialize(sizes(rows).withColumn("h", T.sha1_seeded(F.col("component"), seed)).withColumn("range", F.substring("h", 1, 3)), "sizes")
    per = s.groupBy("range").agg(F.sum("size").alias("t"))  # 4096 rows at most
    before = per.select("range", F.coalesce(F.sum("t").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("b"), F.sum("t").over(W.partitionBy()).alias("total"))
    w = W.partitionBy("range").orderBy("h", "component").rowsBetween(W.unboundedPreceding, -1)
    x = s.join(F.broadcast(before), "range").withColumn("prev", F.col("b") + F.coalesce(F.sum("size").over(w), F.lit(0)))
    return x.filter((F.col("total") <= most) | (F.col("prev") < most)).select("component", "size")


def isolation(rows: DataFrame, columns: tuple[str, ...] = ("component", "query_norm", "positive_norm")) -> DataFrame:
    """(field, split_a, split_b, shared): values of each column that two splits share. ``rows`` has a ``split`` column; zero counts are listed."""
    each = rows.select("split", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns))).alias("x")).select("split", "x.*").filter("value IS NOT NULL")
    # one row per value, with the set of its splits: three names at most
    sets = each.groupBy("field", "value").agg(F.collect_set("split").alias("s")).groupBy("field", "s").agg(F.count("*").alias("n"))
    pairs = [(a, b) for i, a in enumerate(NAMES) for b in NAMES[i + 1 :]]
    cols = [F.struct(F.lit(a).alias("split_a"), F.lit(b).alias("split_b"), F.when(F.array_contains("s", a) & F.array_contains("s", b), F.col("n")).otherwise(0).alias("n")) for a, b in pairs]
    return sets.select("field", F.explode(F.array(*cols)).alias("x")).select("field", "x.*").groupBy("field", "split_a", "split_b").agg(F.sum("n").alias("shared"))


def ordered_split(items: DataFrame, key: str, seed: int = 42, fractions: tuple[float, float, float] = (0.8, 0.1, 0.1), most: int | None = None) -> DataFrame:
    """``items`` with split and position: in the order of sha256(seed, key), train then validation then test, each at least one row.

    Sizes are bankers' roundings of the fractions. Fewer than three rows raise an error. Ranks are built by hash range.
    """
    from pyspark.sql import Window as W

    check_fractions(fractions)
    x = materialize(items.withColumn("_h", T.sha256_seeded(F.col(key), seed)).withColumn("_range", F.substring("_h", 1, 3)), "items")
    per = x.groupBy("_range").agg(F.count("*").alias("t"))
    before = per.select("_range", F.coalesce(F.sum("t").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("b"), F.sum("t").over(W.partitionBy()).alias("_all"))
    k = F.row_number().over(W.partitionBy("_range").orderBy("_h", key))
    r = x.join(F.broadcast(before), "_range").withColumn("position", F.col("b") + k)
    n = F.col("_all") if most is None else F.least(F.col("_all"), F.lit(most))
    r = r.withColumn("_n", F.when(n < 3, F.raise_error("at least three rows are needed").cast("bigint")).otherwise(n)).filter(F.col("position") <= F.col("_n"))
    size = lambda f: F.greatest(F.lit(1), F.bround(F.col("_n") * f).cast("bigint"))
    train, val = size(fractions[0]), size(fractions[1])
    tight = train + val >= F.col("_n")
    train, val = F.when(tight, F.greatest(F.lit(1), F.col("_n") - 2)).otherwise(train), F.when(tight, 1).otherwise(val)
    split = F.when(F.col("position") <= train, "train").when(F.col("position") <= train + val, "validation").otherwise("test")
    return r.withColumn("split", split).drop("_h", "_range", "b", "_all", "_n")


def shuffled(rows: DataFrame, seed: int = 42, key: str = "row_uid") -> DataFrame:
    """The rows in the order of a seeded hash; who is in a split doesn't change."""
    return rows.orderBy(T.sha1_seeded(F.col(key), seed), key)


def require_isolated(rows: DataFrame, columns: tuple[str, ...] = ("conversation_id",)) -> DataFrame:
    """``rows``, if no value of the ``columns`` stands in two splits; otherwise an error that names the splits and counts."""
    bad = isolation(rows, columns).filter("shared > 0").collect()  # three rows a column at most
    if bad:
        raise ValueError("shared between splits: " + "; ".join(f"{r.shared} of {r.field} by {r.split_a} and {r.split_b}" for r in sorted(bad)))
    return rows
