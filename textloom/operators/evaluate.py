"""Retrieval evaluation: query, corpus and relevance tables, ranking metrics, confidence thresholds, model choice."""

from __future__ import annotations

import math
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import vectors
from textloom.session import materialize

TARGETS = (0.90, 0.95, 0.98)


def bundle(split_rows: DataFrame, pool: DataFrame, seed: int, max_queries: int, max_corpus: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """queries (qid, text), corpus (did, text, positive_norm), qrels (qid, did) for a split of prepared pairs.

    ``pool`` holds the pairs whose passages may stand beside the required ones. Both caps are features of the report: the
    tables that are ranked and numbered below never have more than ``max_queries`` and ``max_corpus`` rows.
    """
    per = split_rows.groupBy("query_norm").agg(F.min_by("query", "_row").alias("query")).withColumn("h", T.sha1_seeded(F.col("query_norm"), seed))
    top = per.orderBy("h", "query_norm").limit(max_queries)
    q = materialize(top.withColumn("k", F.row_number().over(W.orderBy("h", "query_norm")) - 1), "queries")
    need = split_rows.join(q.select("query_norm", "k"), "query_norm")
    required = need.groupBy("positive_norm").agg(F.min(F.struct("k", "_row")).alias("at"), F.max_by("positive", F.struct("k", "_row")).alias("positive"))
    rest = pool.groupBy("positive_norm").agg(F.min_by("positive", "_row").alias("positive")).join(required.select("positive_norm"), "positive_norm", "left_anti")
    first = required.orderBy("at").limit(max_corpus).select("positive_norm", "positive", F.lit(0).alias("part"), F.col("at.k").cast("bigint").alias("a"), F.col("at._row").cast("bigint").alias("b"), F.lit("").alias("h"))
    other = rest.withColumn("h", T.sha1_seeded(F.col("positive_norm"), seed + 7)).orderBy("h", "positive_norm").limit(max_corpus).select("positive_norm", "positive", F.lit(1).alias("part"), F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), "h")
    order = ["part", "a", "b", "h", "positive_norm"]
    c = first.unionByName(other).orderBy(*order).limit(max_corpus)
    c = materialize(c.withColumn("j", F.row_number().over(W.orderBy(*order)) - 1), "corpus")
    rel = materialize(need.join(c.select("positive_norm", "j"), "positive_norm").select("k", "j").distinct(), "qrels")
    name = lambda p, x: F.format_string(f"{p}%06d", F.col(x))
    queries = q.join(rel.select("k").distinct(), "k", "left_semi").select(name("q", "k").alias("qid"), F.concat(F.lit("query: "), "query").alias("text"))
    corpus = c.select(name("d", "j").alias("did"), F.concat(F.lit("passage: "), "positive").alias("text"), "positive_norm")
    return queries, corpus, rel.select(name("q", "k").alias("qid"), name("d", "j").alias("did"))


def _gain(rank) -> Column:
    return F.lit(1.0) / F.log2(rank + 1)


def _ideal(n, k: int) -> Column:
    """Sum of the gains of the first min(n, k) ranks."""
    table = [0.0]
    for r in range(1, k + 1):
        table.append(table[-1] + 1.0 / math.log2(r + 1))
    return F.element_at(F.array(*map(F.lit, table)), F.least(n, F.lit(k)).cast("int") + 1)


def per_query(top: DataFrame, qrels: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per (by, qid): first_rank, relevant, top_score, hits at 1, 5, 10, gains, average precision.

    ``top`` (by.., qid, rank, did, score), ``qrels`` (qid, did). A query without a relevant hit has a null first_rank.
    """
    rel = qrels.select("qid", "did").distinct()
    n = rel.groupBy("qid").agg(F.count("*").alias("relevant"))
    x = top.join(rel.withColumn("hit", F.lit(True)), ["qid", "did"], "left")
    x = x.withColumn("seen", F.count("hit").over(W.partitionBy(*by, "qid").orderBy("rank")))
    hit = F.col("hit").isNotNull()
    at = lambda k: F.count_if(hit & (F.col("rank") <= k))
    g = x.groupBy(*by, "qid").agg(
        F.min(F.when(hit, F.col("rank"))).alias("first_rank"), F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("top_score"),
        *(at(k).alias(f"hits{k}") for k in (1, 5, 10)),
        F.coalesce(F.sum(F.when(hit & (F.col("rank") <= 10), _gain(F.col("rank")))), F.lit(0.0)).alias("dcg"),
        F.coalesce(F.sum(F.when(hit & (F.col("rank") <= 100), F.col("seen") / F.col("rank"))), F.lit(0.0)).alias("ap"),
    )
    return g.join(n, "qid", "left").withColumn("relevant", F.coalesce("relevant", F.lit(0)))


def metrics(per: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Means over queries: accuracy, precision and recall at 1, 5, 10, MRR@10, NDCG@10, MAP@100."""
    rel = F.greatest(F.lit(1), F.col("relevant"))
    ideal = _ideal(F.col("relevant"), 10)
    cols = [F.count("*").alias("queries")]
    for k in (1, 5, 10):
        cols += [F.avg(F.coalesce(F.col("first_rank") <= k, F.lit(False)).cast("double")).alias(f"accuracy_{k}"), F.avg(F.col(f"hits{k}") / rel).alias(f"recall_{k}"), F.avg(F.col(f"hits{k}") / k).alias(f"precision_{k}")]
    cols += [
        F.avg(F.coalesce(F.when(F.col("first_rank") <= 10, 1 / F.col("first_rank")), F.lit(0.0))).alias("mrr_10"),
        F.avg(F.col("dcg") / F.when(ideal > 0, ideal).otherwise(1.0)).alias("ndcg_10"),
        F.avg(F.col("ap") / F.least(rel, F.lit(100))).alias("map_100"),
    ]
    return per.groupBy(*by).agg(*cols) if by else per.agg(*cols)


def thresholds(per: DataFrame, by: str) -> DataFrame:
    """(by, threshold, accepted, correct, queries): the distinct 201 quantiles of the best scores, and what each accepts.

    Quantiles come from exact order statistics at integer positions, so a threshold that is a data point equals it to the
    bit. Scores are ranked once; acceptance is read off by position instead of comparing every threshold with every score.
    """
    x = per.filter("top_score IS NOT NULL").select(by, "top_score", (F.coalesce(F.col("first_rank") == 1, F.lit(False))).cast("int").alias("ok"))
    # equal scores count together; the window runs over distinct scores
    g = x.groupBy(by, "top_score").agg(F.count("*").alias("n"), F.sum("ok").alias("ok"))
    up = W.partitionBy(by).orderBy("top_score")
    down = W.partitionBy(by).orderBy(F.desc("top_score"))
    all_ = W.partitionBy(by)
    g = g.withColumn("upto", F.sum("n").over(up)).withColumn("queries", F.sum("n").over(all_)).withColumn("acc", F.sum("n").over(down)).withColumn("cor", F.sum("ok").over(down))
    g = materialize(g, "scores")
    # the quantile i of 200 lies between the 0-based positions floor and ceil of (n - 1) i / 200; a group of equal scores
    # holds the positions from upto - n to upto - 1, so it finds the i that it answers by arithmetic
    m, first, last = F.greatest(F.col("queries") - 1, F.lit(1)), F.col("upto") - F.col("n"), F.col("upto") - 1
    single = F.col("queries") == 1
    at_least = lambda x: F.floor((x + m - 1) / m).cast("bigint")

    def answers(lo: Column, hi: Column, name: str) -> DataFrame:
        lo, hi = F.when(single, 0).otherwise(F.greatest(lo, F.lit(0))).cast("bigint"), F.when(single, 200).otherwise(F.least(hi, F.lit(200))).cast("bigint")
        mine = F.when(lo <= hi, F.sequence(lo, F.greatest(lo, hi))).otherwise(F.array().cast("array<bigint>"))
        return g.select(by, "queries", F.struct(F.col("top_score").alias("s"), "acc", "cor").alias(name), F.explode(mine).alias("i"))

    below = answers(at_least(200 * first), at_least(200 * (last + 1)) - 1, "s0")
    above = answers(F.floor(200 * (first - 1) / m).cast("bigint") + 1, F.floor(200 * last / m).cast("bigint"), "s1").drop("queries")
    rest = F.pmod((F.col("queries") - 1) * F.col("i"), F.lit(200))
    value = F.when(rest == 0, F.col("s0.s")).otherwise(F.col("s0.s") + (F.col("s1.s") - F.col("s0.s")) * (rest / 200.0))
    t = below.join(above, [by, "i"]).select(by, "queries", value.alias("threshold"), "s0", "s1")
    # the least score at or over the threshold is one of the two, and its group knows how many scores lie there
    hit = F.when(F.col("threshold") <= F.col("s0.s"), F.col("s0")).otherwise(F.col("s1"))
    return t.select(by, "threshold", hit["acc"].alias("accepted"), hit["cor"].alias("correct"), "queries").distinct()


def calibration(per: DataFrame, by: str) -> DataFrame:
    """(by, threshold, precision, coverage, f1) of every threshold that accepts something."""
    p, c = F.col("correct") / F.col("accepted"), F.col("accepted") / F.col("queries")
    t = thresholds(per, by).select(by, "threshold", p.alias("precision"), c.alias("coverage"))
    return t.withColumn("f1", F.when(F.col("precision") + F.col("coverage") > 0, 2 * F.col("precision") * F.col("coverage") / (F.col("precision") + F.col("coverage"))).otherwise(0.0))


def targets(cal: DataFrame, by: str) -> DataFrame:
    """(by, target, threshold, precision, coverage): per target the threshold of the widest coverage, null if none reaches it; and "best_f1"."""
    v = F.struct("threshold", "precision", "coverage")
    names = [f"c{k}" for k in range(len(TARGETS) + 1)]
    # each max_by is an aggregate of its own; the target names are put beside them afterwards
    aggs = [F.max_by(F.when(F.col("precision") >= t, v), F.when(F.col("precision") >= t, F.struct("coverage", "precision", (-F.col("threshold")).alias("low")))).alias(n) for t, n in zip(TARGETS, names, strict=False)]
    g = cal.groupBy(by).agg(*aggs, F.max_by(v, F.struct("f1", (-F.col("threshold")).alias("low"))).alias(names[-1]))
    labels = [f"precision_{round(t * 100)}" for t in TARGETS] + ["best_f1"]
    return g.select(by, F.explode(F.array(*(F.struct(F.lit(x).alias("target"), F.col(n).alias("v")) for x, n in zip(labels, names, strict=True)))).alias("x")).select(by, "x.target", "x.v.*")


def choose(scores: DataFrame, min_gain: float = 0.0, protect: bool = True) -> DataFrame:
    """(winner, score) of ``scores`` (name, ordinal, score): the best trained candidate, or "base" if protected and the gain is under ``min_gain``.

    Candidates without a score don't compete; a score that isn't finite, no trained score, or no base score under
    protection is an error. Of equal candidates the first wins; a gain of exactly ``min_gain`` keeps the trained one.
    """
    bad = F.col("score").isNotNull() & (F.isnan("score") | (F.abs("score") == float("inf")))
    x = scores.filter(F.when(bad, F.raise_error(F.concat(F.lit("score of "), F.col("name"), F.lit(" is not finite"))).cast("boolean")).otherwise(F.col("score").isNotNull()))
    g = x.agg(F.max_by(F.when(F.col("name") != "base", F.struct("name", "score")), F.when(F.col("name") != "base", F.struct("score", (-F.col("ordinal")).alias("o")))).alias("t"), F.max(F.when(F.col("name") == "base", F.col("score"))).alias("base"))
    none = F.raise_error("no trained candidate has a score").cast("string")
    no_base = F.raise_error("the base has no score").cast("string")
    keep = F.lit(not protect) | (F.col("t.score") >= F.col("base") + min_gain)
    name = F.when(F.col("t").isNull(), none).when(F.lit(protect) & F.col("base").isNull(), no_base).when(keep, F.col("t.name")).otherwise("base")
    return g.select(name.alias("winner"), F.when(keep, F.col("t.score")).otherwise(F.col("base")).alias("score"))


def perplexity(loss) -> Column:
    """exp of the loss, which is cut at 20; null if it isn't finite."""
    return F.when(~F.isnan(loss) & (F.abs(loss) != float("inf")), F.exp(F.least(loss, F.lit(20.0))))


def timed(bundle: tuple[DataFrame, DataFrame, DataFrame], encode, dims: tuple[int, ...], k: int = 100) -> DataFrame:
    """Metrics of a bundle (queries, corpus, qrels; see ``bundle``) at each dimension, with the seconds that it took: encoding_seconds, search_seconds, evaluation_seconds, and search_ms_per_query without the encoding.

    ``encode``: from (key, text) rows to (key, vector), such as ``hooks.embed`` with its model. Ids count by their digits.
    """
    queries, corpus, qrels = bundle
    number = lambda c: F.substring(c, 2, 18).cast("bigint")
    t0 = time.perf_counter()
    q = materialize(encode(queries.select(number("qid").alias("key"), "text")).toDF("qid", "v"), "queries")
    c = materialize(encode(corpus.select(number("did").alias("key"), "text")).toDF("did", "v"), "corpus")
    t1 = time.perf_counter()
    top = materialize(vectors.knn_dims(q, c, dims, k, exclude_self=False), "top")
    t2 = time.perf_counter()
    out = materialize(metrics(per_query(top, qrels.select(number("qid").alias("qid"), number("did").alias("did")), ("dim",)), ("dim",)), "metrics")
    t3 = time.perf_counter()
    per = 1000 * (t2 - t1) / max(1, q.count() * len(dims))
    return out.withColumns({"encoding_seconds": F.lit(t1 - t0), "search_seconds": F.lit(t2 - t1), "evaluation_seconds": F.lit(t3 - t2), "search_ms_per_query": F.lit(per)})
