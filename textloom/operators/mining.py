"""Semi-hard negatives: the best-scored passage of another group that is similar, but not too similar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.vectors import dot
from textloom.session import materialize

MARGIN, MAX_JACCARD = 0.02, 0.88
DRAWS = 4  # places that an anchor draws; a later one counts where an earlier led to its own passage


def mine(anchors: DataFrame, near: DataFrame, corpus: DataFrame, margin: float = MARGIN, max_jaccard: float | None = MAX_JACCARD, seed: int = 42) -> DataFrame:
    """(qid, did, mode, margin): one negative for each of ``anchors`` (qid, pos_id, component, pos_score, v[, pos_norm]).

    ``near`` (qid, rank, did, score) is the candidate list, cut before any filter. ``corpus`` (did, component, v[, norm])
    says what the candidates are; passages of a token Jaccard at or over ``max_jaccard`` with the anchor's don't count,
    which needs the texts ``pos_norm`` and ``norm``; None switches that guard off. "semi_hard" is the first candidate, by
    rank, of another group than the anchor's, other than its passage, and scored at most its passage's score less
    ``margin``. Anchors without one take the "random_fallback" (see ``fallback``), which is scored by their vectors, so
    every row has a margin. With a single group there is no negative: an error.
    """
    if max_jaccard is not None and not ("norm" in corpus.columns and "pos_norm" in anchors.columns):
        raise ValueError("the Jaccard guard needs norm and pos_norm; max_jaccard=None leaves it out")
    c = corpus.select("did", F.col("component").alias("c2"), *(["norm"] if max_jaccard is not None else []))
    x = near.join(anchors.drop("v"), "qid").join(c, "did").filter((F.col("did") != F.col("pos_id")) & (F.col("c2") != F.col("component")) & (F.col("score") <= F.col("pos_score") - margin))
    if max_jaccard is not None:
        x = x.filter(T.token_jaccard(F.col("pos_norm"), F.col("norm")) < max_jaccard)
    hard = x.groupBy("qid").agg(F.min_by(F.struct("did", "score"), "rank").alias("m")).select("qid", "m.did", F.col("m.score").alias("score"), F.lit("semi_hard").alias("mode"))
    hard = materialize(hard, "hard")
    drawn = fallback(anchors.join(hard.select("qid"), "qid", "left_anti"), corpus, seed)
    scored = drawn.join(anchors.select("qid", "v"), "qid").join(corpus.select("did", F.col("v").alias("w")), "did").select("qid", "did", dot(F.col("v"), F.col("w")).alias("score"), F.lit("random_fallback").alias("mode"))
    return hard.unionByName(scored).join(anchors.select("qid", "pos_score"), "qid").select("qid", "did", "mode", (F.col("pos_score") - F.col("score")).alias("margin"))


def _placed(corpus: DataFrame, seed: int) -> DataFrame:
    """(place, did, component, next_did): the corpus in the order of a seeded hash, places from 0, and of each passage the next one, around the circle, of another group; null if there is none.

    Places are built by hash range: 4096 ranges are summed first, so no window spans the table, and what the last group of
    a range is followed by is read off one row a range.
    """
    h = T.sha1_seeded(F.col("did").cast("string"), seed)
    x = materialize(corpus.select("did", "component", h.alias("h"), F.substring(h, 1, 3).alias("range")), "corpus")
    w = W.partitionBy("range").orderBy("h", "did")
    x = x.withColumn("k", F.row_number().over(w) - 1)
    first = F.min_by(F.struct("component", "did"), "k")
    edge = x.groupBy("range").agg(F.count("*").alias("n"), first.alias("first"), F.max_by("component", "k").alias("last"))
    other = x.join(edge.select("range", F.col("first.component").alias("c0")), "range").filter("component <> c0").groupBy("range").agg(F.min_by("did", "k").alias("other"))
    rows = sorted(edge.join(other, "range", "left").collect(), key=lambda r: r.range)  # 4096 at most
    base, bases, follows = 0, {}, {}
    for i, r in enumerate(rows):
        bases[r.range] = base
        base += r.n
        follows[r.range] = None
        for s in (*rows[i + 1 :], *rows[: i + 1]):  # the range itself comes last
            if s.first.component != r.last:
                follows[r.range] = s.first.did
                break
            if s.other is not None:
                follows[r.range] = s.other
                break
    kind = dict(corpus.dtypes)["did"]
    ranges = corpus.sparkSession.createDataFrame([(k, bases[k], follows[k]) for k in bases], f"range string, base long, after {kind}")
    change = F.when(F.coalesce(F.lag("component").over(w) != F.col("component"), F.lit(False)), F.struct("k", "did"))
    down = W.partitionBy("range").orderBy(F.desc("k")).rowsBetween(W.unboundedPreceding, -1)
    x = x.withColumn("turn", change).withColumn("next", F.min("turn").over(down))
    return x.join(F.broadcast(ranges), "range").select((F.col("base") + F.col("k")).alias("place"), "did", "component", F.coalesce("next.did", "after").alias("next_did"))


def fallback(anchors: DataFrame, corpus: DataFrame, seed: int = 42) -> DataFrame:
    """(qid, did): for each of ``anchors`` (qid, pos_id, component) a passage of another group, drawn evenly by a hash of ``seed`` and qid.

    The corpus stands in an order of its own hash; an anchor draws a place in it and takes the passage there, or, where
    that is of its own group, the next one that isn't. The anchor's own passage is passed over for the next draw. No anchor
    is compared with more than DRAWS passages. Where every group is the anchor's there is no negative: an error.
    """
    corpus = corpus.select("did", "component")
    placed = materialize(_placed(corpus, seed), "placed")
    n = placed.count()
    number = lambda j: F.pmod(F.conv(F.substring(F.sha1(F.concat(F.lit(f"{seed}\0"), F.col("qid").cast("string"), F.lit(f"\0{j}")).cast("binary")), 1, 12), 16, 10).cast("bigint"), F.lit(max(1, n)))
    draws = F.explode(F.array(*(F.struct(F.lit(j).alias("draw"), number(j).alias("place")) for j in range(DRAWS))))
    x = anchors.select("qid", "pos_id", F.col("component").alias("own"), draws.alias("x")).select("qid", "pos_id", "own", "x.*")
    got = x.join(placed, "place", "left").withColumn("pick", F.when(F.col("component") != F.col("own"), F.col("did")).otherwise(F.col("next_did")))
    got = got.groupBy("qid").agg(F.min_by("pick", F.when(F.col("pick").isNotNull() & (F.col("pick") != F.col("pos_id")), F.col("draw"))).alias("did"))
    return got.select("qid", F.coalesce("did", F.raise_error("a single group has no negatives").cast(dict(corpus.dtypes)["did"])).alias("did"))


def margins(mined: DataFrame) -> DataFrame:
    """One row over all rows: rows, how many of either mode, mean and median margin."""
    mode = lambda m: F.count_if(F.col("mode") == m).alias(m)
    return mined.agg(F.count("*").alias("rows"), mode("semi_hard"), mode("random_fallback"), F.avg("margin").alias("mean_margin"), F.median("margin").alias("median_margin"))


def write_negatives(negatives: DataFrame, path: str, meta: dict) -> None:
    """Sink of (row_uid, negative) as Parquet with its metadata row; a row_uid that is null or stands twice is an error."""
    spark = negatives.sparkSession
    n = F.count("*").over(W.partitionBy("row_uid"))
    once = F.when(F.col("row_uid").isNull() | (n > 1), F.raise_error(F.concat(F.lit("more than one negative for "), F.coalesce("row_uid", F.lit("null")))).cast("string")).otherwise(F.col("negative"))
    negatives.select("row_uid", once.alias("negative")).write.mode("overwrite").parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows").count()
    spark.createDataFrame([(rows, *map(str, meta.values()))], ", ".join(["rows long", *(f"`{k}` string" for k in meta)])).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def read_negatives(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """The negatives written to ``path``; an error if their number isn't that of the metadata, or of ``rows``."""
    got = spark.read.parquet(f"{path}/rows")
    n, meta = got.count(), spark.read.parquet(f"{path}/meta").first().rows
    if n != meta or (rows is not None and n != rows):
        raise ValueError(f"{n} negatives, {meta} by their metadata, {rows} wanted")
    return got
