"""Query-passage pairs: boilerplate, normalisation, first-wins deduplication, row ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions import text as T

SEED = 42
MIN_FREQUENCY = 100  # rows that must share a sentence before it counts as boilerplate


def read(df: DataFrame, row: str = "pair_row", query: str = "query", positive: str = "positive") -> DataFrame:
    """(_row, query, positive): visible texts; a null reads as an empty text, and a row with an empty side is left out."""
    missing = sorted({row, query, positive} - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    text = lambda c: T.visible(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return df.select(F.col(row).cast("bigint").alias("_row"), text(query).alias("query"), text(positive).alias("positive")).filter("query <> '' AND positive <> ''")


def sentence_frequency(pairs: DataFrame) -> DataFrame:
    """(sentence, rows): rows whose passage holds the sentence, in lower case; twice in one row counts once."""
    once = F.array_distinct(F.transform(T.sentences(F.col("positive")), lambda s: F.lower(s)))
    return pairs.select(F.explode(once).alias("sentence")).groupBy("sentence").agg(F.count("*").alias("rows"))


def strip_boilerplate(pairs: DataFrame, threshold: int = MIN_FREQUENCY) -> DataFrame:
    """Adds positive_original, cleaned ``positive``, removed (sentences) and fell_back.

    Sentences in at least ``threshold`` rows are dropped; a passage that would lose all of them keeps its text. At most
    total sentences / ``threshold`` are frequent. They meet the passages by a join on the sentence and not as a literal, so
    the list may be of any size; Spark broadcasts it only below its size limit. Rows are put together again by _row, which must be unique.
    """
    frequent = sentence_frequency(pairs).filter(F.col("rows") >= threshold).select(F.col("sentence").alias("k"), F.lit(True).alias("frequent"))
    each = pairs.select("_row", F.posexplode(T.sentences(F.col("positive"))).alias("pos", "s")).withColumn("k", F.lower("s"))
    kept = (
        each.join(frequent, "k", "left")
        .groupBy("_row")
        .agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.when(F.col("frequent").isNull(), F.struct("pos", "s")))).alias("kept"))
        .select("_row", "n", F.size("kept").alias("m"), F.trim(F.array_join(F.transform("kept", lambda x: x["s"]), " ")).alias("text"))
    )
    fell = F.coalesce(F.col("m") == 0, F.lit(True))
    clean = F.when(fell | (F.col("text") == ""), F.col("positive")).otherwise(F.col("text"))
    out = pairs.join(kept, "_row", "left").select("_row", "query", F.col("positive").alias("positive_original"), clean.alias("positive"), fell.alias("fell_back"), F.when(fell, 0).otherwise(F.col("n") - F.col("m")).alias("lost"))
    return out.withColumn("removed", F.when(F.col("positive") != F.col("positive_original"), F.col("lost")).otherwise(0).cast("bigint")).drop("lost")


def boilerplate_report(stripped: DataFrame) -> DataFrame:
    return stripped.agg(
        F.count("*").alias("rows"), F.count_if(F.col("positive") != F.col("positive_original")).alias("rows_changed"), F.coalesce(F.sum("removed"), F.lit(0)).alias("sentences_removed"), F.count_if("fell_back").alias("fallback_rows")
    )


def top_sentences(freq: DataFrame, threshold: int, n: int = 25) -> DataFrame:
    """The ``n`` most frequent sentences, and of those the ones at the threshold; ties by sentence."""
    return freq.orderBy(F.desc("rows"), "sentence").limit(n).filter(F.col("rows") >= threshold)


def dedup_first(df: DataFrame, keys: list[str], order: str = "_row") -> DataFrame:
    """The first row of every key. Combines before the shuffle, so a key of any number of rows is one row a task."""
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_first"))
    return g.select(*keys, "_first.*").select(*df.columns)


def prepare(df: DataFrame, threshold: int = MIN_FREQUENCY, row: str = "pair_row") -> DataFrame:
    """Prepared pairs: _row, query, positive, positive_original, query_norm, positive_norm, row_uid."""
    s = strip_boilerplate(read(df, row), threshold)
    n = s.select("_row", "query", "positive", "positive_original", F.lower("query").alias("query_norm"), T.norm(F.col("positive")).alias("positive_norm"))
    return dedup_first(n, ["query_norm", "positive_norm"]).withColumn("row_uid", T.row_uid(F.col("query_norm"), F.col("positive_norm")))


def counts(raw: DataFrame, nonempty: DataFrame, prepared: DataFrame) -> DataFrame:
    """One row of bookkeeping: rows before and after each step and distinct texts."""
    a = raw.agg(F.count("*").alias("original_rows"))
    b = nonempty.agg(F.count("*").alias("nonempty_rows"))
    c = prepared.agg(F.count("*").alias("rows_after_dedup"), F.countDistinct("query_norm").alias("unique_queries"), F.countDistinct("positive_norm").alias("unique_passages"))
    one = lambda d: d.withColumn("_one", F.lit(1))
    return one(a).join(one(b), "_one").join(one(c), "_one").select("original_rows", "nonempty_rows", "rows_after_dedup", (F.col("nonempty_rows") - F.col("rows_after_dedup")).alias("exact_pairs_removed"), "unique_queries", "unique_passages")


def _one_each(rows: DataFrame, key: str, what: str) -> DataFrame:
    """``rows``, where a key that is null or stands twice is an error."""
    n = F.count("*").over(W.partitionBy(key))
    bad = F.raise_error(F.concat(F.lit(f"{what}: not one row for "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean")
    return rows.withColumn("_n", n).filter(F.when(F.col(key).isNull() | (F.col("_n") > 1), bad).otherwise(True)).drop("_n")


def training_rows(prepared: DataFrame, negatives: DataFrame | None = None) -> DataFrame:
    """(row_uid, anchor, positive[, negative]) with the prefixes that retrieval encoders expect.

    ``negatives`` (row_uid, negative) must have one row for every pair, and every pair one row_uid; anything else is an error.
    """
    pre: Column = F.concat(F.lit("query: "), "query").alias("anchor")
    pos = F.concat(F.lit("passage: "), "positive").alias("positive")
    if negatives is None:
        return prepared.select("row_uid", pre, pos)
    j = _one_each(prepared, "row_uid", "pairs").join(_one_each(negatives.select("row_uid", "negative"), "row_uid", "every pair needs exactly one negative"), "row_uid", "left")
    some = F.when(F.col("negative").isNotNull(), F.col("negative")).otherwise(F.raise_error(F.concat(F.lit("every pair needs exactly one negative: none for "), F.col("row_uid"))))
    return j.select("row_uid", pre, pos, F.concat(F.lit("passage: "), some).alias("negative"))


def repeats_in_batches(rows: DataFrame, batch: str, columns: tuple[str, ...] = ("anchor", "positive")) -> DataFrame:
    """(batch, text, times): texts that stand more than once in a batch, in any of the ``columns``; with in-batch negatives there may be none."""
    each = rows.select(batch, F.explode(F.array(*columns)).alias("text"))
    return each.groupBy(batch, "text").agg(F.count("*").alias("times")).filter("times > 1")


def head(rows: DataFrame, n: int, order: str = "_row") -> DataFrame:
    """The first ``n`` rows in the order of a column (all, if there are fewer)."""
    return rows.orderBy(order).limit(n)
