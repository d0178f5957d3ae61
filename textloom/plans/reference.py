"""Queries of the preparation and evaluation operators over the driver's tables.

pairs: the pair table; messages: the conversation table, read as it stands (no repair of repeated deliveries, which the
audit then reports); embeddings: vectors, of which every row whose id is divisible by 100 is a query against all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import chat, evaluate, mining, pairs, splits, vectors
from textloom.session import materialize, table

THRESHOLD = 10  # rows that share a sentence of the pair table before it counts as boilerplate
FRACTIONS = (0.8, 0.1, 0.1)
DIMS = (64, 32, 16)


# ---------------------------------------------------------------- text


def visible_text(spark: SparkSession, d: str) -> DataFrame:
    v = T.visible(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.coalesce(F.length(v), F.lit(0)).alias("n_chars"), F.md5(v.cast("binary")).alias("digest"))


def norm_text(spark: SparkSession, d: str) -> DataFrame:
    v = T.norm(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.coalesce(F.length(v), F.lit(0)).alias("n_chars"), F.md5(v.cast("binary")).alias("digest"))


def nonempty_docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter(F.coalesce(T.visible(F.col("text")), F.lit("")) != "").select("doc_id", "source")


def sentences(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("pos", "s")).select("doc_id", "pos", F.md5(F.col("s").cast("binary")).alias("digest"))


def run_tokens(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("conversation_id")
    return table(spark, d, "messages").select("msg_id", T.run_token(c).alias("token"), T.run_label(c).alias("label"))


def token_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Question and passage of every pair, as they stand."""
    return table(spark, d, "pairs").select("pair_row", F.round(T.token_jaccard(F.col("query"), F.col("positive")), 9).alias("jaccard"))


# ---------------------------------------------------------------- pairs


def _read(spark: SparkSession, d: str) -> DataFrame:
    return pairs.read(table(spark, d, "pairs"))


def _prepared(spark: SparkSession, d: str) -> DataFrame:
    return materialize(pairs.prepare(table(spark, d, "pairs"), THRESHOLD), "prepared")


def _grouped(spark: SparkSession, d: str) -> DataFrame:
    return materialize(splits.components(_prepared(spark, d)), "grouped")


def _split(spark: SparkSession, d: str) -> DataFrame:
    g = _grouped(spark, d)
    return g.join(splits.greedy_split(g).select("component", "split"), "component")


def boilerplate_freq(spark: SparkSession, d: str) -> DataFrame:
    return pairs.sentence_frequency(_read(spark, d))


def boilerplate_top25(spark: SparkSession, d: str) -> DataFrame:
    return pairs.top_sentences(pairs.sentence_frequency(_read(spark, d)), THRESHOLD)


def boilerplate_strip(spark: SparkSession, d: str) -> DataFrame:
    return pairs.strip_boilerplate(_read(spark, d), THRESHOLD).select("_row", "positive", "fell_back", "removed")


def boilerplate_report(spark: SparkSession, d: str) -> DataFrame:
    return pairs.boilerplate_report(pairs.strip_boilerplate(_read(spark, d), THRESHOLD))


def stable_hash_sample(spark: SparkSession, d: str) -> DataFrame:
    """The sampling operator: of the distinct questions the 50 of the least seeded hash."""
    q = _read(spark, d).select(T.norm(F.col("query")).alias("query_norm")).distinct()
    return q.select("query_norm", T.sha1_seeded(F.col("query_norm"), 42).alias("hash")).orderBy("hash", "query_norm").limit(50)


def row_uid(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d).select("_row", T.row_uid(T.norm(F.col("query")), T.norm(F.col("positive"))).alias("row_uid"))


def exact_pair_dedup(spark: SparkSession, d: str) -> DataFrame:
    return pairs.prepare(table(spark, d, "pairs"), THRESHOLD).select("_row", "query", "positive", "row_uid")


def pair_counts(spark: SparkSession, d: str) -> DataFrame:
    return pairs.counts(table(spark, d, "pairs"), _read(spark, d), _prepared(spark, d))


def training_rows(spark: SparkSession, d: str) -> DataFrame:
    return pairs.training_rows(_prepared(spark, d))


def training_triplets(spark: SparkSession, d: str) -> DataFrame:
    """Training rows with their mined negative, one for each pair whose texts have letters from a to z."""
    g = _grouped(spark, d)
    mined = materialize(_mine_text(spark, d), "mined")
    passage = g.groupBy("positive_norm").agg(F.min("_row").alias("did"), F.min_by("positive", "_row").alias("negative"))
    negatives = mined.join(g.select(F.col("_row").alias("qid"), "row_uid"), "qid").join(passage, "did").select("row_uid", "negative")
    rows = pairs.training_rows(g.join(mined.select(F.col("qid").alias("_row")), "_row", "left_semi"), negatives)
    return rows.select("row_uid", F.md5(F.concat_ws("\x1e", "anchor", "positive", "negative").cast("binary")).alias("digest"))


def batch_repeats(spark: SparkSession, d: str) -> DataFrame:
    """Texts that stand twice in a batch, with batches by the first hex digit of row_uid."""
    rows = pairs.training_rows(_prepared(spark, d)).withColumn("batch", F.substring("row_uid", 1, 1))
    return pairs.repeats_in_batches(rows, "batch")


def components(spark: SparkSession, d: str) -> DataFrame:
    return _grouped(spark, d).select("_row", "component")


def components_replay(spark: SparkSession, d: str) -> DataFrame:
    return splits.components(_prepared(spark, d), "replay").select("_row", "component")


def component_sizes(spark: SparkSession, d: str) -> DataFrame:
    return splits.sizes(_grouped(spark, d))


def component_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.greedy_split(_grouped(spark, d))


def component_cap(spark: SparkSession, d: str) -> DataFrame:
    """Whole groups up to half of the rows."""
    g = _grouped(spark, d)
    return splits.cap_components(g, g.count() // 2)


def split_isolation(spark: SparkSession, d: str) -> DataFrame:
    return splits.isolation(_split(spark, d))


# ---------------------------------------------------------------- conversations


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return chat.clean(table(spark, d, "messages"))


def _conversations(spark: SparkSession, d: str) -> DataFrame:
    return chat.assemble(_clean(spark, d))


def conv_rejects(spark: SparkSession, d: str) -> DataFrame:
    return chat.rejects(_clean(spark, d))


def conv_messages(spark: SparkSession, d: str) -> DataFrame:
    return _conversations(spark, d).select("conversation_id", "first_row", F.size("messages").alias("n_messages"), "digest")


def conv_language_set(spark: SparkSession, d: str) -> DataFrame:
    return _conversations(spark, d).select("conversation_id", "language")


def conv_dedup(spark: SparkSession, d: str) -> DataFrame:
    return chat.dedup(_conversations(spark, d)).select("conversation_id", "digest")


def conv_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.ordered_split(chat.dedup(_conversations(spark, d)).select("conversation_id", "digest"), "digest").select("conversation_id", "position", "split")


def conv_leakage(spark: SparkSession, d: str) -> DataFrame:
    """Conversations that two of today's assigned splits share, by their content and by their id."""
    s = table(spark, d, "split_assignments").select(T.label(F.col("conversation_id")).alias("conversation_id"), F.lower(T.label(F.col("split_name"))).alias("split")).filter("split <> ''").distinct()
    return splits.isolation(_conversations(spark, d).join(s, "conversation_id").select("split", "digest", "conversation_id"), ("digest", "conversation_id"))


def conv_split_checked(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each split of the conversation split, once no conversation or content stands in two of them."""
    x = materialize(splits.ordered_split(chat.dedup(_conversations(spark, d)).select("conversation_id", "digest"), "digest"), "split")
    return splits.require_isolated(x, ("conversation_id", "digest")).groupBy("split").agg(F.count("*").alias("conversations"))


def generation_sample(spark: SparkSession, d: str) -> DataFrame:
    """The sampling operator: the first eight held-out conversations, rendered for a model to go on from."""
    c = chat.dedup(_conversations(spark, d))
    s = splits.ordered_split(c.select("conversation_id", "digest"), "digest").filter("split = 'validation'").select("conversation_id", "position")
    out = chat.generation_sample(c.join(s, "conversation_id"), "position", 8)
    return out.select("conversation_id", F.md5(F.col("rendered").cast("binary")).alias("rendered"), F.md5(F.col("expected").cast("binary")).alias("expected"))


def loss_rows(spark: SparkSession, d: str) -> DataFrame:
    """The sampling operator: the first 50 validation pairs, over which a loss is evaluated."""
    return pairs.head(_split(spark, d).filter("split = 'validation'"), 50).select("_row", "row_uid")


def _labelled(spark: SparkSession, d: str, longest: int | None = None) -> DataFrame:
    return chat.labelled(_conversations(spark, d), longest)


def _sums(x: DataFrame, *keys: str) -> DataFrame:
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda s, v: s + v)
    return x.select(*keys, F.size("input_ids").alias("n_tokens"), total("input_ids").alias("sum_ids"), F.size(F.filter("labels", lambda v: v != chat.MASKED)).alias("n_labels"), total("labels").alias("sum_labels"))


def assistant_labels(spark: SparkSession, d: str) -> DataFrame:
    return _sums(_labelled(spark, d), "conversation_id")


def label_truncation(spark: SparkSession, d: str) -> DataFrame:
    """The newest 512 tokens of each conversation that keeps a label among them, whoever has the last turn."""
    return _sums(chat.labelled(_conversations(spark, d), 512, strict=False), "conversation_id")


def collate_padding(spark: SparkSession, d: str) -> DataFrame:
    """Batches by the first two hex digits of the conversation's hash."""
    x = _labelled(spark, d).withColumn("batch", F.substring(F.sha1(F.col("conversation_id").cast("binary")), 1, 2))
    p = chat.collate(x, "batch")
    return _sums(p, "batch", "conversation_id").join(p.select("conversation_id", F.aggregate("attention_mask", F.lit(0), lambda s, v: s + v).alias("n_attended")), "conversation_id")


def generation_prompts(spark: SparkSession, d: str) -> DataFrame:
    p = chat.prompts(_conversations(spark, d))
    return p.select("conversation_id", F.size("prompt").alias("n_prompt"), F.md5(F.coalesce("last_prompt", F.lit("")).cast("binary")).alias("last_digest"), F.md5(F.col("expected").cast("binary")).alias("expected_digest"))


# ---------------------------------------------------------------- vectors


def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "embeddings")
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("v"))
    return q, e.select(F.col("vec_id").alias("did"), F.col("embedding").alias("v"))


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def dim_truncate(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    cols = [F.struct(F.lit(n).alias("dim"), vectors.truncate(F.col("embedding"), n).alias("v")) for n in DIMS]
    x = e.select("vec_id", F.explode(F.array(*cols)).alias("x")).select("vec_id", "x.*")
    return x.select("vec_id", "dim", F.round(F.col("v")[0], 6).alias("first"), F.round(vectors.dot(F.col("v"), F.col("v")), 6).alias("length"))


def knn_top10(spark: SparkSession, d: str) -> DataFrame:
    return _r6(vectors.knn(*_vectors(spark, d), 10), "score")


def knn_dims(spark: SparkSession, d: str) -> DataFrame:
    return _r6(vectors.knn_dims(*_vectors(spark, d), DIMS, 10), "score")


def knn_index_recall(spark: SparkSession, d: str) -> DataFrame:
    """Whether the approximate index finds nine tenths of the exact ten nearest, with as many lists as its sample says that takes."""
    q, c = _vectors(spark, d)
    index = vectors.InvertedLists(c)
    return vectors.recall(index.search(q, 10, index.probes_for(0.99)), vectors.knn(q, c, 10)).select("exact", (F.col("recall") >= 0.9).alias("reached"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Hits of every dimension against the three nearest vectors at full length, one row per dimension and query."""
    q, c = _vectors(spark, d)
    top = materialize(vectors.knn_dims(q, c, DIMS, 100), "top")
    rel = top.filter("dim = 64 AND rank <= 3").select("qid", "did")
    return materialize(evaluate.per_query(top, rel, ("dim",)), "judged")


IR = ("accuracy_1", "accuracy_5", "accuracy_10", "recall_1", "recall_5", "recall_10", "mrr_10", "ndcg_10")


def ir_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _r6(evaluate.metrics(_judged(spark, d).filter("dim = 32")).select("queries", *IR), *IR)


def ir_metrics_by_dim(spark: SparkSession, d: str) -> DataFrame:
    return _r6(evaluate.metrics(_judged(spark, d), ("dim",)).select("dim", "queries", *IR), *IR)


def ir_extended(spark: SparkSession, d: str) -> DataFrame:
    more = ("precision_1", "precision_5", "precision_10", "map_100")
    return _r6(evaluate.metrics(_judged(spark, d), ("dim",)).select("dim", *more), *more)


def calibration(spark: SparkSession, d: str) -> DataFrame:
    cols = ("threshold", "precision", "coverage", "f1")
    return _r6(evaluate.calibration(_judged(spark, d), "dim"), *cols)


def calibration_targets(spark: SparkSession, d: str) -> DataFrame:
    return _r6(evaluate.targets(evaluate.calibration(_judged(spark, d), "dim"), "dim"), "threshold", "precision", "coverage")


# ---------------------------------------------------------------- negatives


def _mine_near(spark: SparkSession, d: str) -> DataFrame:
    """Anchor i, its passage the nearest other vector, groups by label, 16 candidates; vectors have no texts, so no Jaccard guard."""
    q, c = _vectors(spark, d)
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("did"), F.col("label").alias("component"), F.col("embedding").alias("v"))
    near = materialize(vectors.knn(q, c, 16), "near")
    pos = near.filter("rank = 1").select("qid", F.col("did").alias("pos_id"), F.col("score").alias("pos_score"))
    anchors = pos.join(e.select(F.col("did").alias("qid"), "component", "v"), "qid")
    return mining.mine(anchors, near, e, max_jaccard=None)


def _mine_label(spark: SparkSession, d: str) -> DataFrame:
    """Anchor i, its passage the next vector of its label (around the circle), so that most anchors take the fallback."""
    q, c = _vectors(spark, d)
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("did"), F.col("label").alias("component"), F.col("embedding").alias("v"))
    lowest = e.groupBy("component").agg(F.min("did").alias("lowest"))
    nxt = e.select("did", "component", F.lead("did").over(W.partitionBy("component").orderBy("did")).alias("later")).join(lowest, "component")
    nxt = nxt.select(F.col("did").alias("qid"), "component", F.coalesce("later", "lowest").alias("pos_id")).filter("pos_id <> qid")
    anchors = q.join(nxt, "qid").join(e.select(F.col("did").alias("pos_id"), F.col("v").alias("w")), "pos_id").select("qid", "component", "pos_id", "v", vectors.dot(F.col("v"), F.col("w")).alias("pos_score"))
    return mining.mine(anchors, vectors.knn(q, c, 16), e, max_jaccard=None)


def _letters(norm: Column) -> Column:
    """A stand-in for an encoder: the letters a to z of a text, counted and scaled to unit length."""
    n = [(F.length(norm) - F.length(F.replace(norm, F.lit(x), F.lit("")))).cast("double") for x in "abcdefghijklmnopqrstuvwxyz"]
    length = F.sqrt(sum((c * c for c in n), F.lit(0.0)))
    return F.when(length > 0, F.array(*(c / length for c in n)))


def _mine_text(spark: SparkSession, d: str) -> DataFrame:
    """The prepared pairs themselves: anchors are the questions, the corpus the passages, each once; the Jaccard guard is on."""
    g = _grouped(spark, d)
    c = g.groupBy("positive_norm", "component").agg(F.min("_row").alias("did")).withColumn("v", _letters(F.col("positive_norm"))).filter("v IS NOT NULL")
    c = materialize(c.withColumnRenamed("positive_norm", "norm"), "passages")
    q = g.select(F.col("_row").alias("qid"), "component", F.col("positive_norm").alias("pos_norm"), _letters(F.col("query_norm")).alias("v")).filter("v IS NOT NULL")
    anchors = q.join(c.select(F.col("norm").alias("pos_norm"), F.col("did").alias("pos_id"), F.col("v").alias("w")), "pos_norm")
    anchors = materialize(anchors.select("qid", "component", "pos_norm", "pos_id", "v", vectors.dot(F.col("v"), F.col("w")).alias("pos_score")), "anchors")
    # scores are compared at six digits, so that equal letters are equal scores
    near = vectors.knn(anchors.select("qid", "v"), c.select("did", "v"), 64, exclude_self=False).withColumn("score", F.round("score", 6))
    return mining.mine(anchors.withColumn("pos_score", F.round("pos_score", 6)), vectors.ranked(near.drop("rank"), 16), c)


def hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    return _r6(_mine_near(spark, d), "margin")


def hard_negatives_fallback(spark: SparkSession, d: str) -> DataFrame:
    return _r6(_mine_label(spark, d), "margin")


def hard_negatives_text(spark: SparkSession, d: str) -> DataFrame:
    return _r6(_mine_text(spark, d), "margin")


def hard_negative_margins(spark: SparkSession, d: str) -> DataFrame:
    return _r6(mining.margins(_mine_near(spark, d)), "mean_margin", "median_margin")


def hard_negative_margins_fallback(spark: SparkSession, d: str) -> DataFrame:
    return _r6(mining.margins(_mine_label(spark, d)), "mean_margin", "median_margin")


# ---------------------------------------------------------------- evaluation tables


def _bundle(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """With the caps of the reference's smoke profile, 200 queries and 1,000 passages, as the SQL has them (vm: 1,000 and 5,000; full: 2,000 and 10,000)."""
    s = materialize(_split(spark, d), "split")
    return evaluate.bundle(s.filter("split = 'validation'"), s, 42, 200, 1000)


def eval_queries(spark: SparkSession, d: str) -> DataFrame:
    return _bundle(spark, d)[0]


def eval_corpus(spark: SparkSession, d: str) -> DataFrame:
    return _bundle(spark, d)[1]


def eval_qrels(spark: SparkSession, d: str) -> DataFrame:
    return _bundle(spark, d)[2]


def select_winner(spark: SparkSession, d: str) -> DataFrame:
    """The cut vectors compete by their ranking score; full length stands for the base, which has to be beaten by nothing."""
    m = evaluate.metrics(_judged(spark, d), ("dim",))
    name = F.when(F.col("dim") == 64, "base").otherwise(F.concat(F.lit("dim"), F.col("dim").cast("string")))
    return _r6(evaluate.choose(m.select(name.alias("name"), (-F.col("dim")).alias("ordinal"), F.col("ndcg_10").alias("score"))), "score")


def perplexity(spark: SparkSession, d: str) -> DataFrame:
    """Of one less the mean first component, standing in for a loss, per label."""
    m = table(spark, d, "embeddings").groupBy("label").agg(F.avg(1 - F.col("embedding")[0].cast("double")).alias("loss"))
    return m.select("label", F.round(evaluate.perplexity(F.col("loss")), 6).alias("perplexity"))


QUERIES = {
    f.__name__: f
    for f in (
        visible_text, norm_text, nonempty_docs, sentences, run_tokens, token_jaccard, boilerplate_freq, boilerplate_top25, boilerplate_strip, boilerplate_report,
        stable_hash_sample, row_uid, exact_pair_dedup, pair_counts, training_rows, training_triplets, batch_repeats, components, components_replay, component_sizes, component_split, component_cap, split_isolation,
        conv_rejects, conv_messages, conv_language_set, conv_dedup, conv_split, conv_split_checked, conv_leakage, generation_sample, assistant_labels, label_truncation, collate_padding, generation_prompts,
        dim_truncate, knn_top10, knn_dims, knn_index_recall, ir_metrics, ir_metrics_by_dim, ir_extended, calibration, calibration_targets,
        hard_negatives, hard_negatives_fallback, hard_negatives_text, hard_negative_margins, hard_negative_margins_fallback, loss_rows, eval_queries, eval_corpus, eval_qrels, select_winner, perplexity,
    )
}
