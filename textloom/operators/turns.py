"""Message rows as turns of conversations, judged by aggregates that combine before every shuffle.

No conversation is ever gathered into one task: rows fold into one fact per (conversation, number), facts into one
verdict per conversation, and both folds are plain hash aggregates, so an id that holds a third of all rows costs no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T

ROLES = ("system", "user", "assistant")


def events(messages: DataFrame, *keep: str) -> DataFrame:
    """conversation_id, turn (bigint; null: not whole), role, content and the columns ``keep``.

    Rows whose id is null or empty after collapsing belong to no conversation and are left out. A null role or content
    reads as an empty one. A whole number beyond bigint counts as not whole.
    """
    out = messages.select(
        T.label(F.col("conversation_id")).alias("conversation_id"),
        T.whole_number(F.col("turn_index")).alias("turn"),
        F.lower(T.label(F.coalesce(F.col("role"), F.lit("")))).alias("role"),
        T.strip(F.coalesce(F.col("content"), F.lit(""))).alias("content"),
        *keep,
    )
    return out.filter(F.col("conversation_id") != "")


def turn_facts(ev: DataFrame) -> DataFrame:
    """One row per (conversation, number). Equal role and content are one message; ``clash``: two different messages."""
    h = F.xxhash64("role", "content")
    n = F.length("content")
    return (
        ev.select("conversation_id", "turn", "role", h.alias("h"), n.alias("n"))
        .groupBy("conversation_id", "turn")
        .agg(F.min("h").alias("h0"), F.max("h").alias("h1"), F.max(F.struct("n", "role")).alias("m"))
        .select("conversation_id", "turn", (F.col("h0") != F.col("h1")).alias("clash"), F.col("m.n").alias("n_chars"), F.col("m.role").alias("role"))
    )


def verdicts(facts: DataFrame) -> DataFrame:
    """One row per conversation: one flag per way to be broken, ``kept``, number of messages with content, their characters."""
    t, r, full = F.col("turn"), F.col("role"), F.col("n_chars") > 0
    wide = "decimal(20,0)"
    g = facts.groupBy("conversation_id").agg(
        F.bool_or(t.isNull()).alias("bad_number"),
        F.bool_or("clash").alias("clash"),
        (F.max(t).cast(wide) - F.min(t).cast(wide) + 1 != F.count(t)).alias("hole"),
        F.bool_or(full & ~r.isin(*ROLES)).alias("bad_role"),
        F.min(F.when(full, t)).alias("first"),
        F.max(F.when(full & (r == "system"), t)).alias("last_system"),
        F.bool_or(full & (r == "user")).alias("has_user"),
        F.bool_or(full & (r == "assistant")).alias("has_assistant"),
        F.max(F.when(full, F.struct("turn", "role"))).alias("last"),
        F.sum(full.cast("bigint")).alias("n_messages"),
        F.sum(F.col("n_chars").cast("bigint")).alias("n_chars"),
    )
    # once no system message stands behind the first, a run of users can only lack its answer at the end
    out = g.select(
        "conversation_id", "bad_number", "clash", F.coalesce("hole", F.lit(True)).alias("hole"), "bad_role",
        F.coalesce(F.col("last_system") > F.col("first"), F.lit(False)).alias("late_system"),
        (~F.col("has_user") | ~F.col("has_assistant")).alias("one_sided"),
        F.coalesce(F.col("last.role") == "user", F.lit(False)).alias("unanswered"),
        "n_messages", "n_chars",
    )
    return out.withColumn("kept", ~(F.col("bad_number") | F.col("clash") | F.col("hole") | F.col("bad_role") | F.col("late_system") | F.col("one_sided") | F.col("unanswered")))
