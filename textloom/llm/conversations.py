"""Rebuilding conversations from message rows: an event log folded by version into final turns, then ordered and judged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.operators import turns

VERSION = ("received_at", "msg_id")
REPLACES = ("edit", "retry", "delete")


def fold_events(ev: DataFrame, version: tuple[str, ...] = VERSION, kind: Column | None = None, content: bool = False) -> DataFrame:
    """The live messages of an event log: conversation_id, turn, h (identity of role and content), role, n_chars[, content].

    Events of equal conversation, number, role and content are deliveries of one message; the one of the highest
    ``version`` stands for it. ``kind`` (create, edit, retry, delete; anything else, null and none at all read as create)
    says what an event does to its turn: a create adds its message, an edit or retry puts it in the place of every lower
    version, a delete leaves nothing of them. So creates alone never hide one another: two different messages under one
    number both live. Of equal versions the greater kind and identity comes later. Numbers that aren't whole are no turn:
    nothing is replaced there. Empty input gives an empty result.
    """
    known = F.lit("create") if kind is None else F.lower(F.trim(F.coalesce(kind, F.lit("create"))))
    v = F.struct(*version, "kind", "h")
    body = ["role", F.length("content").alias("n_chars"), *(["content"] if content else []), "kind"]
    x = ev.withColumn("kind", known).withColumn("h", F.xxhash64("role", "content"))
    one = x.groupBy("conversation_id", "turn", "h").agg(
        F.max_by(F.struct(*body), v).alias("e"), F.max(v).alias("at"), *([] if kind is None else [F.max(F.when(F.col("turn").isNotNull() & F.col("kind").isin(*REPLACES), v)).alias("cut")])
    )
    if kind is not None:
        # deliveries are folded by now, so a turn has one row per different message
        last = F.max("cut").over(W.partitionBy("conversation_id", "turn"))
        one = one.withColumn("last", last).filter((F.col("last").isNull() | (F.col("at") >= F.col("last"))) & (F.col("e.kind") != "delete"))
    return one.select("conversation_id", "turn", "h", "e.role", "e.n_chars", *(["e.content"] if content else []))


def facts(live: DataFrame) -> DataFrame:
    """One row per (conversation, number) of live messages; ``clash``: two different ones."""
    g = live.groupBy("conversation_id", "turn").agg(F.min("h").alias("h0"), F.max("h").alias("h1"), F.max(F.struct("n_chars", "role")).alias("m"))
    return g.select("conversation_id", "turn", (F.col("h0") != F.col("h1")).alias("clash"), "m.n_chars", "m.role")


def _log(messages: DataFrame, kind: str | None) -> tuple[DataFrame, Column | None]:
    """The events of a message table, with what their version is read from."""
    ev = turns.events(messages, *VERSION, *([F.col(kind).cast("string").alias("event_kind")] if kind else []))
    return ev, F.col("event_kind") if kind else None


def dropped(messages: DataFrame, kind: str | None = None) -> DataFrame:
    """conversation_id of every conversation of ``messages`` that isn't kept once its log is folded.

    ``kind`` names the column that says what each row does (see ``fold_events``); a table without one holds creates. A
    conversation whose messages are all deleted is dropped.
    """
    ev, what = _log(messages, kind)
    judged = turns.verdicts(facts(fold_events(ev, kind=what)))
    if what is None:
        return judged.filter(~F.col("kept")).select("conversation_id")
    return ev.select("conversation_id").distinct().join(judged.filter("kept").select("conversation_id"), "conversation_id", "left_anti")


def rebuilt(messages: DataFrame, kind: str | None = None) -> DataFrame:
    """Kept conversations: conversation_id, messages (array of role, content in turn order; rows without content left out).

    A kept conversation has one message a number and numbers without a hole, so its array is as long as its span; broken
    ones, however large, never reach the gathering step.
    """
    ev, what = _log(messages, kind)
    kept = turns.verdicts(facts(fold_events(ev, kind=what))).filter("kept").select("conversation_id")
    live = fold_events(ev.join(kept, "conversation_id", "left_semi"), kind=what, content=True)
    got = live.filter("n_chars > 0").groupBy("conversation_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.struct("role", "content").alias("m")))).alias("x"))
    return got.select("conversation_id", F.transform("x", lambda e: e["m"]).alias("messages"))
