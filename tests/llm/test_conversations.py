import random

import pytest
from pyspark.sql import functions as F

from textloom.llm import conversations
from textloom.operators import turns

SCHEMA = "msg_id long, conversation_id string, turn_index string, role string, content string, received_at timestamp, h string, n_chars string"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, None, "clash", "clash") for i, r in enumerate(rows)], SCHEMA)


def brute(rows):
    """conversation -> kept, by reading the rules row by row."""
    per = {}
    for c, t, r, x in rows:
        c = " ".join((c or "").replace("\0", " ").split())
        if c:
            t = (t or "").strip()
            whole = t.lstrip("+-").isdigit() and t.lstrip("+-").isascii() and len(t) - len(t.lstrip("+-")) <= 1
            per.setdefault(c, set()).add((int(t) if whole else None, (r or "").strip().lower(), (x or "").strip()))
    out = {}
    for c, ms in per.items():
        numbers = [t for t, *_ in ms]
        ok = None not in numbers and len(set(numbers)) == len(numbers) and max(numbers) - min(numbers) + 1 == len(numbers)
        if ok:
            said = [(r, x) for _, r, x in sorted(ms) if x]
            roles = [r for r, _ in said]
            ok = all(r in turns.ROLES for r in roles) and "system" not in roles[1:] and "user" in roles and "assistant" in roles
            ok = ok and all(r != "user" or (k + 1 < len(roles) and roles[k + 1] in ("user", "assistant")) for k, r in enumerate(roles))
        out[c] = ok
    return out


def random_rows(seed):
    r = random.Random(seed)
    rows = []
    for c in range(60):
        n = r.randrange(1, 7)
        for t in range(n):
            role = ("user", "assistant")[t % 2] if r.random() < 0.85 else r.choice(["system", "user", "assistant", "tool", None, "User ", "ASSISTANT\n"])
            if t == 0 and r.random() < 0.3:
                role = "system"
            text = r.choice(["hello", " hi ", "", None, "　", "bye"]) if r.random() < 0.3 else f"text {t}"
            number = str(t) if r.random() < 0.93 else r.choice(["x", "1.0", f"+{t}", f"00{t}", f" {t}\t", "", None, str(t + 2)])
            row = (f"c{c}", number, role, text)
            rows += [row] * (2 if r.random() < 0.2 else 1)
    rows += [(None, "1", "user", "x"), (" \x1c\0", "1", "user", "x"), ("\xa0c1 ", "0", "user", "text 0")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_the_rules(spark, seed):
    rows = random_rows(seed)
    want = brute(rows)
    assert {r.conversation_id for r in conversations.dropped(frame(spark, rows)).collect()} == {c for c, ok in want.items() if not ok}
    got = {r.conversation_id: [(m.role, m.content) for m in r.messages] for r in conversations.rebuilt(frame(spark, rows)).collect()}
    assert set(got) == {c for c, ok in want.items() if ok}
    assert all(x for ms in got.values() for _, x in ms)


LOG = "msg_id long, conversation_id string, turn_index string, role string, content string, received_at timestamp, what string"


def log(spark, rows):
    """Rows (conversation, number, version, kind, role, content), in any order."""
    from datetime import datetime, timedelta

    at = datetime(2031, 1, 1)
    return spark.createDataFrame([(i, c, n, r, x, at + timedelta(minutes=v), k) for i, (c, n, v, k, r, x) in enumerate(rows)], LOG)


def test_event_log(spark):
    rows = [("c", 1, 1, "create", "user", "a"), ("c", 1, 3, "edit", "user", "abc"), ("c", 2, 2, None, "assistant", "b"), ("c", 3, 1, "create", "user", "x"), ("c", 3, 2, "delete", "user", None), ("c", 2, 9, "retry", "assistant", "bb")]
    ev = spark.createDataFrame(rows, "conversation_id string, turn long, v int, kind string, role string, content string").withColumn("content", F.coalesce("content", F.lit("")))
    got = sorted((r.turn, r.role, r.n_chars, r.clash) for r in conversations.facts(conversations.fold_events(ev, ("v",), F.col("kind"))).collect())
    assert got == [(1, "user", 3, False), (2, "assistant", 2, False)]


@pytest.mark.parametrize("seed", range(3))
def test_edits_and_deletes_in_any_order(spark, seed):
    rows = [
        # an edit that arrives first, a reply that was retried, a turn that was deleted for good: kept
        ("ok", "1", 5, "edit", "user", "asked better"), ("ok", "1", 1, "create", "user", "asked"), ("ok", "2", 9, "retry", "assistant", "second answer"), ("ok", "2", 2, "create", "assistant", "first answer"), ("ok", "3", 3, None, "user", "gone"), ("ok", "3", 4, "DELETE ", "user", None),
        # two creates under one number clash, however late
        ("clash", "1", 1, "create", "user", "a"), ("clash", "2", 2, "create", "assistant", "b"), ("clash", "2", 3, "create", "assistant", "c"),
        # the same clash, settled by an edit
        ("settled", "1", 1, "create", "user", "a"), ("settled", "2", 2, "create", "assistant", "b"), ("settled", "2", 3, "create", "assistant", "c"), ("settled", "2", 4, "edit", "assistant", "d"),
        # a deleted turn leaves a hole; what comes back after a delete lives
        ("hole", "1", 1, "create", "user", "a"), ("hole", "2", 2, "create", "assistant", "b"), ("hole", "3", 1, "create", "user", "q"), ("hole", "4", 1, "create", "assistant", "r"), ("hole", "2", 8, "delete", "assistant", ""),
        ("back", "1", 1, "create", "user", "a"), ("back", "2", 2, "create", "assistant", "b"), ("back", "2", 3, "delete", "assistant", ""), ("back", "2", 4, "create", "assistant", "b"),
        ("all gone", "1", 1, "create", "user", "a"), ("all gone", "1", 2, "delete", "user", ""),
    ]
    random.Random(seed).shuffle(rows)
    df = log(spark, rows)
    assert {r.conversation_id for r in conversations.dropped(df, "what").collect()} == {"clash", "hole", "all gone"}
    got = {r.conversation_id: [m.content for m in r.messages] for r in conversations.rebuilt(df, "what").collect()}
    assert got == {"ok": ["asked better", "second answer"], "settled": ["a", "d"], "back": ["a", "b"]}


def test_empty_and_long(spark):
    assert conversations.dropped(frame(spark, [])).count() == conversations.rebuilt(frame(spark, [])).count() == 0
    long = [("c", str(2**40 + k), ("user", "assistant")[k % 2], "x" * 100_000) for k in range(4)] + [("d", "9" * 25, "user", "x")]
    assert {r.conversation_id for r in conversations.dropped(frame(spark, long)).collect()} == {"d"}
