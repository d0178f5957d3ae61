import hashlib
import json

import pytest
from pyspark.sql import functions as F

from textloom.operators import chat

COLS = "msg_id long, conversation_id string, turn_index string, role string, content string, language string, turn string, m string"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "clash", "clash") for i, r in enumerate(rows)], COLS)


GOOD = [("c1", "0", "System", "Be\n\"nice\"\t\\ \x01 ü", "en"), (" c1", "2", "assistant ", " Hi ", "ta"), ("c1", "+1", "user", "Hello", "en"), ("c1", "3", "user", "  ", "en")]


def test_assembly_and_digest(spark):
    got = chat.assemble(chat.clean(frame(spark, GOOD))).first()
    want = [{"role": "system", "content": "Be\n\"nice\"\t\\ \x01 ü"}, {"role": "user", "content": "Hello"}, {"role": "assistant", "content": "Hi"}]
    assert [m.asDict() for m in got.messages] == want and got.language == "en,ta" and got.first_row == 0
    assert got.digest == hashlib.sha256(("0\0" + json.dumps(want, ensure_ascii=False, sort_keys=True)).encode()).hexdigest()


def test_rejects(spark):
    rows = [
        ("a", "1.0", "user", "x", ""), ("a", "2", "assistant", "y", ""),
        ("b", "1", "user", "x", ""), ("b", "1", "assistant", "y", ""),
        ("c", "1", "user", "x", ""), ("c", "2", "assistant", "", ""),
        ("d", "1", "user", "x", ""), ("d", "2", "system", "y", ""), ("d", "3", "assistant", "y", ""),
        ("e", "1", "bot", "x", ""), ("e", "2", "user", "x", ""), ("e", "3", "assistant", "x", ""),
        (None, "1", "user", "x", ""), ("f", None, None, None, None),
    ]
    df = chat.clean(frame(spark, rows + [("g", *r[1:]) for r in GOOD]))
    assert {(r.conversation_id, r.reason) for r in chat.rejects(df).collect()} == {("a", "bad_turn"), ("b", "duplicate_turn"), ("c", "missing_role"), ("d", "late_system"), ("e", "bad_role")}
    assert [r.conversation_id for r in chat.assemble(df).collect()] == ["g"]
    with pytest.raises(Exception, match="bad_turn|duplicate_turn|missing_role|late_system|bad_role"):
        chat.assemble(df, strict=True).collect()
    with pytest.raises(ValueError, match="content"):
        chat.clean(df.drop("content").withColumnRenamed("_row", "msg_id"))
    assert chat.assemble(chat.clean(frame(spark, []))).count() == 0


def test_first_of_equal_conversations(spark):
    rows = [("z", "1", "user", "q", ""), ("z", "2", "assistant", "a", ""), ("b", "5", "user", "q", ""), ("b", "6", "assistant", "a", "")]
    assert [r.conversation_id for r in chat.dedup(chat.assemble(chat.clean(frame(spark, rows)))).collect()] == ["z"]


@pytest.fixture(scope="module")
def talk(spark):
    said = [("system", "Be useful."), ("user", "First question"), ("assistant", "First answer"), ("user", "Second question"), ("assistant", "Second answer 😀")]
    return chat.assemble(chat.clean(frame(spark, [("t", str(i), r, c, "en") for i, (r, c) in enumerate(said)])))


def test_only_assistant_text_is_labelled(talk):
    r = chat.labelled(talk).first()
    assert len(r.input_ids) == len(r.labels)
    assert "".join(map(chr, r.input_ids)).startswith("<|im_start|>system\nBe useful.<|im_end|>\n")
    assert "".join(chr(x) for x in r.labels if x != chat.MASKED) == "First answerSecond answer 😀"
    assert all(x in (y, chat.MASKED) for x, y in zip(r.labels, r.input_ids, strict=True))


def test_truncation(talk):
    whole = chat.labelled(talk).first()
    assert chat.labelled(talk, 4096).first().labels == whole.labels
    assert chat.labelled(talk, 20).first().labels == whole.labels[-20:]
    with pytest.raises(Exception, match="no assistant token"):
        chat.labelled(talk, 5).collect()


def test_padding(talk, spark):
    short = spark.createDataFrame([("s", [7, 8], [-100, 8])], "conversation_id string, input_ids array<int>, labels array<int>")
    both = chat.labelled(talk).unionByName(short).withColumn("batch", F.lit(1))
    got = {r.conversation_id: r for r in chat.collate(both, "batch", pad_id=9).collect()}
    n = len(got["t"].input_ids)
    assert got["s"].input_ids == [7, 8] + [9] * (n - 2) and got["s"].labels == [-100, 8] + [-100] * (n - 2) and got["s"].attention_mask == [1, 1] + [0] * (n - 2)


def test_prompts(talk, spark):
    r = chat.prompts(talk).first()
    assert len(r.prompt) == 4 and r.last_prompt == "Second question" and r.expected == "Second answer 😀"
    alone = spark.createDataFrame([("x", [("assistant", "hi")]), ("y", [("user", "hi")])], "conversation_id string, messages array<struct<role:string,content:string>>")
    got = chat.prompts(alone).collect()
    assert [(r.conversation_id, r.prompt, r.last_prompt, r.expected) for r in got] == [("x", [], None, "hi")]


def test_truncation_keeps_whoever_has_the_last_turn(spark):
    said = [("user_last", ["user", "assistant", "user"], 9), ("assistant_last", ["user", "assistant"], 9), ("cut_away", ["user", "assistant", "user"], 600)]
    rows = [(c, [(r, "x" * n if k == 2 else "hello") for k, r in enumerate(roles)]) for c, roles, n in said]
    talks = spark.createDataFrame(rows, "conversation_id string, messages array<struct<role:string,content:string>>")
    got = chat.labelled(talks, 512, strict=False).collect()
    assert {r.conversation_id for r in got} == {"user_last", "assistant_last"}
    assert all("".join(chr(x) for x in r.labels if x != chat.MASKED) == "hello" for r in got)


def test_label_truncation_query_has_conversations_that_end_otherwise(spark, monkeypatch):
    from textloom.plans import reference

    talks = spark.createDataFrame([("c", [("user", "a"), ("assistant", "b"), ("user", "c")])], "conversation_id string, messages array<struct<role:string,content:string>>")
    monkeypatch.setattr(reference, "_conversations", lambda s, d: talks)
    assert [(r.conversation_id, r.n_labels) for r in reference.label_truncation(spark, "").collect()] == [("c", 1)]


def test_strict_numbers_and_nothing_left(spark):
    kind = "msg_id long, conversation_id string, turn_index string, role string, content string, language string"
    rows = [(1, "c", "1", "user", "a", None), (2, "c", "1.0", "user", "", None)]
    assert chat.clean(spark.createDataFrame(rows, kind)).count() == 1
    with pytest.raises(Exception, match="no whole number in row 2"):
        chat.clean(spark.createDataFrame(rows, kind), strict=True).collect()
    with pytest.raises(ValueError, match="remains"):
        chat.clean(spark.createDataFrame([(1, "c", "1", "user", " ", None)], kind), strict=True)


def test_generation_prompt(spark):
    m = spark.createDataFrame([("c", [("user", "Hello"), ("assistant", "Hi")], 1), ("d", [("user", "x")], 0)], "conversation_id string, messages array<struct<role:string,content:string>>, position int")
    got = chat.generation_sample(m, "position", 5).collect()
    assert [(r.conversation_id, r.rendered, r.expected) for r in got] == [("c", f"{chat.OPEN}user\nHello{chat.CLOSE}{chat.OPEN}assistant\n{chat.THINK}", "Hi")]
