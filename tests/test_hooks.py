import pytest
from pyspark.sql import functions as F

from textloom.operators import chat, hooks


def test_embed(spark):
    def encoder():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(1, "abc"), (2, "abc"), (3, None), (4, "")], "id long, text string")
    assert {r.id: r.vector for r in hooks.embed(df, "id", "text", encoder, 1).collect()} == {1: [3.0, 1.0], 2: [3.0, 1.0], 3: None, 4: [0.0, 1.0]}


def test_labels_by_an_external_template(spark):
    def tokenizer():
        return lambda text: [(ord(c), i, i + 1) for i, c in enumerate(text)]

    def template():
        return hooks.around_assistant(lambda messages: "".join(f"<{m['role']}>{m['content']}</>" for m in messages))

    talk = [("user", "hi"), ("assistant", "ok 😀"), ("user", "more"), ("assistant", "")]
    df = spark.createDataFrame([("c", talk)], "conversation_id string, messages array<struct<role:string,content:string>>")
    r = hooks.render(df, template)
    t = hooks.tokenize(r, "conversation_id", "text", tokenizer).join(r, "conversation_id")
    got = t.select(chat.mask(F.col("tokens"), F.col("spans")).alias("labels")).first().labels
    assert "".join(chr(x) for x in got if x != chat.MASKED) == "ok 😀"
    with pytest.raises(ValueError, match="mark"):
        template()([{"role": "user", "content": "\U000f0001"}])
