import pytest
from pyspark.sql import functions as F

from textloom.llm import budget, encoding, labels, vocab

TEXTS = [
    "", None, " ", "Hello world", "it's  we'll\n\n\tI'd 'tis", "a\x1cb\x85c d e　　f ", "தமிழ் எழுத்து", "<|endoftext|> 12 345", "é é 日本語テスト 한국어", "😀👩‍💻", "x" * 50_000, "\x00\x01",
    "Straße ΣΑΣ ½ ² ٣", "   leading", "trailing   ", "\n \n", "﻿bom", "don’t",
]


@pytest.fixture(scope="module")
def reference():
    return vocab.encoding(vocab.read_ranks())


def documents(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "doc_id long, text string, block string, ids string")


def test_splitter_is_the_pattern():
    import regex

    want = regex.compile(vocab.PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(r"\s", r"\p{White_Space}").replace(r"(?!\S)", r"(?!\P{White_Space})").replace(r"\S", r"\P{White_Space}"))
    for t in TEXTS:
        assert vocab.splitter()(t or "") == want.findall(t or "")


def test_encode(spark, reference):
    got = {r.doc_id: r.ids for r in encoding.encode(documents(spark)).collect()}
    assert got == {i: reference.encode_ordinary(t) if t else [] for i, t in enumerate(TEXTS)}


def test_small_blocks(spark, reference, monkeypatch):
    monkeypatch.setattr(encoding, "BLOCK_CHARS", 10)
    texts = [f"word {i % 7} and {'more ' * (i % 5)}" for i in range(50)]
    got = {r.doc_id: r.ids for r in encoding.encode(documents(spark, texts).repartition(3)).collect()}
    assert got == {i: reference.encode_ordinary(t) for i, t in enumerate(texts)}


def test_round_trip(spark):
    got = {r.doc_id: r.text for r in encoding.decode(encoding.encode(documents(spark))).collect()}
    assert got == {i: t or "" for i, t in enumerate(TEXTS)}
    with pytest.raises(Exception, match="outside"):
        encoding.decode(spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>")).collect()


def test_repeated_and_empty(spark):
    twice = documents(spark, ["a b"]).union(documents(spark, ["a b"])).union(spark.createDataFrame([(None, "a b", "", "")], documents(spark).schema))
    assert [r.ids for r in encoding.encode(twice).collect()] == [[64, 275]] * 3
    assert encoding.encode(documents(spark, [])).count() == 0


def test_budget(spark, reference):
    rows = [
        (1, "c", "1", "user", "Hello world", "en", "s1"), (2, "c ", "01", "User", "Hello world ", "EN", "s1"), (3, "c", "2", "assistant", "Hello world", "en", "s1"), (4, "d", "1", "user", "Hello world", None, None),
        (5, None, "1", "user", "lost", "ta", "s1"), (6, None, "1", "user", "lost", "ta", "s1"), (7, "d", "2", "user", None, "fr-CA", "s1"), (8, "c", "x", "user", "odd", "en", "s1"),
    ]
    m = spark.createDataFrame([(*r, "clash") for r in rows], "msg_id long, conversation_id string, turn_index string, role string, content string, language string, source_name string, h string")
    t = spark.createDataFrame([("c", "billing"), ("c", None), ("d", None)], "conversation_id string, domain_code string")
    got = {(r.source_name, r.language, r.domain_code): (r.messages, r.texts, r.tokens, r.distinct_tokens) for r in budget.message_budget(m, t, labels.canonical(F.col("language"))).collect()}
    n = lambda x: len(reference.encode_ordinary(x))
    assert got == {("s1", "en", "billing"): (3, 2, 2 * n("Hello world") + n("odd"), n("Hello world") + n("odd")), (None, None, None): (1, 1, n("Hello world"), n("Hello world")), ("s1", "ta", None): (2, 1, 2 * n("lost"), n("lost")), ("s1", "fr", None): (1, 1, 0, 0)}
    assert budget.message_budget(m.limit(0), t, labels.canonical(F.col("language"))).count() == 0


def test_labels(spark):
    want = {"en": "en", " EN-us": "en", "English": "en", "ta_IN": "ta", "Ta-En": "ta-en", "ta_en ": "ta-en", "tamil": "ta", "deu": "de", "de-AT": "de", "??": None, "und": None, "": None, "klingon": None, "Español": "es"}
    df = spark.createDataFrame([(k,) for k in want] + [(None,)], "l string")
    assert {r.l: r.c for r in df.select("l", labels.canonical(F.col("l")).alias("c")).collect()} == {**want, None: None}
