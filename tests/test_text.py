import hashlib
import re

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.words import lcs_length, words

TEXTS = ["", " ", "a", "  A b　c\x1cd\te\n", "ΣΑΣ x", "İstanbul", "Straße ẞ", "தமிழ் எழுத்து one_two 3", "N/A", "null", "x" * 40_000 + ". Yes! No?  Maybe", "a b b", "tab\tnew\r\nline\x1f", "é é"]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "i int, t string")


def column(frame, expr):
    return [r[0] for r in frame.orderBy("i").select(expr).collect()]


def test_white_space_as_python_has_it(frame):
    assert column(frame, T.visible(F.col("t"))) == [*(" ".join(t.split()) for t in TEXTS), None]
    assert column(frame, T.strip(F.col("t"))) == [*(t.strip() for t in TEXTS), None]
    assert column(frame, T.label(F.lit("\x00 a\x00b "))) == ["a b"] * (len(TEXTS) + 1)


def test_lower_case(frame):
    assert column(frame, T.norm(F.col("t"))) == [*(" ".join(t.split()).lower() for t in TEXTS), None]


def test_sentences(frame):
    want = [[s for s in re.split(r"(?<=[.!?])\s+", " ".join(t.split())) if s] for t in TEXTS]
    assert column(frame, T.sentences(F.col("t"))) == [*want, None]


def test_tokens_and_jaccard(frame, spark):
    got = column(frame, T.tokens(F.col("t")))
    assert [set(g) for g in got[:-1]] == [set(re.findall(r"\w+", t.lower())) for t in TEXTS]
    pairs = [("a b b", "b c", 1 / 3), ("", "a", 0.0), (None, "a", 0.0), ("A", "a", 1.0)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string").orderBy("i")
    assert [r[0] for r in df.select(T.token_jaccard(F.col("a"), F.col("b"))).collect()] == pytest.approx([w for *_, w in pairs])


def test_hashes(frame):
    assert column(frame, T.sha1_seeded(F.col("t"), 42))[:-1] == [hashlib.sha1(f"42\0{t}".encode()).hexdigest() for t in TEXTS]
    assert column(frame, T.sha256_seeded(F.col("t")))[:-1] == [hashlib.sha256(f"0\0{t}".encode()).hexdigest() for t in TEXTS]


def test_whole_numbers_and_accounts(spark):
    rows = [("1", 1), (" +007\t", 7), ("-3", -3), ("--1", None), ("1.0", None), ("", None), (None, None), ("9" * 30, None), ("٣", None), ("1b", None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "i int, t string")
    assert column(df, T.whole_number(F.col("t"))) == [w for _, w in rows]
    same = ["acct-00000042", " ACCT_00000042", "acct 00000042 ", "Acct00000042"]
    none = [None, "", "-", "n/a", "GUEST", "anonymous", "0", "unknown"]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(same + none)], "i int, t string")
    got = column(df, T.account(F.col("t")))
    assert len(set(got[:4])) == 1 and got[0] and set(got[4:]) == {None}


def test_run_token_and_prefix(spark):
    df = spark.range(1)
    assert df.select(T.run_token(F.lit("--a b/c..")), T.run_token(F.lit("x" * 99), 48), T.common_prefix_length(F.array(F.lit(1), F.lit(2)), F.array(F.lit(1), F.lit(3))), T.common_prefix_length(F.array(F.lit(1)), F.array(F.lit(1), F.lit(3)))).first()[:] == ("a-b-c", "x" * 48, 1, 1)


def test_words_disregard_form():
    assert words("Ｆｕｌｌ-width é​ COLD!") == words("full width é cold") == ["full", "width", "é", "cold"]
    assert words("தமிழ் சொல்") == ["தமிழ்", "சொல்"]


def test_common_subsequence():
    assert lcs_length([1, 2, 3, 4], [2, 4, 5]) == 2 and lcs_length([], [1]) == 0 and lcs_length([1] * 5, [1] * 3) == 3
