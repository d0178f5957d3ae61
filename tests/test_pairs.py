from pyspark.sql import functions as F

from textloom.operators import pairs

SCHEMA = "pair_row long, query string, positive string, _row string, h string"


def frame(spark, rows):
    return spark.createDataFrame([(i, q, p, "clash", "clash") for i, (q, p) in enumerate(rows)], SCHEMA)


def test_boilerplate(spark):
    rows = [("q1", "Call us. The key is red."), ("q2", "Call us. Call us. It is blue."), ("q3", "CALL US."), ("q4", ""), (None, "x"), ("NA", "null. Call us."), ("q7", "call  us. 5")]
    got = {r._row: r for r in pairs.strip_boilerplate(pairs.read(frame(spark, rows)), 4).collect()}
    assert {k: v.positive for k, v in got.items()} == {0: "The key is red.", 1: "It is blue.", 2: "CALL US.", 5: "null.", 6: "5"}
    assert got[2].fell_back and got[2].removed == 0 and got[1].removed == 2
    freq = {r.sentence: r.rows for r in pairs.sentence_frequency(pairs.read(frame(spark, rows))).collect()}
    assert freq["call us."] == 5
    report = pairs.boilerplate_report(pairs.strip_boilerplate(pairs.read(frame(spark, rows)), 4)).first()
    assert report[:] == (5, 4, 5, 1)


def test_idempotent_without_frequent_sentences(spark):
    rows = [(f"q{i}", f"One {i}. Two {i}! Three {i}?") for i in range(20)]
    once = pairs.strip_boilerplate(pairs.read(frame(spark, rows)), 2)
    assert once.filter(F.col("positive") != F.col("positive_original")).count() == 0


def test_dedup_keeps_the_first(spark):
    rows = [("A", "x y"), ("a ", "X y"), ("b", "x y"), ("A", "z")]
    got = sorted((r._row, r.query, r.positive) for r in pairs.prepare(frame(spark, rows)).collect())
    assert got == [(0, "A", "x y"), (2, "b", "x y"), (3, "A", "z")]


def test_empty_table(spark):
    empty = frame(spark, [])
    assert pairs.prepare(empty).count() == 0
    assert pairs.counts(empty, pairs.read(empty), pairs.prepare(empty)).first()[:] == (0, 0, 0, 0, 0, 0)


def test_training_rows_need_one_negative(spark):
    import pytest

    p = pairs.prepare(frame(spark, [("a", "b"), ("c", "d")]))
    neg = p.select("row_uid", F.lit("n").alias("negative"))
    assert {r.negative for r in pairs.training_rows(p, neg).collect()} == {"passage: n"}
    with pytest.raises(Exception, match="exactly one negative"):
        pairs.training_rows(p, neg.limit(1)).collect()


def test_one_negative_each(spark):
    import pytest

    p = spark.createDataFrame([("a", "q", "p"), ("b", "q2", "p2")], "row_uid string, query string, positive string")
    neg = lambda *rows: spark.createDataFrame(list(rows), "row_uid string, negative string")
    got = {r.row_uid: r.negative for r in pairs.training_rows(p, neg(("a", "x"), ("b", "y"))).collect()}
    assert got == {"a": "passage: x", "b": "passage: y"}
    for rows, bad in ((p, neg(("a", "x"))), (p, neg(("a", "x"), ("a", "x"), ("b", "y"))), (p, neg(("a", None), ("b", "y"))), (p.union(p), neg(("a", "x"), ("b", "y")))):
        with pytest.raises(Exception, match="exactly one negative|pairs: not one row"):
            pairs.training_rows(rows, bad).collect()
    rows = spark.createDataFrame([(1, "a", "b"), (1, "c", "b"), (2, "b", "a")], "batch int, anchor string, positive string")
    assert [tuple(r) for r in pairs.repeats_in_batches(rows, "batch").collect()] == [(1, "b", 2)]
    assert [r._row for r in pairs.head(spark.createDataFrame([(3,), (1,), (2,)], "_row long"), 2).collect()] == [1, 2]
