import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import evaluate, mining, vectors


@pytest.fixture(scope="module")
def table(spark):
    x = np.random.default_rng(1).normal(size=(300, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[7] = x[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "did long, v array<float>")
    return x.astype(np.float64), df


def exact(x, q, k):
    s = x @ x[q]
    order = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-s[i], i))[:k]
    return [(r + 1, i, pytest.approx(s[i])) for r, i in enumerate(order)]


@pytest.mark.parametrize("blocks", [(4096, 65536), (3, 40)])
def test_exact_neighbours(table, blocks):
    x, df = table
    got = vectors.knn(df.filter("did % 50 = 0").withColumnRenamed("did", "qid"), df, 10, True, *blocks).collect()
    for q in range(0, 300, 50):
        assert sorted((r["rank"], r.did, r.score) for r in got if r.qid == q) == exact(x, q, 10)


def test_ties_by_id(table, spark):
    x, df = table
    got = vectors.knn(df.filter("did = 0").withColumnRenamed("did", "qid"), df.filter("did IN (3, 7)"), 2).orderBy("rank").collect()
    assert [r.did for r in got] == [3, 7]
    assert vectors.knn(df.filter("did < 0").withColumnRenamed("did", "qid"), df, 3).count() == 0


def test_truncation(table):
    x, df = table
    got = np.array(df.filter("v IS NOT NULL").orderBy("did").select(vectors.truncate(F.col("v"), 5)).toPandas().iloc[:, 0].tolist())
    want = x[:, :5] / np.linalg.norm(x[:, :5], axis=1, keepdims=True)
    assert np.allclose(got, want)
    d = vectors.knn_dims(df.filter("did = 1").withColumnRenamed("did", "qid"), df, (16, 5, 32), 3)
    assert {r.dim for r in d.collect()} == {16, 5}


def test_index_recall(table):
    _, df = table
    q = df.filter("did % 10 = 0").withColumnRenamed("did", "qid")
    r = vectors.recall(vectors.InvertedLists(df, lists=8).search(q, 10, 7), vectors.knn(q, df, 10)).first()
    assert r.recall >= 0.9


def test_index_on_clusters(spark):
    """Vectors that cluster: nine tenths of the neighbours from a quarter of the lists, in blocks or not."""
    r = np.random.default_rng(2)
    mid = r.normal(size=(40, 16))
    x = mid[r.integers(0, 40, 1600)] + 0.35 * r.normal(size=(1600, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "did long, v array<double>")
    q = df.filter("did % 40 = 0").withColumnRenamed("did", "qid")
    index = vectors.InvertedLists(df)
    probes = index.probes_for(0.95)
    assert len(index.centres) == 40 and probes <= 10
    exact = vectors.knn(q, df, 10)
    assert vectors.recall(index.search(q, 10, probes), exact).first().recall >= 0.9
    index.blocks = 3
    assert vectors.recall(index.search(q, 10, probes), exact).first().recall >= 0.9


def test_timed_bundle(spark):
    queries = spark.createDataFrame([("q000000", "a"), ("q000001", "b")], "qid string, text string")
    corpus = spark.createDataFrame([("d000000", "a"), ("d000001", "b"), ("d000002", "c")], "did string, text string")
    qrels = spark.createDataFrame([("q000000", "d000000"), ("q000001", "d000001")], "qid string, did string")
    at = F.create_map(*(F.lit(v) for k, v in (("a", "1,0"), ("b", "0,1"), ("c", "-1,0")) for v in (k, v)))
    encode = lambda df: df.select("key", F.transform(F.split(at[F.col("text")], ","), lambda x: x.cast("double")))
    got = {r.dim: r for r in evaluate.timed((queries, corpus, qrels), encode, (2, 1), 10).collect()}
    assert got[2].accuracy_1 == 1.0 and got[2].queries == 2 and min(got[2].encoding_seconds, got[2].search_seconds, got[2].evaluation_seconds, got[2].search_ms_per_query) > 0


def test_metrics(spark):
    top = spark.createDataFrame([(1, 1, 10, 0.9), (1, 2, 11, 0.8), (1, 3, 12, 0.7), (2, 1, 11, 0.5), (2, 2, 10, 0.4)], "qid long, rank int, did long, score double")
    rel = spark.createDataFrame([(1, 11), (1, 12), (1, 99), (2, 77)], "qid long, did long")
    m = evaluate.metrics(evaluate.per_query(top, rel)).first()
    dcg = 1 / np.log2(3) + 1 / np.log2(4)
    ideal = 1 + 1 / np.log2(3) + 1 / np.log2(4)
    assert m.accuracy_1 == 0 and m.accuracy_5 == 0.5 and m.recall_10 == pytest.approx((2 / 3) / 2) and m.mrr_10 == pytest.approx(0.25)
    assert m.ndcg_10 == pytest.approx(dcg / ideal / 2) and m.map_100 == pytest.approx((0.5 + 2 / 3) / 3 / 2)


def test_calibration(spark):
    r = np.random.default_rng(3)
    score = np.concatenate([r.random(57), [0.5, 0.5]])
    ok = r.random(59) < score
    per = spark.createDataFrame([(1, i, 1 if o else None, float(s)) for i, (s, o) in enumerate(zip(score, ok, strict=True))], "dim int, qid long, first_rank int, top_score double")
    got = {x.threshold: (x.precision, x.coverage) for x in evaluate.calibration(per, "dim").collect()}
    grid = np.unique(np.quantile(score, np.linspace(0, 1, 201)))
    assert len(got) == pytest.approx(len(grid), abs=3)
    for t, (p, c) in got.items():
        a = score >= t
        assert c == pytest.approx(a.mean()) and p == pytest.approx(ok[a].mean())
    t = {x.target: x for x in evaluate.targets(evaluate.calibration(per, "dim"), "dim").collect()}
    best = max((c, p) for p, c in got.values() if p >= 0.9) if any(p >= 0.9 for p, _ in got.values()) else None
    assert (t["precision_90"].threshold is None) == (best is None)
    if best:
        assert (t["precision_90"].coverage, t["precision_90"].precision) == best
    same = spark.createDataFrame([(1, i, 1, 0.5) for i in range(4)], "dim int, qid long, first_rank int, top_score double")
    assert evaluate.calibration(same, "dim").count() == 1


def test_winner(spark):
    rows = lambda *x: spark.createDataFrame([(n, i, s) for i, (n, s) in enumerate(x)], "name string, ordinal int, score double")
    pick = lambda *x, **k: evaluate.choose(rows(*x), **k).first().winner
    assert pick(("base", 0.5), ("stage1", 0.6), ("stage2", 0.6)) == "stage1"
    assert pick(("base", 0.7), ("stage1", 0.6)) == "base" and pick(("base", 0.7), ("stage1", 0.6), protect=False) == "stage1"
    assert pick(("base", 0.5), ("stage1", 0.6), min_gain=0.1) == "stage1" and pick(("base", 0.5), ("stage1", None), ("stage2", 0.9)) == "stage2"
    for bad in ([("base", 0.5)], [("stage1", 0.5)], [("base", 0.5), ("stage1", float("nan"))]):
        with pytest.raises(Exception):
            pick(*bad)
    got = spark.createDataFrame([(1.0,), (99.0,), (float("nan"),), (float("inf"),), (None,)], "x double").select(evaluate.perplexity(F.col("x"))).collect()
    assert [r[0] for r in got] == [pytest.approx(np.e), pytest.approx(np.exp(20)), None, None, None]


def test_negatives(spark, tmp_path):
    unit = [1.0, 0.0]
    anchors = spark.createDataFrame([(1, 10, 1, 0.9, "a b", unit), (2, 10, 1, 0.9, "a b", unit), (3, 20, 2, 0.1, "a b", unit)], "qid long, pos_id long, component int, pos_score double, pos_norm string, v array<double>")
    near = spark.createDataFrame([(1, 1, 20, 0.95), (1, 2, 11, 0.8), (1, 3, 21, 0.7), (1, 4, 22, 0.6), (2, 1, 11, 0.5), (3, 1, 10, 0.5)], "qid long, rank int, did long, score double")
    corpus = spark.createDataFrame([(10, 1, "a b", unit), (11, 1, "x", unit), (20, 2, "c", [0.5, 0.5]), (21, 2, "b a", [0.5, 0.5]), (22, 3, "d", [0.5, 0.5])], "did long, component int, norm string, v array<double>")
    got = {r.qid: r for r in mining.mine(anchors, near, corpus).collect()}
    assert (got[1].did, got[1]["mode"]) == (22, "semi_hard") and got[1].margin == pytest.approx(0.3)
    assert got[2]["mode"] == got[3]["mode"] == "random_fallback" and got[2].did in (20, 21, 22) and got[3].did in (10, 11, 22)
    assert got[2].margin == pytest.approx(0.4)
    m = mining.margins(mining.mine(anchors, near, corpus)).first()
    assert (m.rows, m.semi_hard, m.random_fallback) == (3, 1, 2) and m.mean_margin is not None
    # the guard asks for texts, unless it is switched off
    with pytest.raises(ValueError, match="Jaccard"):
        mining.mine(anchors.drop("pos_norm"), near, corpus)
    assert {r.qid: r.did for r in mining.mine(anchors, near, corpus, max_jaccard=None).collect()}[1] == 21
    with pytest.raises(Exception, match="single group"):
        mining.mine(anchors.filter("qid = 2"), near, corpus.filter("component = 1")).collect()
    rows = spark.createDataFrame([("a", "x"), ("b", "x")], "row_uid string, negative string")
    mining.write_negatives(rows, str(tmp_path / "n"), {"seed": 42})
    assert mining.read_negatives(spark, str(tmp_path / "n"), 2).count() == 2
    with pytest.raises(ValueError, match="wanted"):
        mining.read_negatives(spark, str(tmp_path / "n"), 3)
    with pytest.raises(Exception, match="more than one negative"):
        mining.write_negatives(rows.union(rows), str(tmp_path / "twice"), {})


@pytest.mark.parametrize("share", [0.1, 0.6, 0.99])
def test_fallback_draws_widely(spark, share):
    """Against brute force, with one group that holds most passages; the draws spread over the others."""
    import hashlib

    r = np.random.default_rng(5)
    comp = [0 if r.random() < share else 1 + i % 7 for i in range(400)]
    corpus = spark.createDataFrame(list(enumerate(comp)), "did long, component int")
    anchors = spark.createDataFrame([(i, i, comp[i]) for i in range(400)], "qid long, pos_id long, component int")
    got = {x.qid: x.did for x in mining.fallback(anchors, corpus, 42).collect()}
    sha = lambda *x: hashlib.sha1("\0".join(map(str, x)).encode()).hexdigest()
    order = sorted(range(400), key=lambda d: (sha(42, d), d))
    for q in range(400):
        for j in range(mining.DRAWS):
            at = int(sha(42, q, j)[:12], 16) % 400
            pick = next(order[(at + k) % 400] for k in range(400) if comp[order[(at + k) % 400]] != comp[q])
            if pick != q:
                break
        assert got[q] == pick
    if share < 0.5:
        assert len(set(got.values())) > 200
