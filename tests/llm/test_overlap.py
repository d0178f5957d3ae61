import itertools
import random
from collections import Counter

import numpy as np
import pytest

from textloom.functions.words import lcs_length, words
from textloom.llm import overlap


def shared(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.fixture(scope="module")
def records():
    r = random.Random(8)
    vocab = [f"w{i}" for i in range(400)]
    stock = [" ".join(r.choice(vocab) for _ in range(14)) for _ in range(6)]
    out = []

    def text(n):
        return " ".join(r.choice(stock) if r.random() < 0.05 else r.choice(vocab) for _ in range(n))

    def changed(t, share):
        ws = []
        for w in t.split():
            x = r.random()
            if x < share / 3:
                continue
            ws.append(r.choice(vocab) if x < 2 * share / 3 else w)
            if x > 1 - share / 3:
                ws.append(r.choice(vocab))
        return " ".join(ws)

    base = [text(n) for n in (8, 20, 60, 90, 150, 300, 700, 1500) for _ in range(3)]
    for k, t in enumerate(base):
        out.append((f"t{k:03d}", 1, t))
        for share in (0, 0.05, 0.12, 0.19, 0.5):
            out.append((f"h{k:03d}_{share}", 2, changed(t, share).upper() + "!"))
    out += [("t900", 1, base[5]), ("t901", 1, base[5].replace(" ", ",  ")), ("n1", 1, None), ("n2", 2, ""), ("n3", 1, "?!"), ("n4", 2, "?!"), ("both", 1, "only here"), ("both", 2, "only here")]
    return out


def test_against_all_pairs(spark, records):
    df = spark.createDataFrame(records, "id string, side int, text string")
    got = {(r.id_a, r.id_b) for r in overlap.cross_split_pairs(df).collect()}
    ws = {(i, s): words(t or "") for i, s, t in records}
    want = set()
    for (i, s), a in ws.items():
        for (j, t), b in ws.items():
            if s == 1 and t == 2 and i != j and a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and shared(a, b) >= 0.8 * max(len(a), len(b)):
                want.add((min(i, j), max(i, j)))
    assert got == want


def test_many_near_copies_keep_all_links(spark):
    r = random.Random(4)
    base = [f"w{r.randrange(300)}" for _ in range(120)]
    rows = []
    for k in range(60):
        ws = base[:]
        ws[k] = f"x{k}"
        rows.append((f"r{k:02d}", 1 if k % 2 else 2, " ".join(ws)))
    got = overlap.cross_split_pairs(spark.createDataFrame(rows, "id string, side int, text string"))
    assert got.count() == 30 * 30


def test_empty(spark):
    assert overlap.cross_split_pairs(spark.createDataFrame([], "id string, side int, text string")).count() == 0


def test_conversation_texts(spark):
    rows = [(1, "c", "2", "assistant", " b "), (2, "c", "1", "USER", "a"), (3, "c", "1", "user", "a"), (4, "c", "0", "system", "s"), (5, "c", "x", "user", "late"), (6, None, "1", "user", "q"), (7, "d", "1", "system", "s"), (8, "e", "1", "user", None)]
    got = overlap.conversation_texts(spark.createDataFrame(rows, "msg_id long, conversation_id string, turn_index string, role string, content string")).collect()
    assert [(r.conversation_id, r.text) for r in got] == [("c", "a\nb\nlate")]


def _zipf(r, n):
    return r.choices([f"w{i}" for i in range(3000)], [1 / (i + 5) for i in range(3000)], k=n)


def _pattern(r, name, t):
    new = {"known": lambda: _zipf(r, 1)[0], "new": lambda: f"x{r.randrange(10**12)}"}[name.split()[1]]
    u, kind = t[:], name.split()[0]
    for i in range(r.randrange(int(kind)), len(t), int(kind)) if kind.isdigit() else r.sample(range(len(t)), int(0.195 * len(t))):
        u[i] = new()
    return u


def test_edits_everywhere(spark):
    """Every eighth and every fifth word replaced, and 19.5 % at random, by words of the vocabulary or new ones: none is lost."""
    r = random.Random(3)
    rows, want = [], set()
    for name, n, _ in itertools.product(("8 known", "8 new", "5 known", "5 new", "any known", "any new"), (20, 80, 150, 300, 700, 1500), range(5)):
        t = _zipf(r, n)
        u, k = _pattern(r, name, t), len(want)
        if lcs_length([hash(w) for w in t], [hash(w) for w in u]) >= 0.8 * n:
            rows += [(f"t{k}", 1, " ".join(t)), (f"h{k}", 2, " ".join(u))]
            want.add((f"h{k}", f"t{k}"))
    got = {(x.id_a, x.id_b) for x in overlap.cross_split_pairs(spark.createDataFrame(rows, "id string, side int, text string")).collect()}
    assert len(want) > 150 and want <= got


def test_coverage_and_classes(spark):
    r = random.Random(6)
    t, v = _zipf(r, 60), _zipf(r, 50)
    rows = [("t1", 1, " ".join(t)), ("h1", 2, " ".join([*t[:20], "new", *t[21:]])), ("h2", 2, " ".join(t)), ("h3", 2, " ".join(_zipf(r, 40))), ("t2", 1, " ".join(v)), ("both", 1, "only here now"), ("both", 2, "only here now"), ("none", 2, None)]
    df = spark.createDataFrame(rows, "id string, side int, text string")
    got = {x.id: (x.n, x.covered, round(x.share, 3)) for x in overlap.coverage(df).collect()}
    assert got == {"h1": (60, 59, round(59 / 60, 3)), "h2": (60, 60, 1.0)}
    classes = {x.id: (x.class_id, x.twins) for x in overlap.classes(df).collect()}
    assert set(classes) == {"t1", "h1", "h2", "h3", "t2", "both"}
    assert classes["t1"][0] == classes["h1"][0] == classes["h2"][0] != classes["t2"][0] and classes["t1"][1] == 2 and classes["h3"][1] == 0 == classes["t2"][1]
    assert overlap.coverage(df.limit(0)).count() == overlap.classes(df.limit(0)).count() == 0


def test_spans_are_maximal():
    assert overlap.shared_spans([1, 2, 3, 4, 5, 9, 6, 7, 8, 9], [0, 6, 7, 8, 9, 1, 2, 3, 4, 5, 6]) == [(0, 5), (6, 10)]
    assert overlap.shared_spans([1, 2, 3], [1, 2, 3]) == [] == overlap.shared_spans([], [])
    assert overlap.shared_spans([1, 1, 1, 1, 1, 1], [1, 1, 1, 1]) == [(0, 4)]


def test_large_class_in_cells(spark, monkeypatch):
    monkeypatch.setattr(overlap, "CELL", 8)
    test_many_near_copies_keep_all_links(spark)


def test_pairs_in_a_crowd_of_the_same_words(spark):
    """Thirty pairs to a topic, all of one topic of the same words in other orders, edited so that no run of five is left: every pair is found, and no other."""
    r = random.Random(12)
    rows = []
    for k in range(180):
        t = [f"w{i}" for i in range(60)] + [f"topic{k // 30}x{i}" for i in range(12)]
        r.shuffle(t)
        new = lambda: f"w{r.randrange(60)}"
        if k % 2:
            u = [new() if i % 5 == 4 else w for i, w in enumerate(t)]
        else:  # extra words, at different places of either side
            core = t
            t = [x for i, w in enumerate(core) for x in ((w, new()) if i % 4 == 1 else (w,))]
            u = [x for i, w in enumerate(core) for x in ((w, new()) if i % 4 == 3 else (w,))]
        rows += [(f"t{k}", 1, " ".join(t)), (f"h{k}", 2, " ".join(u))]
    got = {(x.id_a, x.id_b) for x in overlap.cross_split_pairs(spark.createDataFrame(rows, "id string, side int, text string")).collect()}
    assert got == {(f"h{k}", f"t{k}") for k in range(180)}


@pytest.mark.parametrize("n", [3, 60, 130, 400])
def test_bits_rule_out_no_pair(n):
    """Texts of lengths about ``n``, whose bits may have different widths: whatever shares enough words stays."""
    r = random.Random(n)
    sides = [[], []]
    for k in range(160):
        t = [r.randrange(2 * n) for _ in range(n + k % max(2, n // 4))]
        for side in sides:
            side.append([r.randrange(2 * n) if r.random() < 0.08 else w for w in t if r.random() < 0.97])
    train, held = (sorted((np.array(t, np.uint32) for t in side if t), key=len) for side in sides)
    bits = [overlap._matrices(overlap._bits([t.tobytes() for t in side])) for side in (train, held)]
    width = min(x.shape[1] for side in bits for x in side)
    x, y = (overlap._folded(side, width) for side in bits)
    lens = [np.array([len(t) for t in side]) for side in (train, held)]
    got = {(int(j), int(i)) for a, b in overlap._possible(lens[0], np.ascontiguousarray(x.T), lens[1], y) for i, j in zip(a, b, strict=True)}
    want = {(j, i) for (j, t), (i, u) in itertools.product(enumerate(train), enumerate(held)) if 5 * (Counter(t.tolist()) & Counter(u.tolist())).total() >= 4 * max(len(t), len(u))}
    assert want and want <= got and len(got) < len(train) * len(held) / 4
