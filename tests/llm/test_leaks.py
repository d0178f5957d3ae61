import pytest
import random

from textloom.functions.words import words
from textloom.llm import leaks


def passages(n=12, seed=3):
    r = random.Random(seed)
    vocab = ["the", "of", "a", "keeper", "refused", "to", "weigh"] + [f"w{k}x" for k in range(60)]
    return [(100 + i, " ".join(r.choice(vocab) for _ in range(r.choice([20, 24, 40, 70])))) for i in range(n)]


def brute(text, items):
    t = words(leaks.plain(text))
    out = set()
    for item, p in items:
        s = words(leaks.plain(p))
        for i in range(len(s) - leaks.RUN + 1):
            for j in range(len(t) - leaks.RUN + 1):
                if sum(a != b for a, b in zip(s[i : i + leaks.RUN], t[j : j + leaks.RUN], strict=True)) <= leaks.REPLACED:
                    out.add(item)
    return sorted(out)


def test_against_brute_force():
    items, r = passages(), random.Random(9)
    search = leaks.Searcher(items)
    for k in range(150):
        ws = words(r.choice(items)[1])
        a = r.randrange(max(1, len(ws) - 20))
        part = ws[a : a + r.choice([20, 23, 24, 25, 30, 60])]
        for _ in range(r.randrange(5)):
            part[r.randrange(len(part))] = "other"
        noise = [r.choice(["filler", "the", "of", "w3x"]) for _ in range(r.randrange(12))]
        text = " ".join(noise + part + noise[::-1])
        assert search.search(text) == brute(text, items), k


def test_form_is_disregarded(spark):
    p = " ".join(f"word{k}" for k in range(30))
    forms = [
        p.upper(), p.replace(" ", "\n> "), "  ".join(f"**{w}**" if k % 3 else f"<b>{w}</b>" for k, w in enumerate(p.split())), p.replace(" ", "&nbsp;"), p.replace("word", "wo​rd"), "“" + p.replace(" ", ", ") + "”",
        p.replace("word7", "wo-\nrd7"), p.replace("word", "ｗｏｒｄ"),
    ]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate([*forms, None, "", p[:100], "x " * 50_000 + p])], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(1, p), (2, None), (3, "short one"), (4, p)], "item_id long, passage string")
    got = sorted((r.doc_id, r.item_id) for r in leaks.find(docs, items).collect())
    assert got == sorted((i, k) for i in [*range(len(forms)), 11] for k in (1, 4))
    assert leaks.find(docs.limit(0), items).count() == 0 and leaks.find(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("gap", ["<!-- " + "note " * 3000 + "-->", f'<b class="{"x" * 5000}">', f"</b><!---->", "<!-- never closed "])
def test_long_markup_inside_a_passage(gap):
    passage = " ".join(f"word{i}" for i in range(40))
    text = " ".join(f"word{i}" for i in range(20)) + f" {gap} " + " ".join(f"word{i}" for i in range(20, 40))
    found = leaks.Searcher([(1, passage)]).search(text)
    assert found == ([] if "never" in gap else [1])


def test_suite_in_parts(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(20)], "item_id long, passage string")
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(25)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.find(docs, items, part=6).collect()}
    assert got == {(i, i) for i in range(20)}
