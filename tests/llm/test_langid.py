import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from textloom.llm import labels, langid

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def samples():
    t = pq.read_table(f"{DATA}/lang_samples.parquet").to_pandas()
    return list(zip(t.lang_code, t.sample_text, strict=True))


@pytest.fixture(scope="module")
def model(samples):
    return langid.train(samples)


def test_held_out_accuracy_and_calibration(samples):
    ordered = sorted(samples)
    held = [s for k, s in enumerate(ordered) if k % 5 == 0]
    m = langid.train([s for k, s in enumerate(ordered) if k % 5])
    tokens = [[t for s in langid.split_sentences(x) for t in langid.sentence_tokens(s)] for _, x in held]
    label, conf = m.predict(tokens)
    right = [m.classes[k] == lang for k, (lang, _) in zip(label, held, strict=True)]
    assert sum(right) / len(right) >= 0.95
    assert abs(conf.mean() - sum(right) / len(right)) < 0.1
    assert (m.weights != 0).mean() < 1 and m.temperature > 0


def test_segments(model, samples):
    of = {lang: [x for y, x in samples if y == lang] for lang, _ in samples}
    text = f"{of['en'][2]} {of['en'][3]}\n{of['ta'][0]} {of['de'][1]} Q-1234. 7.\n\n```\nset a = 1\n```"
    got = langid.segments(model, [text, None, "", "7. Q-1", "12:30:11 INFO a=b took=3ms", of["fr"][0]])
    assert [s[0] for s in got[0]] == ["en", "ta", "de"] and all(0 < c <= 1 for _, c, _ in got[0])
    assert got[1:5] == [[], [], [], []] and [s[0] for s in got[5]] == ["fr"]


def test_fillers():
    for t in ("", "  ", "N/A", "n/a.", "null", "(blank)", "…", "--", "[no response]", "{}", "None"):
        assert langid.is_filler(t), t
    for t in ("No", "Glad to hear it.", "5", "நன்றி", "x = 3"):
        assert not langid.is_filler(t), t


def test_cases(spark, model, samples):
    of = {lang: [x for y, x in samples if y == lang] for lang, _ in samples}
    rows = [(1, of["en"][0], " EN-us"), (2, of["en"][0], "de"), (3, of["ta"][0], None), (4, f"{of['es'][0]} {of['hi'][0]}", "es"), (5, None, None), (6, "???", "fr"), (7, of["ta-en"][0], "ta_en"), (2, of["en"][0], "de")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "msg_id long, content string, language string, seg_no string")
    got = sorted((r.id, r.seg_no, r.lang_code) for r in langid.label_cases(langid.label_segments(model, df, "msg_id", "content", labels.canonical(F.col("language")))).collect())
    assert got == [(2, 1, "en"), (2, 1, "en"), (3, 1, "ta"), (4, 1, "es"), (4, 2, "hi")]
    assert langid.label_segments(model, df.limit(0), "msg_id", "content", F.col("language")).count() == 0


def test_everyday_wording_is_bounded(spark, samples):
    clean = spark.createDataFrame(samples, "lang_code string, sample_text string")
    extra = spark.createDataFrame([("en", f"You answer questions about the shared calendar of the team. Please do it in a friendly way. Leave out links, number {i}.", "system") for i in range(500)] + [("xx", "?", "user"), ("en", None, None)], "lang_code string, text string, stratum string")
    m = langid.fit(clean, extra, per_stratum=20)
    k, _ = m.predict([["leave", "out", "links"]])
    assert m.classes[k[0]] == "en"


def test_company_settles_what_looks_foreign():
    """A short English wording that a model of clean samples takes for French, in texts whose labels name any language."""
    t = pq.read_table(f"{DATA}/lang_samples.parquet").to_pandas()
    clean = list(zip(t.lang_code, t.sample_text, strict=True))
    first = langid.train(clean)
    odd = "Keep answers patient."
    lead = ("You answer questions about the desk.", "Reply in the language of the question.", "Number the steps when there are several.")
    rows = [(lang, f"{lead[k % 3]} {odd} {lead[(k + 1) % 3]}") for k, lang in enumerate(["es", "de", "fr", "hi", "ta", "en", "es", "de", "hi"])] + [("fr", odd)]
    taught = langid.agreeing(first, rows)
    assert {lang for lang, s in taught if s == odd} <= {"en"} and all(lang == "en" for lang, s in taught if s in lead)
    model = langid._trained(clean, sorted(rows))
    tokens = langid.sentence_tokens(odd)
    assert model.classes[model.predict([tokens])[0][0]] == "en"
    assert langid.agreeing(first, []) == [] and langid.agreeing(first, [("xx", odd), ("en", None), ("en", "")]) == []
