import pyarrow.parquet as pq
import pytest

from textloom.llm import langid, pairs

DATA = "/root/testdata/sf0.001"
SCHEMA = "msg_id long, conversation_id string, turn_index string, role string, content string, words string, tail string"
Q = "Could you explain how task timer is billed on the Meadow plan? I use it with a slow connection."
A = "The Meadow plan does include task timer. First, open the panel and save the change. Nothing is deleted during these steps."


@pytest.fixture(scope="module")
def model():
    t = pq.read_table(f"{DATA}/lang_samples.parquet").to_pandas()
    return langid.train(list(zip(t.lang_code, t.sample_text, strict=True)))


def run(spark, model, rows):
    df = spark.createDataFrame([(i, *r, "clash", "clash") for i, r in enumerate(rows)], SCHEMA)
    return {(r.conversation_id, r.turn_index): r.defects for r in pairs.defects(df, model).collect()}


def pair(c, a, q=Q):
    return [(c, "1", "user", q), (c, "2", "assistant", a)]


def test_defects(spark, model):
    spanish = "Hay dos ajustes distintos. Primero, compare los dos importes y guarde el cambio. Luego abra el panel."
    cases = {
        "good": (A, None), "blank": (" 　", ["empty"]), "null": (None, ["empty"]), "filler": ("N/A", ["empty"]),
        "comma": (A + " Then open the panel,", ["truncated"]), "word": (A + " Then open the", ["truncated"]), "fence": (A + "\n```\nset a = 1", ["truncated"]), "item": (A + "\n1. open the panel and save the change\n2. open the", ["truncated"]),
        "bracket": (A + " Then open (", ["truncated"]), "code": (A + "\n```\nset a = 1\n```", None), "thanks": ("Glad to hear it.", None),
        "refusal": ("I'm sorry, but I can't help with that. Please ask about something else.", ["refusal"]), "helps": ("I can't see your screen, but the steps below clear it. " + A, None), "german": ("Diese Frage darf ich nicht beantworten.", None),
        "copy": ('> "' + Q.upper() + '"', ["copy"]), "twice": (f"{Q} {Q}", ["copy"]), "part": ("Re: Could you explain how task timer is billed on the Meadow plan?", ["copy"]), "other": (spanish, ["other_language"]), "list": ("Do this.\n1. open the panel and save the change\n2. check it and save the change", None),
    }
    rows = [r for c, (a, _) in cases.items() for r in pair(c, a)]
    rows += pair("asked", spanish, Q + " Please answer in Spanish.") + [(f"end{k}", "1", "assistant", "1. open the panel and save the change\n2. wait") for k in range(3)]
    got = run(spark, model, rows)
    want = {(c, 2): d for c, (_, d) in cases.items() if d}
    want["german", 2] = ["refusal", "other_language"]
    assert got == want


def test_which_rows_are_a_pair(spark, model):
    rows = [
        ("runs", "1", "user", Q), ("runs", "2", "user", "And one more thing."), ("runs", "3", "assistant", ""), ("runs", "4", "assistant", "-"), ("runs", "5", "user", ""), ("runs", "6", "assistant", ""),
        ("joined", "1", "user", Q), ("joined", "2", "assistant", ""), ("joined", "3", "assistant", A),
        ("odd", "1", "user", Q), ("odd", "x", "assistant", ""), ("between", "1", "user", Q), ("between", "2", "system", "s"), ("between", "3", "assistant", ""),
        (None, "1", "user", Q), (None, "2", "assistant", ""), ("first", "1", "assistant", ""), ("first", "2", "user", Q),
        ("far", "4095", "user", Q), ("far", "4096", "assistant", ""), ("far", "-257", "user", Q), ("far", "-256", "assistant", "null"), ("repeat", "1", "user", Q), ("repeat", "2", "assistant", ""), ("repeat", "2", "assistant", None), ("repeat", "1", "user", Q),
    ]
    assert run(spark, model, rows) == {("runs", 3): ["empty"], ("far", 4096): ["empty"], ("far", -256): ["empty"], ("repeat", 2): ["empty"]}
    assert run(spark, model, []) == {}


def test_refusals():
    cut = langid.split_sentences
    for t in ("I must decline to answer this.", "Lo siento, no puedo ayudarle con eso.", "Je n'ai pas le droit de répondre à cette question.", "Darüber möchte ich lieber nicht sprechen.", "இதற்கு என்னால் உதவ முடியாது.", "इसमें मैं मदद नहीं कर सकता।", "Sorry, இந்த request-க்கு என்னால் help பண்ண முடியாது."):
        assert pairs.declines(t, cut(t)), t
    for t in ("It is not possible to skip it, although it can be cleared.", "Do not close the window.", "No se ha perdido nada.", A):
        assert not pairs.declines(t, cut(t)), t


def test_endings_by_share(spark, model):
    """A sentence must end at the last words often enough: deliveries and the size of the table change nothing."""
    cut = A + " Then wait for the green lamp"
    runs_on = [x for k in range(8) for x in pair(f"on{k}", f"Wait for the green lamp of panel {'abcdefgh'[k]}. Nothing is deleted during these steps.")]
    ends = pair("ends", "Now look for the green lamp. Nothing is deleted during these steps.")
    assert run(spark, model, [*pair("cut", cut), *runs_on]) == {("cut", 2): ["truncated"]}
    assert run(spark, model, [*pair("cut", cut), *runs_on, *ends]) == {("cut", 2): ["truncated"]}
    assert run(spark, model, [*pair("cut", cut), *runs_on, *ends[1:] * 5, *ends]) in ({}, {("cut", 2): ["truncated"]})
    many = [x for k in range(4) for x in pair(f"e{k}", "Now look for the green lamp. Nothing is deleted during these steps.")]
    assert run(spark, model, [*pair("cut", cut), *runs_on, *many]) == {}


@pytest.mark.parametrize("text", ["You can reset the password by opening the", "You can reset the password. Then open the menu and cho", "Open the panel (the one on the left. Then save the change.", 'The page says "nothing to save. Then it closes.', "Siehe „Konto und Tarif. Danach speichern Sie.", "Voir « le compte. Puis enregistrez."])
def test_cut_off(spark, model, text):
    assert "truncated" in run(spark, model, pair("c", text)).get(("c", 2), [])


@pytest.mark.parametrize("text", ["Open the panel (on the left).", 'It says "done".', "A 5\" screen is enough :(", "„Konto“ und «compte» und »Tarif«.", "a) open it. b) save it.", "It [really] works {so} (they say)."])
def test_closed(text):
    assert not pairs.unclosed(text)


def test_long_refusals_and_short_copies(spark, model):
    long = " ".join(["I'm sorry.", "I can't help with that.", "I understand that this is disappointing for you and for all of your colleagues in every one of the branches."] * 6)
    assert run(spark, model, [*pair("long", long), *pair("short", "Task timer?", "task timer"), *pair("other", "Task timer.", "What is it?")]) == {("long", 2): ["refusal"], ("short", 2): ["copy"]}


def test_long_conversations_and_runs(spark, model):
    rows = [("c", str(k), ("user", "assistant")[(k // 300) % 2], A if k % 7 else "") for k in range(0, 9000, 1)]
    want = []
    got = run(spark, model, rows)
    assert [x for x in got if got[x] == ["empty"]] == want
    rows = [("g", "10", "user", Q), ("g", "9000", "assistant", ""), ("g", "20000", "user", Q), ("g", "30000", "user", ""), ("g", "40000", "assistant", "n/a")]
    assert run(spark, model, rows) == {("g", 9000): ["empty"], ("g", 40000): ["empty"]}
