import json
import os
import zipfile

import pytest

from textloom.sources import config, files, host, runs


def test_csv(spark, tmp_path):
    p = tmp_path / "data.csv"
    p.write_text('query,extra,positive\n"a ""b"" c",x,"line one\nline two"\nNA,,null\n123,y,""\n', encoding="utf-8")
    got = files.read_pairs(spark, str(p)).orderBy("pair_row").collect()
    assert [(r.pair_row, r.query, r.positive) for r in got] == [(0, 'a "b" c', "line one\nline two"), (1, "NA", "null"), (2, "123", "")]
    with pytest.raises(ValueError, match="content"):
        files.read_messages(spark, str(p))
    m = tmp_path / "m.csv"
    m.write_text('conversation_id,turn_index,role,content,language\nc,1,user,"hi\nthere",en\n', encoding="utf-8")
    assert files.read_messages(spark, str(m)).first().content == "hi\nthere"


def test_archive_and_discovery(tmp_path):
    with zipfile.ZipFile(tmp_path / "dataset.zip", "w") as z:
        z.writestr("a.csv", "x")
        z.writestr("in/B.CSV", "longer")
        z.writestr("c.txt", "longest of all")
    staged = tmp_path / "staged"
    assert open(files.discover(str(tmp_path), staged=str(staged))).read() == "longer"
    with pytest.raises(ValueError, match="archive"):
        files.discover(str(tmp_path))
    # a data file beside the archive is read as it is, and never replaced by what an archive holds
    (tmp_path / "data.csv").write_text("mine")
    assert open(files.discover(str(tmp_path))).read() == "mine"
    found = files.discover(str(tmp_path), str(tmp_path / "dataset.zip"), str(tmp_path))
    assert open(found).read() == "longer" and (tmp_path / "data.csv").read_text() == "mine"
    with pytest.raises(FileNotFoundError):
        files.discover(str(tmp_path), str(tmp_path / "missing.csv"))
    with pytest.raises(FileNotFoundError):
        files.discover(str(tmp_path / "nowhere"))


def test_row_numbers_over_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("query,positive\n" + "".join(f"q{k}{i},p\n" for i in range(4)))
    got = files.read_pairs(spark, str(tmp_path)).orderBy("pair_row").collect()
    assert [r.pair_row for r in got] == list(range(12))
    assert all(got[i].query[1] == got[i + 1].query[1] and got[i].query < got[i + 1].query for i in range(0, 12, 4))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("train", "NA", 1), ("test", "ü", 2)], "split string, text string, n int")
    files.write_splits(df, str(tmp_path / "p"))
    assert {(r.split, r.text, r.n) for r in files.read_splits(spark, str(tmp_path / "p")).collect()} == {("train", "NA", 1), ("test", "ü", 2)}
    files.write_conversations(df, str(tmp_path / "j"))
    lines = [x for f in (tmp_path / "j" / "split=test").glob("*.json") for x in f.read_text(encoding="utf-8").splitlines()]
    assert lines == ['{"text":"ü","n":2}']
    files.write_table(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2


def test_json(tmp_path):
    p = str(tmp_path / "x" / "a.json")
    files.write_json(p, {"b": (1, 2), "a": tmp_path})
    assert files.read_json(p) == {"a": str(tmp_path), "b": [1, 2]} and os.listdir(tmp_path / "x") == ["a.json"]
    (tmp_path / "bad.json").write_text("{")
    (tmp_path / "list.json").write_text("[1]")
    assert files.read_json(str(tmp_path / "bad.json")) is files.read_json(str(tmp_path / "list.json")) is files.read_json(str(tmp_path / "no.json")) is None
    v = {"dims": (1, 2), "x": None}
    assert files.fingerprint(v) == files.fingerprint(json.loads(json.dumps(v)))


def test_file_digests(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"abc")
    (tmp_path / "long name").write_bytes(b"x" * (3 << 20))
    got = {os.path.basename(r.path): (r.length, r.sha256) for r in files.file_digests(spark, str(tmp_path)).collect()}
    assert got["f"][1].startswith("ba7816bf") and len(got) == 2
    assert [n for n, h in got.values() if h == __import__("hashlib").sha256(b"x" * (3 << 20)).hexdigest()] == [3 << 20]


def test_settings(tmp_path):
    f = tmp_path / "own.env"
    f.write_text("# note\nTEXTLOOM_SEED=7\nTEXTLOOM_TOP_K='9'\nTEXTLOOM_MAX_TRAIN_ROWS=auto\nexport TEXTLOOM_DIMS=64,32\n")
    p = config.resolve("smoke", explicit=str(f), environ={"TEXTLOOM_SEED": "8", "OTHER": "1"}, cli={"top_k": 5})
    assert (p.seed, p.top_k, p.dims, p.max_train_rows) == (8, 5, (64, 32), None)
    with pytest.raises(ValueError, match="TEXTLOOM_SEDE"):
        config.resolve("vm", environ={"TEXTLOOM_SEDE": "8"})
    with pytest.raises(FileNotFoundError):
        config.resolve("vm", explicit=str(tmp_path / "none"), environ={})
    with pytest.raises(ValueError):
        config.resolve("vm", environ={}, cli={"fractions": (0.5, 0.2, 0.2)})
    assert config.parse("auto", "int") is None and config.parse("1.0, 0.35, 0.2", "floats") == (1.0, 0.35, 0.2) and config.parse("yes", "bool") is True and config.parse("OFF", "bool") is False
    assert [config.resources(4 + b / 0.8)["batch"] for b in (12, 8, 4, 2, 1)] == [128, 96, 64, 32, 16]


def test_runs(tmp_path):
    root = str(tmp_path)
    a = runs.allocate(root, {"x": (1, 2)})
    assert runs.allocate(root, {"x": [1, 2]}) == a and runs.allocate(root, {"x": 3}) != a
    assert len({a, runs.allocate(root, {"x": 3}), runs.allocate(root, {"x": 3}, "new")}) == 3
    files.write_json(os.path.join(a, "run_state.json"), {"final_evaluation_complete": True})
    assert not runs.complete(a)
    files.write_json(os.path.join(a, "run_state.json"), {"final_evaluation_complete": True, "completed_at": "now"})
    assert runs.complete(a) and runs.allocate(root, {"x": (1, 2)}) != a
    with pytest.raises(ValueError, match="complete"):
        runs.allocate(root, {"x": (1, 2)}, run_id=os.path.basename(a))
    with pytest.raises(FileNotFoundError):
        runs.allocate(str(tmp_path / "none"), {}, "resume")
    b = runs.allocate(root, {"x": 9}, "new")
    assert runs.allocate(root, {"x": 9}, "resume") == b
    with pytest.raises(FileNotFoundError, match="settings"):  # a run of other settings is not entered
        runs.allocate(root, {"x": 10}, "resume")
    runs.point(root, b)
    assert os.path.realpath(os.path.join(root, "latest-incomplete")) == os.path.realpath(b)
    runs.point(root, b, done=True)
    assert not os.path.lexists(os.path.join(root, "latest-incomplete")) and open(os.path.join(root, "latest-completed.txt")).read().strip() == b


def test_stages_are_repaired(tmp_path):
    run, one, two = str(tmp_path), tmp_path / "one", tmp_path / "two"
    paths = {"stage1": str(one), "stage2": str(two)}
    assert runs.stage_state(run, {"x": 1}, paths)["stage1_complete"] is False
    done = {**files.read_json(os.path.join(run, "run_state.json")), "stage1_complete": True, "stage2_complete": True, "final_evaluation_complete": True}
    files.write_json(os.path.join(run, "run_state.json"), done)
    two.mkdir()
    assert runs.stage_state(run, {"x": 1}, paths)["stage1_complete"] is True  # what came of it is there
    two.rmdir()
    one.mkdir()
    got = runs.stage_state(run, {"x": 1}, paths)
    assert (got["stage1_complete"], got["stage2_complete"], got["final_evaluation_complete"]) == (True, False, False)
    with pytest.raises(ValueError, match="other settings"):
        runs.stage_state(run, {"x": 2}, paths)


def test_host(spark, tmp_path, capsys):
    f = host.facts(str(tmp_path), spark)
    assert f["logical_cpus"] > 0 and f["disk_free_gib"] > 0 and f["spark"] == spark.version
    assert host.gib(3 * 2**30) == 3.0 and host.percent(1, 3) == 33.33 and host.percent(1, 0) == 0.0
    assert host.preflight({"memory_available_gib": 9, "disk_free_gib": 3, "avx2": False}) == ["only 3.00 GiB of disk are free", "the processor has no AVX2"]
    with pytest.raises(RuntimeError, match="memory"):
        host.preflight({"memory_available_gib": 1, "disk_free_gib": 3})
    log = host.logger("t", str(tmp_path / "x" / "run.log"))
    log.info("hello")
    assert "hello" in (tmp_path / "x" / "run.log").read_text() and "hello" in capsys.readouterr().out
    assert host.batch_for(3, 64) == 3 and host.batch_for(100, 64) == 64
    with pytest.raises(ValueError):
        host.batch_for(1, 64)
    assert host.seeded(seed=7)["textloom.seed"] == "7"


def test_command_line(tmp_path):
    f = tmp_path / "own.env"
    f.write_text("TEXTLOOM_SEED=7\nTEXTLOOM_TOP_K=9\n")
    name, p = config.arguments(["--profile", "smoke", "--env-file", str(f), "--top-k", "5", "--dims", "64,32", "--max-train-rows", "auto"], environ={"TEXTLOOM_SEED": "8"})
    assert name == "smoke" and (p.seed, p.top_k, p.dims, p.max_train_rows) == (8, 5, (64, 32), None)
    with pytest.raises(SystemExit):
        config.arguments(["--profile", "none"], environ={})
    assert config.computed({"seed": 1, "run_id": "x", "output": "y"}) == {"seed": 1}
    assert config.resources(4) == {"batch": 16, "mining_block": 256, "eval_block": 5000} and config.resources(100, current=30_000)["eval_block"] == 30_000
    for bad in ({"top_k": 1}, {"max_train_rows": 99}, {"eval_corpus": 1}, {"min_margin": -0.1}, {"max_jaccard": 1.1}, {"max_length": 31}):
        with pytest.raises(ValueError):
            config.resolve("vm", environ={}, cli=bad)


def test_reports(spark):
    m = spark.createDataFrame([(32, 0.25, 0.5, 0.3, 0.35), (64, 1.0, 1.0, 1.0, 1.0)], "dim int, accuracy_1 double, recall_5 double, mrr_10 double, ndcg_10 double")
    text = runs.retrieval_report({"Run": "r1"}, {"RAM": 8}, {"Rows": 2}, m, {64: 1.5})
    assert text.index("| 64 | 1.0000") < text.index("| 32 | 0.2500 | 0.5000 | 0.3000 | 0.3500 | n/a |") and "1.500" in text and "- Rows: 2" in text
    assert "| n/a |" in runs.retrieval_report({}, {}, {}, m.limit(0))
    s = spark.createDataFrame([("c", "hi\nthere", None)], "conversation_id string, last_prompt string, expected string")
    assert "> hi\n> there" in runs.conversation_report({}, {"train": 1}, {"loss": 0.5}, s)


def test_cache_and_report(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([("NA", "1")], "a string, b string")

    for _ in range(2):
        df = runs.cached(spark, str(tmp_path), {"k": 1}, build)
    assert len(calls) == 1 and df.dtypes == [("a", "string"), ("b", "string")] and "| NA | 1 |" in runs.markdown("T", {"t": df})
