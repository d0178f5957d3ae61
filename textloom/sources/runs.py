"""Run folders: allocation, completeness, prepared-data cache, reports."""

from __future__ import annotations

import os
import re
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.files import fingerprint, read_json, write_json, write_text


def token(text: str, longest: int = 80) -> str:
    return re.sub(r"[^A-Za-z0-9._-]+", "-", text).strip("-._")[:longest] or "run"


def complete(folder: str) -> bool:
    """A run is complete once its final evaluation is and the time of completion is known."""
    s = read_json(os.path.join(folder, "run_state.json")) or {}
    return bool(s.get("final_evaluation_complete")) and bool(s.get("completed_at"))


def listing(root: str) -> list[str]:
    """Run folders with a manifest, the newest name first."""
    if not os.path.isdir(root):
        return []
    return [p for n in sorted(os.listdir(root), reverse=True) if read_json(os.path.join(p := os.path.join(root, n), "run_manifest.json")) is not None]


def allocate(root: str, settings: Any, mode: str = "auto", run_id: str | None = None) -> str:
    """The folder to work in. auto: the newest incomplete run of equal settings, else a new one; new; resume: that same run, which must exist.

    A complete run is never entered again, nor is one whose settings differ.
    """
    mark = fingerprint(settings)
    if run_id:
        folder = os.path.join(root, token(run_id))
        if complete(folder):
            raise ValueError(f"{folder} is complete")
        old = read_json(os.path.join(folder, "run_manifest.json"))
        if old and old.get("fingerprint") != mark:
            raise ValueError(f"{folder} has other settings")
        return _open(folder, settings, mark)
    if mode != "new":
        for p in listing(root):
            m = read_json(os.path.join(p, "run_manifest.json")) or {}
            if not complete(p) and m.get("fingerprint") == mark:
                return p
        if mode == "resume":
            raise FileNotFoundError("no incomplete run of these settings")
    stamp = datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ")
    folder, k = os.path.join(root, stamp), 1
    while os.path.exists(folder):
        folder, k = os.path.join(root, f"{stamp}-{k:02d}"), k + 1
    return _open(folder, settings, mark)


def _open(folder: str, settings: Any, mark: str) -> str:
    os.makedirs(folder, exist_ok=True)
    if read_json(os.path.join(folder, "run_manifest.json")) is None:
        write_json(os.path.join(folder, "run_manifest.json"), {"fingerprint": mark, "settings": settings, "created_at": datetime.now(UTC).isoformat()})
    return folder


def cached(spark: SparkSession, root: str, key: Any, build) -> DataFrame:
    """The table for ``key``, built and written once; its schema comes from Parquet, so texts such as NA or 123 stay texts."""
    path = os.path.join(root, fingerprint(key))
    if not os.path.exists(os.path.join(path, "_SUCCESS")):
        df: DataFrame = build()
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def markdown(title: str, tables: dict[str, DataFrame], rows: int = 200) -> str:
    """A report of small result tables; each shows ``rows`` rows at most."""
    out = [f"# {title}"]
    for name, df in tables.items():
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in df.limit(rows).collect()]
    return "\n".join(out) + "\n"


def point(root: str, folder: str, done: bool = False) -> None:
    """Pointers to the newest run: a link and a text file each for latest, latest-incomplete and, once ``done``, latest-completed. A finished run is no incomplete one."""

    def put(name: str) -> None:
        write_text(os.path.join(root, f"{name}.txt"), f"{folder}\n")
        link, fresh = os.path.join(root, name), os.path.join(root, f".{name}.{os.getpid()}")
        try:
            os.symlink(os.path.relpath(folder, root), fresh, target_is_directory=True)
            os.replace(fresh, link)
        except OSError:  # a file system without links keeps the text files
            pass

    put("latest")
    if not done:
        put("latest-incomplete")
        return
    put("latest-completed")
    text = os.path.join(root, "latest-incomplete.txt")
    if os.path.exists(text) and open(text, encoding="utf-8").read().strip() == folder:
        for p in (text, os.path.join(root, "latest-incomplete")):
            if os.path.lexists(p):
                os.unlink(p)


STAGES = ("stage1", "stage2", "final_evaluation")


def stage_state(folder: str, settings: Any, artifacts: dict[str, str]) -> dict:
    """Which stages of a run are done, repaired where their results are gone.

    ``artifacts``: the path that each stage leaves behind. A stage that is marked done without its path is reset, and with
    it every later one, unless a later one's own path is there. Other settings than the run began with are an error.
    """
    path, mark = os.path.join(folder, "run_state.json"), fingerprint(settings)
    state = read_json(path)
    if state is None:
        state = {"settings": mark, **{f"{s}_complete": False for s in STAGES}}
    elif state.setdefault("settings", mark) != mark:
        raise ValueError(f"{folder} was begun with other settings")
    for i, s in enumerate(STAGES):
        later = any(state.get(f"{t}_complete") and t in artifacts and os.path.exists(artifacts[t]) for t in STAGES[i + 1 :])
        if state.get(f"{s}_complete") and s in artifacts and not os.path.exists(artifacts[s]) and not later:
            for t in STAGES[i:]:
                state[f"{t}_complete"] = False
            break
    write_json(path, state)
    return state


def _facts(title: str, values: dict) -> list[str]:
    return ["", f"## {title}", "", *(f"- {k}: {v}" for k, v in values.items())]


def retrieval_report(run: dict, host: dict, data: dict, by_dim: DataFrame, search_ms: dict[int, float] | None = None) -> str:
    """Report of a retrieval run: its facts, the host's, the data's bookkeeping, and a row of metrics for each dimension (``by_dim``: dim, accuracy_1, recall_5, mrr_10, ndcg_10; a handful of rows)."""
    out = ["# Retrieval run", *_facts("Run", run), *_facts("Host", host), *_facts("Data", data), "", "## Held-out metrics", "", "| Dimension | Accuracy@1 | Recall@5 | MRR@10 | NDCG@10 | Search ms/query |", "|---:|---:|---:|---:|---:|---:|"]
    rows = by_dim.select("dim", "accuracy_1", "recall_5", "mrr_10", "ndcg_10").orderBy(F.desc("dim")).limit(100).collect()
    for r in rows:
        ms = (search_ms or {}).get(r.dim)
        out.append(f"| {r.dim} | {r.accuracy_1:.4f} | {r.recall_5:.4f} | {r.mrr_10:.4f} | {r.ndcg_10:.4f} | {'n/a' if ms is None else f'{ms:.3f}'} |")
    return "\n".join(out + ([] if rows else ["| n/a | n/a | n/a | n/a | n/a | n/a |"])) + "\n"


def conversation_report(run: dict, splits: dict[str, int], metrics: dict, samples: DataFrame, most: int = 20) -> str:
    """Report of a conversation run: its facts, rows of each split, metrics, and up to ``most`` samples (conversation_id, last_prompt, expected[, generated]) as quoted texts."""
    quote = lambda t: "\n".join(f"> {x}" for x in (t or "").splitlines() or [""])
    out = ["# Conversation run", *_facts("Run", run), *_facts("Rows", splits), *_facts("Metrics", metrics), "", "## Samples"]
    for r in samples.orderBy("conversation_id").limit(most).collect():
        out += ["", f"### {r.conversation_id}"]
        for name in ("last_prompt", "expected", "generated"):
            if name in samples.columns:
                out += ["", f"{name}:", "", quote(r[name])]
    return "\n".join(out) + "\n"
