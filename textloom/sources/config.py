"""Typed settings from an env file, the environment and the command line; the nearer one to the user wins."""

from __future__ import annotations

import argparse
import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields, replace
from typing import Any

# words for truth and for "not set" (fixed values)
TRUE, FALSE = ("1", "true", "yes", "on", "y"), ("0", "false", "no", "off", "n")
AUTO = ("", "auto", "default", "none", "null")


@dataclass(frozen=True)
class Profile:
    """Sizes of a run."""

    max_train_rows: int | None = 45_000
    eval_queries: int = 1000
    eval_corpus: int = 5000
    top_k: int = 16
    dims: tuple[int, ...] = (384, 256)
    max_conversations: int | None = 12_000
    max_length: int = 512
    seed: int = 42
    threshold: int = 100
    fractions: tuple[float, ...] = (0.8, 0.1, 0.1)
    min_margin: float = 0.02
    max_jaccard: float = 0.88


PROFILES = {
    "smoke": Profile(2000, 200, 1000, 8, max_conversations=64),
    "vm": Profile(),
    "full": Profile(None, 2000, 10_000, 24, (384, 256, 128), None, 768),
}


def parse(text: str, kind: str) -> Any:
    """``text`` as bool, int, float, str, ints or floats; None for a word that means automatic."""
    t = text.strip()
    if t.lower() in AUTO:
        return None
    if kind == "bool":
        if t.lower() in TRUE:
            return True
        if t.lower() in FALSE:
            return False
        raise ValueError(f"no truth value: {text!r}")
    if kind in ("ints", "floats"):
        return tuple((int if kind == "ints" else float)(x) for x in t.split(",") if x.strip())
    return {"int": int, "float": float, "str": str}[kind](t)


def read_env_file(path: str) -> dict[str, str]:
    """KEY=value lines; # starts a comment line, quotes around a value go, nothing is interpolated."""
    out = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            line = line.strip()
            if not line or line.startswith("#") or "=" not in line:
                continue
            k, v = line.removeprefix("export ").split("=", 1)
            v = v.strip()
            out[k.strip()] = v[1:-1] if len(v) > 1 and v[0] == v[-1] and v[0] in "'\"" else v
    return out


def env_values(prefix: str, known: Iterable[str], explicit: str | None = None, default: str = "textloom.env", environ: Mapping[str, str] = os.environ, strict: bool = True) -> dict[str, str]:
    """Settings by key: the file's, overridden by the environment's. A named file must exist, the default one need not; unknown keys under the prefix are an error."""
    named = explicit or environ.get(f"{prefix}ENV_FILE")
    if named and not os.path.exists(named):
        raise FileNotFoundError(named)
    path = named or default
    file = read_env_file(path) if os.path.exists(path) else {}
    merged = {**file, **{k: v for k, v in environ.items() if k.startswith(prefix)}}
    known = set(known) | {f"{prefix}ENV_FILE"}
    if strict and (odd := sorted(k for k in merged if k.startswith(prefix) and k not in known)):
        raise ValueError(f"unknown settings: {odd}")
    return {k: v for k, v in merged.items() if k in known}


_KINDS = {"max_train_rows": "int", "max_conversations": "int", "dims": "ints", "fractions": "floats", "min_margin": "float", "max_jaccard": "float"}


def resolve(name: str, prefix: str = "TEXTLOOM_", cli: Mapping[str, Any] | None = None, **where: Any) -> Profile:
    """Profile ``name`` with the file, the environment and then ``cli`` laid over it, checked."""
    keys = {f"{prefix}{f.name.upper()}": f.name for f in fields(Profile)}
    env = {keys[k]: parse(v, _KINDS.get(keys[k], "int")) for k, v in env_values(prefix, keys, **where).items() if k in keys}
    optional = ("max_train_rows", "max_conversations")
    over = {k: v for k, v in {**env, **(cli or {})}.items() if v is not None or k in optional}
    p = replace(PROFILES[name], **over)
    validate(p)
    return p


def validate(p: Profile) -> None:
    """Raises on the first setting out of range."""
    checks = [
        (len(p.fractions) == 3 and abs(sum(p.fractions) - 1) <= 1e-9 and min(p.fractions) > 0, "fractions must be three positive numbers that sum to 1"),
        (p.max_train_rows is None or p.max_train_rows >= 100, "max_train_rows must be 100 or more where it is set"), (p.max_conversations is None or p.max_conversations >= 3, "max_conversations must be 3 or more"),
        (p.eval_queries > 0 and p.eval_corpus >= 2, "eval_queries must be positive and eval_corpus 2 or more"), (p.top_k >= 2, "top_k must be 2 or more"), (p.threshold > 1, "threshold must exceed 1"),
        (bool(p.dims) and min(p.dims) > 0 and list(p.dims) == sorted(set(p.dims), reverse=True), "dims must be positive and fall"), (32 <= p.max_length, "max_length must be 32 or more"), (p.min_margin >= 0, "min_margin cannot be negative"), (0 <= p.max_jaccard <= 1, "max_jaccard must be in [0, 1]"), (max(p.fractions) < 1, "each fraction must be under 1"),
    ]
    for ok, message in checks:
        if not ok:
            raise ValueError(message)


STEPS = ((12, 128), (8, 96), (4, 64), (2, 32), (0, 16))  # GiB of budget and rows of a batch from there on (fixed values)


def between(low: int, value: int, high: int) -> int:
    return sorted((low, value, high))[1]


def resources(available_gib: float, reserve_gib: float = 4.0, utilization: float = 0.8, most: int = 128, eval_corpus: int = 5000, current: int = 0) -> dict[str, int]:
    """Batch and block sizes for the memory at hand (see ``host.facts``).

    The budget is what is left above the reserve. Mining works on eight batches at a time, 256 to 4096 rows; evaluation on
    the whole corpus up to 20,000 rows, and never on smaller blocks than it does now.
    """
    budget = utilization * (available_gib - reserve_gib)
    batch = next((rows for least, rows in STEPS if budget >= least), STEPS[-1][1])
    batch = min(batch, most)
    block = between(256, 8 * batch, 4096)
    return {"batch": batch, "mining_block": block, "eval_block": current if current >= 20_000 else between(current, eval_corpus, 20_000)}


# settings that say where and how a run is kept, not what it computes (fixed values)
NOT_COMPUTED = ("output", "output_root", "run_mode", "run_id", "run_label", "create_latest_links", "overwrite_output", "print_config")


def computed(settings: Mapping[str, Any]) -> dict[str, Any]:
    """The settings that a run's fingerprint is taken over."""
    return {k: v for k, v in settings.items() if k not in NOT_COMPUTED}


def arguments(argv: list[str], prefix: str = "TEXTLOOM_", **where: Any) -> tuple[str, Profile]:
    """Profile name and settings of a command line: --profile NAME and one option for every setting; the line wins over the environment, that over the file, and that over the profile."""
    p = argparse.ArgumentParser(prog="textloom")
    p.add_argument("--profile", choices=sorted(PROFILES), default="vm")
    p.add_argument("--env-file")
    for f in fields(Profile):
        p.add_argument(f"--{f.name.replace('_', '-')}", type=lambda t, k=_KINDS.get(f.name, "int"): parse(t, k), default=argparse.SUPPRESS)
    got = vars(p.parse_args(argv))
    name, explicit = got.pop("profile"), got.pop("env_file")
    return name, resolve(name, prefix, got, **({"explicit": explicit} if explicit else {}), **where)
