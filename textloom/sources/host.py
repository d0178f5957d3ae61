"""The driver's host: facts, limits checked before a run, log lines to screen and file, batch sizes."""

from __future__ import annotations

import logging
import os
import platform
import resource
import shutil
import sys
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession


def gib(n: float) -> float:
    """Bytes as GiB, two digits."""
    return round(n / 1024**3, 2)


def percent(part: float, whole: float, digits: int = 2) -> float:
    """Share of ``whole`` in percent; 0 of nothing."""
    return round(100.0 * part / whole, digits) if whole else 0.0


def _lines(path: str) -> dict[str, str]:
    """The ``name: value`` lines of a file of the kernel; empty where there is none."""
    try:
        text = Path(path).read_text(encoding="utf-8", errors="replace")
    except OSError:
        return {}
    out: dict[str, str] = {}
    for line in text.splitlines():
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def facts(folder: str, spark: SparkSession | None = None) -> dict:
    """Memory, disk, processors and file limits of the driver's host; with ``spark`` what the cluster was given."""
    memory, flags = _lines("/proc/meminfo"), set(_lines("/proc/cpuinfo").get("flags", "").split())
    kib = lambda k: int(memory.get(k, "0 kB").split()[0]) * 1024
    disk, files = shutil.disk_usage(folder), resource.getrlimit(resource.RLIMIT_NOFILE)
    out = {
        "python": sys.version.split()[0], "system": platform.platform(), "logical_cpus": os.cpu_count() or 1,
        "memory_total_gib": gib(kib("memtotal")), "memory_available_gib": gib(kib("memavailable")), "disk_total_gib": gib(disk.total), "disk_free_gib": gib(disk.free),
        "open_files_soft": files[0], "open_files_hard": files[1],
        "avx2": "avx2" in flags, "avx512": "avx512f" in flags, "bf16": bool(flags & {"avx512_bf16", "amx_bf16"}),
    }
    if spark is not None:
        conf = spark.sparkContext.getConf()
        out |= {"spark": spark.version, "master": spark.sparkContext.master, "parallelism": spark.sparkContext.defaultParallelism, "executor_memory": conf.get("spark.executor.memory", ""), "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")}
    return out


def preflight(found: Mapping, min_memory_gib: float = 8.0, min_disk_gib: float = 2.0, warn_disk_gib: float = 4.0) -> list[str]:
    """Raises where memory or disk of ``found`` (see ``facts``) fall short; returns what is only worth a warning."""
    for name, least in (("memory_available_gib", min_memory_gib), ("disk_free_gib", min_disk_gib)):
        if found[name] < least:
            raise RuntimeError(f"{name} is {found[name]:.2f}; {least:.2f} are needed")
    notes = []
    if found["disk_free_gib"] < warn_disk_gib:
        notes.append(f"only {found['disk_free_gib']:.2f} GiB of disk are free")
    if not found.get("avx2", True):
        notes.append("the processor has no AVX2")
    return notes


def logger(name: str, path: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """Log lines with their time to standard output and, with ``path``, to a file as well; asking again replaces both."""
    log = logging.getLogger(f"textloom.{name}")
    for h in log.handlers[:]:
        log.removeHandler(h)
        h.close()
    targets: list[logging.Handler] = [logging.StreamHandler(sys.stdout)]
    if path:
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        targets.append(logging.FileHandler(path, encoding="utf-8"))
    for h in targets:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(h)
    log.setLevel(level)
    log.propagate = False
    return log


def batch_for(rows: int, wanted: int) -> int:
    """The batch size for ``rows`` training rows: no larger than they are, two at least, as negatives come from the batch."""
    if rows < 2:
        raise ValueError("training needs two rows or more")
    return max(2, min(wanted, rows))


def seeded(spark_conf: Mapping[str, str] | None = None, seed: int = 42, cores: int | None = None) -> dict[str, str]:
    """Session settings that make a run repeatable: the seed travels as a setting, results don't depend on the number of partitions."""
    out = {"textloom.seed": str(seed), "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", **(spark_conf or {})}
    if cores:
        out.setdefault("spark.sql.shuffle.partitions", str(max(1, cores)))
    return out
