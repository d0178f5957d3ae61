"""Files: CSV of pairs and of messages, archives, discovery, Parquet and JSON-lines sinks, small JSON documents."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import tempfile
import zipfile
from pathlib import Path
from typing import Any
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# looked for in this order where no file is named (fixed values)
CANDIDATES = ("data.csv", "combined_deduplicated_dataset.csv", "train_augmented.csv", "train_augmented .csv", "dataset.zip")


def _csv(spark: SparkSession, path: str, need: tuple[str, ...]) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("inferSchema", False)
    header = reader.csv(path).columns
    if missing := sorted(set(need) - set(header)):
        raise ValueError(f"missing columns: {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = reader.schema(schema).csv(path)
    # an unquoted empty field reads as null; every field is a text here, and NA or null are ordinary words
    return df.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in need))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """pair_row, query, positive from a CSV file; row numbers follow the file, other columns are dropped."""
    return _numbered(_csv(spark, path, ("query", "positive")), "pair_row")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """msg_id, conversation_id, turn_index, role, content, language from a CSV file with line breaks inside fields."""
    return _numbered(_csv(spark, path, ("conversation_id", "turn_index", "role", "content", "language")), "msg_id")


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """Adds the row number in file order, from 0 without gaps. Rows are numbered where they are read; only the partitions' row counts are added up."""
    at = F.monotonically_increasing_id()
    x = df.select(F.shiftright(at, 33).alias("_part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_k"), *(F.col(f"`{c}`") for c in df.columns))
    per = x.groupBy("_part").agg(F.count("*").alias("n"))  # a row a partition
    base = per.select("_part", (F.sum("n").over(W.orderBy("_part")) - F.col("n")).alias("_base"))
    return x.join(base, "_part").select((F.col("_base") + F.col("_k")).alias(name), *(F.col(f"`{c}`") for c in df.columns))


def unpack_csv(archive: str, staged: str) -> str:
    """The largest .csv member of a zip file, unpacked into the folder ``staged`` under a name of its own that nothing else has there."""
    with zipfile.ZipFile(archive) as z:
        sizes = {m.filename: m.file_size for m in z.infolist() if not m.is_dir() and Path(m.filename).suffix.lower() == ".csv"}
        if not sizes:
            raise FileNotFoundError(f"no CSV in {archive}")
        Path(staged).mkdir(parents=True, exist_ok=True)
        fd, target = tempfile.mkstemp(dir=staged, prefix=f"{Path(archive).stem}-", suffix=".csv")
        with os.fdopen(fd, "wb") as out, z.open(max(sizes, key=lambda k: (sizes[k], k))) as member:
            shutil.copyfileobj(member, out)
    return target


def discover(folder: str, explicit: str | None = None, staged: str | None = None) -> str:
    """The data file: the one named, which must exist, or the first candidate in ``folder``.

    A zip file gives its largest CSV, unpacked into ``staged``, which the caller names for that case; the folder of the
    data is never written to.
    """
    places = [explicit] if explicit else [os.path.join(folder, c) for c in CANDIDATES]
    found = next(filter(os.path.exists, places), None)
    if found is None:
        raise FileNotFoundError(f"none of {', '.join(places)}")
    if not found.lower().endswith(".zip"):
        return found
    if staged is None:
        raise ValueError(f"{found} is an archive: name a folder to unpack it into")
    return unpack_csv(found, staged)


def write_splits(rows: DataFrame, path: str) -> None:
    """Parquet, one folder per split."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_conversations(rows: DataFrame, path: str) -> None:
    """JSON lines, one conversation per line, one folder per split; characters beyond ASCII stay as they are."""
    rows.write.mode("overwrite").partitionBy("split").json(path)


def write_table(rows: DataFrame, path: str) -> None:
    """CSV with a header, for reports."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_text(path: str, text: str) -> None:
    """Atomic: written beside and moved into place."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    fd, tmp = tempfile.mkstemp(dir=p.parent, prefix=f".{p.name}.")
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(tmp, p)


def write_json(path: str, value: Any) -> None:
    """Atomic; keys sorted."""
    write_text(path, json.dumps(plain(value), ensure_ascii=False, indent=2, sort_keys=True))


def read_json(path: str) -> dict | None:
    """The object in a file; None where the file is missing, malformed or holds no object."""
    try:
        with open(path, encoding="utf-8") as f:
            v = json.load(f)
    except (OSError, ValueError):
        return None
    return v if isinstance(v, dict) else None


def plain(value: Any) -> Any:
    """A value that JSON keeps: paths as text, tuples as lists."""
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return str(value) if isinstance(value, Path) else value


def fingerprint(value: Any) -> str:
    """sha256 of canonical JSON; equal for a value and its round trip through JSON."""
    return hashlib.sha256(json.dumps(plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files, hashed on the executors.

    Files on a mounted folder are read in pieces of 1 MiB, so they may be of any size; those of another file system are
    read whole by Spark, which has a limit of 2 GB a file.
    """

    def digest(batches):
        for b in batches:
            out = []
            for p in b.column(0).to_pylist():
                h = hashlib.sha256()
                with open(unquote(urlparse(p).path), "rb") as f:
                    while piece := f.read(1 << 20):
                        h.update(piece)
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["path", "length", "sha256"])

    found = spark.read.format("binaryFile").load(path)
    mounted = found.filter("path LIKE 'file:%'").select("path", "length").mapInArrow(digest, "path string, length long, sha256 string")
    return mounted.unionByName(found.filter("path NOT LIKE 'file:%'").select("path", "length", F.sha2("content", 256).alias("sha256")))
