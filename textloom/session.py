"""Session helpers: table access, shared-folder materialisation, shipping the package to executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so Python stages run where the repository isn't installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    fd, name = tempfile.mkstemp(suffix=".zip", prefix="textloom-")  # read by the driver's file server alone
    os.close(fd)
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(name)
    atexit.register(lambda: os.path.exists(name) and os.unlink(name))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; set to a folder of our own only where it is unset (a local session)."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = f"file://{tempfile.mkdtemp(prefix='textloom-shared-')}"
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone at exit
        pass


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: computed once, lineage cut, safe when executors are lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/textloom-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the table behind a materialised frame that nothing reads any more."""
    for f in {os.path.dirname(x) for x in df.inputFiles()}:
        if "/textloom-" in f:
            _delete(df.sparkSession, f)
