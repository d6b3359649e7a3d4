"""Session settings, and the folders that jobs share across executors."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings a running session may still change. ANSI stays on: casts that may
# fail use the try_ functions.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tallyforge", cores: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and the bench. On a cluster, pass your own session to `tune`."""
    cores = cores or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.path.join(tempfile.gettempdir(), "tallyforge"))  # one machine: its folder is shared
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on.

    On a cluster the number of shuffle partitions stays as it is set. In local mode
    Spark's default is replaced by the number of cores.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    partitions = "spark.sql.shuffle.partitions"
    if spark.sparkContext.master.startswith("local") and spark.conf.get(partitions) == "200":
        spark.conf.set(partitions, spark.sparkContext.defaultParallelism)
    return spark


def _shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):  # the driver runs all tasks
        return os.path.join(tempfile.gettempdir(), "tallyforge")
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


# The folder of the innermost `scratch`, below which shared folders are made.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder name below the shared folder the cluster names, or inside the current `scratch`."""
    return f"{_SCRATCH.get() or _shared_base(spark)}/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as it takes it."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()), named


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder, from whatever file system holds it; one that is not there is no error."""
    system, path = file_system(spark, folder)
    system.delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What is stored inside is removed at the end, from whatever file system holds the shared folder.

    Use or write the results before the end: a DataFrame that reads a stored table can't be read afterwards.
    """
    folder = f"{_shared_base(spark)}/scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        remove(spark, folder)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The DataFrame written to the shared folder and read back: computed once, whatever is lost later.

    Columnar, so a reader that needs few columns reads few. The folder is removed with the
    `scratch` it is made in; without one it is left to the clean-up of the shared folder.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
