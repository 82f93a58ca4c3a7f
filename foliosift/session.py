"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
# Paths written by ``materialise``, one list per open scope.
_SCOPES: list[list[str]] = []


def build_session(app_name: str = "foliosift", **settings: str) -> SparkSession:
    """A session with the settings the library relies on; keyword dots are spelt ``__``.

    Shuffle partitions are left to adaptive execution: it starts from the cluster's
    own setting, merges small partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The JVM never compiles a method above 8000 bytes. A long cascade exceeds that as
        # one fused method; with this limit Spark plans it as separate, compiled ones.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # A repeated key in a JSON object: the last value counts.
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, read from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder that every executor can reach"
        )
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="foliosift-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage", *by: str) -> DataFrame:
    """Write ``df`` once to the shared folder, in a folder per value of ``by``, and go on from the files.

    Cuts the lineage: a lost executor costs a file read, and every later branch sees the
    same rows and reads only the columns it needs.
    """
    path = scratch_path(df.sparkSession, label)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the stage tables written inside it. What is to last must be written elsewhere."""
    _SCOPES.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for name in _SCOPES.pop():
            path = hadoop(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``df`` hashed by ``key`` over ``partitions`` tasks; without a number it stays as it is.

    For a small input that arrives in fewer pieces than there are cores and faces CPU-heavy
    row work. It is the caller's choice and never depends on an estimate.
    """
    return df if partitions is None else df.repartition(partitions, key)


def input_partitions(spark: SparkSession) -> int | None:
    """The session's own choice for :func:`spread`, ``spark.foliosift.inputPartitions``; unset: none."""
    chosen = spark.conf.get("spark.foliosift.inputPartitions", None)
    return int(chosen) if chosen else None


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """One table of a parquet folder, reading only ``columns`` if given."""
    df = spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
    return df.select(*columns) if columns else df
