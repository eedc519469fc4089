"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs are written for. Shuffle partition count is left to the
#: cluster: AQE coalesces from whatever the operator set.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Wide projections generate methods the JVM will not compile; beyond its limit let
    # Spark split them instead of interpreting one huge method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}

_OPEN = threading.local()


def build_session(app: str = "feedloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RECOMMENDED, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def setting(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(name, str(default)))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, or a test-only folder in local mode.

    A cluster must name the folder in ``spark.checkpoint.dir``: executors on other
    machines cannot read a folder local to the driver, so there is no fallback there.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="feedloom-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_root(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), f"feedloom-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path inside this application's part of the shared folder."""
    path = os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")
    if getattr(_OPEN, "scopes", None):
        _OPEN.scopes[-1].append(path)
    return path


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end; results must be stored elsewhere by then."""
    _OPEN.scopes = [*getattr(_OPEN, "scopes", []), []]
    try:
        yield
    finally:
        for path in _OPEN.scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application staged, once its results are written."""
    _delete(spark, scratch_root(spark))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the stored rows.

    Used where rows are consumed more than once, where a value is only stable
    within one execution (partition ids), or where an iteration would otherwise
    double its plan. The copy survives executor loss, its rows are computed once
    (an RDD checkpoint computes them twice), and its size is known to the planner.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
