"""Cut lineage through a table in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []
_PATHS: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode where that is unset, as in tests.

    Raises ``RuntimeError`` on a cluster without one: executors could not read each other's files.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="textloom-"))
        atexit.register(shutil.rmtree, _LOCAL[0], True)
    return "file://" + _LOCAL[0]


def _forget(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended; the shared folder is the cluster's to clean
        pass


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables written inside the block are deleted when it ends, so that long sessions do not fill the shared folder.

    What the block computes must have been written or collected before.
    """
    before = len(_PATHS)
    try:
        yield
    finally:
        while len(_PATHS) > before:
            _forget(spark, _PATHS.pop())


def _forget_all(spark: SparkSession) -> None:
    while _PATHS:
        _forget(spark, _PATHS.pop())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below :func:`shared_dir` and return a scan of it.

    Unlike a local checkpoint the files outlive any executor, later stages read only the columns they need, and the
    row count is a footer read. The job runs at once, not when the result is used. The table is deleted when the innermost
    :func:`scratch` block ends, else with the process.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/textloom-{name}-{os.getpid()}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _PATHS:
        atexit.unregister(_forget_all)
        atexit.register(_forget_all, spark)
    _PATHS.append(path)
    return spark.read.schema(df.schema).parquet(path)
