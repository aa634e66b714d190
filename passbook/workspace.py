"""Where jobs keep shared intermediate tables, and how a session is prepared."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_MADE: list[str] = []  # paths given out by this process, oldest first


def prepare(spark: SparkSession) -> SparkSession:
    """All timestamps here are zone-less UTC, so conversions must run in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local session without one."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="passbook-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, so that no run overwrites another."""
    _MADE.append(f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


def _remove(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Owner of the intermediate tables made inside: they are removed at the end.

    Results of jobs inside are lazy and read those tables, so write or collect them before it ends.
    """
    first = len(_MADE)
    try:
        yield
    finally:
        paths = _MADE[first:]
        del _MADE[first:]
        for name in paths:
            _remove(spark, name)


@contextmanager
def scratch(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder, for as long as the block runs."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        _remove(df.sparkSession, path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used for a table that several later jobs scan: they then read pruned columns from files that
    survive the loss of an executor, instead of repeating the shuffles that built the table.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
