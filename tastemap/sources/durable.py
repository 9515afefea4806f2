"""Cutting lineage in storage that outlives an executor."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tastemap.sources.tables import read_table, write_table


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for checkpoints; a new one only for a local run."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tastemap-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


# Paths of the jobs that are open, innermost last.
_open_jobs: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession):
    """Remove on exit what :func:`durable` and :func:`scratch_path` leave inside.

    DataFrames that rest on written tables can be used inside only. Outside of
    any such context intermediate tables stay until the folder is cleared.
    """
    paths: list[str] = []
    _open_jobs.append(paths)
    try:
        yield
    finally:
        _open_jobs.remove(paths)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _open_jobs:
        _open_jobs[-1].append(path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and written, the same on every later use."""
    path = scratch_path(df.sparkSession, "durable")
    write_table(df, path)
    return read_table(df.sparkSession, path, schema=df.schema)
