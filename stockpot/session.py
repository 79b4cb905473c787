"""Session helpers: reading tables and cutting lineage in shared storage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDER = "spark.checkpoint.dir"
#: Tables that cut has written and release has not removed.
_WRITTEN: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only where the setting is absent (tests, a laptop) a temporary folder is made.
    """
    folder = spark.conf.get(_FOLDER, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_FOLDER} must name a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="stockpot-")
    spark.conf.set(_FOLDER, folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A place of its own in the shared folder, which release removes."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def cut(df: DataFrame, name: str = "cut", by: str | None = None) -> DataFrame:
    """Writes ``df`` once to the shared folder, parted into folders by a column if one is named, and reads it back.

    Lineage ends at the written files, so an executor that is lost later costs a
    re-read, never a recomputation, and several consumers share one computation.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Removes the tables that cut has written; for the end of a job whose results are written, as what reads them fails after it."""
    while _WRITTEN:
        _remove(spark, _WRITTEN.pop())


def _remove(spark: SparkSession | None, path: str) -> None:
    try:
        jvm = spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended before us
        if path.startswith("file://") and os.path.isdir(path[7:]):
            shutil.rmtree(path[7:], ignore_errors=True)


@atexit.register
def _release_at_exit() -> None:
    if _WRITTEN:
        release(SparkSession.getActiveSession())
