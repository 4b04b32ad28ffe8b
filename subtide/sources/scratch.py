"""Folders for tables that only live as long as a query."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared storage of the cluster, spark.checkpoint.dir.

    Only a session without that setting, such as a local test, gets a local one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/subtide-{uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="subtide-")


def _file_system(spark: SparkSession, folder: str):
    """Hadoop's file system of a folder; Spark has no public way to make or delete one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def make_folder(spark: SparkSession, folder: str) -> None:
    path, files = _file_system(spark, folder)
    files.mkdirs(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = _file_system(spark, folder)
    files.delete(path, True)


@contextmanager
def written(df: DataFrame) -> Iterator[DataFrame]:
    """`df` as a table in a scratch folder, computed once however often it is read.

    Written to shared storage rather than cached, so it outlives lost executors.
    """
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    try:
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        delete_folder(spark, folder)
