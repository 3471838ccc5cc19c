"""Durable intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder, as the session names it in spark.checkpoint.dir.

    Only a session in one JVM (tests) that names none gets a new local folder; on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Computes df once and cuts its lineage with a reliable checkpoint, which outlives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path for a new table in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{os.urandom(8).hex()}"


def keep(df: DataFrame, name: str, *by: str) -> tuple[DataFrame, str]:
    """Computes df once as a table of the shared folder, partitioned by some columns; the table, and its path for remove().

    For wide rows that are read several times: columns are compressed, and a task reads a part of
    spark.sql.files.maxPartitionBytes at most, however few tasks wrote the table.
    """
    path = fresh_path(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path, in whatever store it is."""
    files, place = _at(spark, path)
    return files.exists(place)


def _at(spark: SparkSession, path: str):
    """(file system, path) of a path, in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file if there is none; False if there is one. The store decides who comes first."""
    files, place = _at(spark, path)
    try:
        out = files.create(place, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(text.encode())
    out.close()
    return True


def names(spark: SparkSession, path: str) -> list[str]:
    """The names of what a folder has; none if there is no such folder."""
    files, place = _at(spark, path)
    try:
        return sorted(x.getPath().getName() for x in files.listStatus(place))
    except Py4JJavaError as e:
        if "FileNotFound" in e.java_exception.getClass().getName():
            return []
        raise


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    files, place = _at(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder with all it has, if it is there."""
    files, place = _at(spark, path)
    files.delete(place, True)
