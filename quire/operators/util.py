"""Shared plan helpers: lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.session import ensure_checkpoint_dir


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir`` (never a
    local checkpoint: executors may be lost)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share, below one folder
    per application that goes with the driver's file system handle at its end."""
    home = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-{spark.sparkContext.applicationId}"
    fs, where = _located(spark, home)
    if fs.mkdirs(where):
        fs.deleteOnExit(where)
    return f"{home}/{name}-{uuid.uuid4().hex}"


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared ``spark.checkpoint.dir``
    and read back: row keys are fixed, later plans prune its columns, and a lost
    executor costs its running tasks only.  ``release`` deletes it early."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def release(table: DataFrame) -> None:
    """Delete a ``stored_table`` that no plan needs any more."""
    fs, where = _located(table.sparkSession, table._stored_at)
    fs.delete(where, True)


def _located(spark, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def mounted(path: str) -> str:
    """A ``file:`` URI as the path that every host mounts it under."""
    return path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")
