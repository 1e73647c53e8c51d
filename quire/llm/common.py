"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back.

    Cuts the lineage, so a plan that uses the rows twice computes them once and
    an executor that is lost costs its running tasks only.  The table stays, like
    a checkpoint, until the folder's owner clears it: the result may read it later.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (Spark ignores case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8(col: pa.Array, rows: int = 500) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, a few rows at a time; null counts as empty."""
    for at in range(0, len(col), rows):
        for b in col.slice(at, rows).cast(pa.binary()).to_pylist():
            yield b or b""
