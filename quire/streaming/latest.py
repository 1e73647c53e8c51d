"""Incremental ingest: session sheets arriving over time, last record wins.

The reference converts a folder at once; new session files simply overwrite
older records of the same (subject, session, task).  As a stream:

* a Structured Streaming **file source** picks up new sheet files (text lines
  with ``_metadata``), ``maxFilesPerTrigger`` bounds a micro-batch;
* ``foreachBatch`` parses the batch with the batch reader (header per file),
  matches task items (J1) and keeps the batch's latest records (W1);
* the batch's winners are one partition ``batch=<id>`` of the result table: a
  trigger writes what it has read and nothing else, and a batch that is run again
  replaces its own partition;
* ``read_latest`` applies W1 over all batches (file name, then row), and
  ``compact`` writes its answer as a new table when many batches have come.

File order across batches is the file **name** (D3), not arrival time, so a
late file with an early name does not win over a later one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import responses, sidecar
from quire.sources import tables

KEYS = ["study", "subject_id", "session", "task_lc"]
ORDER = ("file_name", "row_seq")


def batch_latest(lines: DataFrame, task_items: DataFrame, sep: str = ",") -> DataFrame:
    resp = tables.lines_to_responses(lines, sep)
    names = sidecar.task_item_names(task_items)
    matched = responses.match_task_items(responses.with_keys(resp), names).withColumn("task_lc", F.lower("task"))
    latest = responses.latest_records(matched, KEYS, order=ORDER)
    return latest.select(*KEYS, "task", "file_name", "row_seq", "item_seq", "item", "value")


def append_batch(batch: DataFrame, batch_id: int, table_path: str) -> None:
    (batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(table_path))


def read_latest(spark: SparkSession, table_path: str) -> DataFrame:
    """The latest record cells over all batches."""
    rows = spark.read.parquet(table_path)
    return responses.latest_records(rows.drop("batch"), KEYS, order=ORDER)


def compact(spark: SparkSession, table_path: str, new_path: str) -> None:
    """The latest records as a table of one batch (number -1) at ``new_path``."""
    append_batch(read_latest(spark, table_path), -1, new_path)


def start(spark: SparkSession, input_dir: str, task_items: DataFrame, table_path: str, checkpoint: str,
          sep: str = ",", max_files_per_trigger: int = 1000, available_now: bool = True):
    """Start the ingest stream; returns the ``StreamingQuery``."""
    stream = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
              .option("pathGlobFilter", "*.csv").load(input_dir))
    lines = tables.file_columns(stream)

    def each(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        tagged = tables.tag_lines(batch_df)
        append_batch(batch_latest(tagged, task_items, sep), batch_id, table_path)

    w = lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
