"""Role mapping from the driver's tables to the canonical survey tables.

The test tables are TPC-H-like; each plays one survey role (SURVEY 7.4):

* ``events``     -> session responses: subject ``user_id``, session
  ``1 + (day(ts) - 1) div 10``, task ``upper(event_type)``, one session file
  per calendar day, row order ``(ts, event_id)``; every event is a record with
  item columns ``<TASK>01`` (value), ``<TASK>02`` (props.k) and ``<TASK>_TS``
  (a task-named column that is not an item: "extra").
* ``customer``   -> demographics / participants (id ``c_custkey``).
* ``nation``/``region`` -> level labels.
* ``part``       -> task item definitions (task ``p_type``).
* ``benchmark``  -> item descriptions (long prose, newlines, commas).
* ``orders``     -> answer sheets with repeated participants (``o_custkey``).
* ``conversations`` -> trial rows (participant ``conv_id``, order ``turn``).
* ``supplier``   -> one dataset-description sheet per supplier "study".

Every derived table is a lazy projection of a Parquet scan: filters and column
pruning reach the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.ids import item_name, session_id, subject_id
from quire.functions.text import integral_text

STUDY = "tpch"
# The names of an event's columns behind its task's name.
SUFFIXES = ("01", "02", "_TS")


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A driver table, pruned to ``columns``."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def event_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(task, task_no): the event types of the data, upper-cased, numbered in order."""
    types = table(spark, sf_dir, "events", ["event_type"]).select(F.upper("event_type").alias("task")).where("task IS NOT NULL").distinct()
    return types.agg(F.array_sort(F.collect_list("task")).alias("t")).select(F.posexplode("t").alias("task_no", "task"))


def task_list(spark: SparkSession, sf_dir: str) -> list[str]:
    """The tasks as a driver list, for column lists."""
    return [r["task"] for r in event_tasks(spark, sf_dir).orderBy("task_no").collect()]


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet rows from ``events``: one record per event, its class the columns of its
    type, ``fields`` their values (C1/C2 on the keys)."""
    e = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    subject_raw = F.col("user_id").cast("string")
    session_raw = (F.lit(1) + F.floor((F.dayofmonth("ts") - 1) / 10)).cast("string")
    return e.select(
        F.lit(STUDY).alias("study"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("file_seq"),
        "ts",
        F.col("event_id").alias("row_seq"),
        subject_id(subject_raw).alias("subject_id"),
        session_id(session_raw).alias("session"),
        F.upper("event_type").alias("class"),
        F.array(integral_text(F.col("value")), F.get_json_object("props", "$.k"), F.date_format("ts", "HH:mm:ss")).alias("fields"),
    )


def event_row_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(study, class, item_seq, item)``: the columns of each event type."""
    t = event_tasks(spark, sf_dir).select(F.lit(STUDY).alias("study"), F.col("task").alias("class"),
                                          F.posexplode(F.array(*map(F.lit, SUFFIXES))).alias("item_seq", "sfx"))
    return t.select("study", "class", "item_seq", item_name(F.concat("class", "sfx")).alias("item"))


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long response cells from ``events`` (one row per record x item)."""
    rows = event_rows(spark, sf_dir)
    return rows.select("study", "file_seq", "ts", "row_seq", "subject_id", "session", "class",
                       F.posexplode("fields").alias("item_seq", "value")).select(
        "study", "file_seq", "ts", "row_seq", "subject_id", "session", "item_seq",
        F.concat("class", F.get(F.array(*map(F.lit, SUFFIXES)), F.col("item_seq"))).alias("item"), "value")


def event_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header table ``(study, file_seq, item)`` of the daily session sheets:
    the distinct (day, event type) pairs first (map-side combine), then the
    three column names of each; C4 applied to the names."""
    e = table(spark, sf_dir, "events", ["ts", "event_type"])
    days = e.select(F.date_format("ts", "yyyyMMdd").cast("int").alias("file_seq"), F.upper("event_type").alias("t")).distinct()
    names = days.select(F.lit(STUDY).alias("study"), "file_seq",
                        F.explode(F.array(*[F.concat("t", F.lit(x)) for x in SUFFIXES])).alias("item"))
    return names.select("study", "file_seq", item_name(F.col("item")).alias("item"))


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task item definitions from ``part``: task ``p_type``; item name
    ``lower(p_type)-<p_size>``; description ``p_name``; likert count from the
    brand number; level pairs (p_size, p_name), (p_type, p_brand),
    (p_partkey, p_name)."""
    p = table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    return p.select(
        F.lit(STUDY).alias("study"),
        F.col("p_type").alias("task"),
        F.col("p_partkey").alias("row_seq"),
        F.concat(F.lower("p_type"), F.lit("-"), F.col("p_size").cast("string")).alias("itemname"),
        F.col("p_name").alias("itemdescription"),
        F.regexp_extract("p_brand", r"#(\d+)$", 1).alias("likert_scale"),
        F.array(
            F.struct(F.lit(0).alias("i"), F.col("p_size").cast("string").alias("value"), F.col("p_name").alias("description")),
            F.struct(F.lit(1).alias("i"), F.col("p_type").alias("value"), F.col("p_brand").alias("description")),
            F.struct(F.lit(2).alias("i"), F.col("p_partkey").cast("string").alias("value"), F.col("p_name").alias("description")),
        ).alias("levels"),
    )


def event_task_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item definitions of the event tasks from ``benchmark``: item
    ``item_id`` belongs to task number ``item_id mod n`` of the n event types
    as ``<task>-<nn>`` with ``nn = item_id div n + 1``;
    every seventh item is an ``example`` row (F2)."""
    b = table(spark, sf_dir, "benchmark", ["item_id", "text"])
    tasks = event_tasks(spark, sf_dir).agg(F.array_sort(F.collect_list(F.struct("task_no", "task"))).alias("_tasks"))
    b = b.withColumn("_tasks", tasks.scalar()).where(F.size("_tasks") > 0)
    task = F.get("_tasks", (F.col("item_id") % F.size("_tasks")).cast("int"))["task"]
    nn = F.format_string("%02d", (F.floor(F.col("item_id") / F.size("_tasks")) + 1).cast("long"))
    name = F.when(F.col("item_id") % 7 == 6, F.concat(F.lit("example_"), F.lower(task), nn)).otherwise(
        F.concat(F.lower(task), F.lit("-"), nn))
    return b.select(F.lit(STUDY).alias("study"), task.alias("task"), F.col("item_id").alias("row_seq"),
                    name.alias("itemname"), F.col("text").alias("itemdescription"))
