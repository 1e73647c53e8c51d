"""Data-quality operators (V1-V9, J2, J3, J6, J8, J9, J11, A1, A3, A5, A7,
A10, A11, U4).  Each returns rows, never raises, except V2 on key columns.

Issue rows share one schema::

    issues(study, check, severity, object, detail)
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.util import stored_table

ISSUE_SCHEMA = "study string, check string, severity string, object string, detail string"


def header_table(responses: DataFrame) -> DataFrame:
    """Distinct session columns per file: ``(study, file_seq, item)``.  A
    partial aggregation: the shuffle carries headers, not cells."""
    return responses.select("study", "file_seq", "item").distinct()


def task_trie(tasks: Sequence[str]) -> dict:
    """Nested dicts by character; the key ``None`` holds the task names that end there."""
    root: dict = {}
    for task in tasks:
        node = root
        for c in task.upper():
            node = node.setdefault(c, {})
        node.setdefault(None, []).append(task)
    return root


def tasks_within(name: str, trie: dict) -> set[str]:
    """The tasks whose upper-cased name stands anywhere in the upper-cased ``name``."""
    text, found = name.upper(), set(trie.get(None, ()))
    for i in range(len(text)):
        node = trie
        for c in text[i:]:
            node = node.get(c)
            if node is None:
                break
            found.update(node.get(None, ()))
    return found


def task_columns(headers: DataFrame, tasks: DataFrame) -> DataFrame:
    """Columns whose name contains the task name (any case), per file and task.

    The task names of a study, definitions that the driver holds anyway, become a
    trie; each distinct header name goes through it once, whatever the number of
    files that bear it, and only its matches come out.  They are joined back to the
    header table on the name."""
    names = {}
    for r in tasks.select("study", "task").distinct().collect():
        if r["task"]:
            names.setdefault(r["study"], []).append(r["task"])
    tries = {study: task_trie(found) for study, found in names.items()}

    def matches(batches):
        for b in batches:
            out = [(s, i, t) for s, i in zip(b["study"], b["item"]) if s in tries and i for t in sorted(tasks_within(i, tries[s]))]
            yield pd.DataFrame(out, columns=["study", "item", "task"])

    distinct = headers.select("study", "item").distinct()
    met = distinct.mapInPandas(matches, "study string, item string, task string")
    return headers.join(met, ["study", "item"]).select("study", "file_seq", "task", "item").distinct()


def missing_items(task_cols: DataFrame, items: DataFrame, file_tasks: DataFrame) -> DataFrame:
    """Defined items of a task with no column in a session file.  Checked
    for each (file, task) pair the run processes (``file_tasks``)."""
    expected = file_tasks.join(items.select("study", "task", F.col("item_norm").alias("item")), on=["study", "task"])
    return expected.join(task_cols, on=["study", "file_seq", "task", "item"], how="left_anti")


def extra_columns(task_cols: DataFrame, items: DataFrame) -> DataFrame:
    """Session columns that name a task but are not among its items."""
    known = items.select("study", "task", F.col("item_norm").alias("item"))
    return task_cols.join(known, on=["study", "task", "item"], how="left_anti")


def null_counts(responses: DataFrame, task_cols: DataFrame) -> DataFrame:
    """A1: nulls per (file, task, column), only counts > 0.  Counted per
    (file, column) first (map-side), so the join is between header-sized tables."""
    per_column = responses.groupBy("study", "file_seq", "item").agg(
        F.count_if(F.col("value").isNull()).alias("nan_count")).filter(F.col("nan_count") > 0)
    return per_column.join(task_cols, on=["study", "file_seq", "item"]).select("study", "file_seq", "task", "item", "nan_count")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A3/V6: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def unused_tasks(task_names: DataFrame, records: DataFrame) -> DataFrame:
    """Tasks with a definition but no written record (their sidecar
    is not written; nothing is deleted afterwards)."""
    used = records.select("study", F.lower("task").alias("task_lc")).distinct()
    return task_names.withColumn("task_lc", F.lower("task")).join(used, on=["study", "task_lc"], how="left_anti").drop("task_lc")


def numbered_tasks(tasks: DataFrame) -> DataFrame:
    """(study, task, task_no): a study's distinct tasks, numbered in order."""
    names = tasks.groupBy("study").agg(F.array_sort(F.collect_set("task")).alias("t"))
    return names.select("study", F.posexplode("t").alias("task_no", "task"))


def coverage_classes(file_tasks_with_data: DataFrame, files: DataFrame, tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files that have relevant columns for the same tasks are one class.

    A file's tasks are bitmaps of their numbers (one per 32,768 tasks of a study,
    combined on the map side), so a file is one short row whatever the number of
    tasks.  Returns the classes (study, class, n_files, n_without, without: the tasks
    they lack, sorted) and the membership (study, file_seq, class); a class is
    named by its least file."""
    numbers = numbered_tasks(tasks)
    bit = F.bitmap_bit_position("task_no")
    block = F.bitmap_bucket_number("task_no")
    seen = stored_table(file_tasks_with_data.select("study", "file_seq", "task").join(numbers, ["study", "task"]), "file-tasks")
    maps = seen.groupBy("study", "file_seq", block.alias("block")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    # trailing zero bytes go, so a bitmap is as long as its last task's number needs
    short = F.regexp_replace(F.hex("bits"), "(?:00)+$", "")
    maps = maps.groupBy("study", "file_seq").agg(F.array_sort(F.collect_list(F.struct("block", short.alias("bits")))).alias("bits"))
    known = files.select("study", "file_seq").distinct().join(tasks.select("study").distinct(), "study", "left_semi")
    every = known.join(maps, ["study", "file_seq"], "left")
    every = stored_table(every, "coverage")
    named = every.groupBy("study", "bits").agg(F.min("file_seq").alias("class"), F.count(F.lit(1)).alias("n_files"))
    other = named.select(F.col("study").alias("_s"), F.col("bits").alias("_b"), "class")
    same = F.col("study").eqNullSafe(F.col("_s")) & F.col("bits").eqNullSafe(F.col("_b"))
    member = every.join(other, same).select("study", "file_seq", "class")
    # a class's tasks are those of the file it is named by
    have = seen.join(named.select("study", F.col("class").alias("file_seq")), ["study", "file_seq"], "left_semi")
    defined = numbers.groupBy("study").agg(F.collect_set("task").alias("defined"))
    held = have.groupBy("study", F.col("file_seq").alias("class")).agg(F.collect_set("task").alias("held"))
    lists = named.drop("bits").join(held, ["study", "class"], "left").join(defined, "study")
    without = F.array_sort(F.array_except("defined", F.coalesce("held", F.array().cast("array<string>"))))
    classes = lists.select("study", "class", "n_files", F.size(without).alias("n_without"), without.alias("without"))
    return classes, member


def file_task_coverage(file_tasks_with_data: DataFrame, files: DataFrame, tasks: DataFrame) -> DataFrame:
    """Per file, the defined tasks of its study without relevant columns:
    ``(study, file_seq, n_without, without)`` for files that lack any, read off
    the file's coverage class."""
    classes, member = coverage_classes(file_tasks_with_data, files, tasks)
    lacking = classes.filter(F.col("n_without") > 0).drop("n_files")
    return member.join(lacking, ["study", "class"]).drop("class")


def required_columns(headers: DataFrame, required: Sequence[str], lowercase: bool = False) -> DataFrame:
    """V2: sheets (``study, object, column`` rows, one per header name) that lack a
    required column, the missing names sorted in ``detail``."""
    name = F.lower(F.btrim("column")) if lowercase else F.btrim("column")
    lacks = [F.when(~F.bool_or(F.coalesce(name == r, F.lit(False))), F.lit(r)) for r in sorted(required)]
    found = headers.groupBy("study", "object").agg(F.concat_ws(", ", *lacks).alias("detail")).filter(F.col("detail") != "")
    return found.select("study", F.lit("V2").alias("check"), F.lit("error").alias("severity"), "object", "detail")


def missing_files(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required file names absent from a path listing."""
    return required.join(present, on=["study", "file_name"], how="left_anti")


def rows_per_file(cells: DataFrame) -> DataFrame:
    """Record files with more than one data row."""
    return cells.groupBy("file_path").agg(F.countDistinct("row_index").alias("n_rows")).filter(F.col("n_rows") > 1)


def issue_rows(df: DataFrame, check: str, severity: str, obj, detail) -> DataFrame:
    """Shape any finding into the common issues schema."""
    o = F.col(obj) if isinstance(obj, str) else obj
    d = F.col(detail) if isinstance(detail, str) else detail
    study = F.col("study") if "study" in df.columns else F.lit(None).cast("string")
    return df.select(study.alias("study"), F.lit(check).alias("check"), F.lit(severity).alias("severity"),
                     o.cast("string").alias("object"), d.cast("string").alias("detail"))


def empty_tables(counts: DataFrame) -> DataFrame:
    """V5: tables (``study, object, n_rows``) without rows."""
    return counts.filter(F.col("n_rows") == 0)


def sidecar_structure(entries: DataFrame) -> DataFrame:
    """V7: sidecar documents without entries, and item entries without a
    ``Description`` (warning only, as in the source)."""
    per_task = entries.groupBy("study", "task").agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("kind") == "item") & F.col("description").isNull()).alias("no_desc"))
    return per_task.filter((F.col("n") == 0) | (F.col("no_desc") > 0))


def participant_key_columns(columns: Sequence[str]) -> list[str]:
    """V9 (single-file converter): ``id`` and ``ses`` must both be present in
    the demographics; returns the missing ones (then demographics are unused)."""
    return [c for c in ("id", "ses") if c not in columns]
