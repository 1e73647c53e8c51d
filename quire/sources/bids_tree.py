"""Read a BIDS tree back.

Record TSVs are read in one job with ``wholetext`` (one row per file: each is
one record), keys parsed from ``_metadata.file_path``; the
subject and session directories, which file sources cannot see when empty, are
listed by ``sources.directories`` on the executors.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.paths import decoded_path, file_tasks, path_session, path_subject, path_task, sidecar_task
from quire.functions.text import na_token_to_null
from quire.sources.directories import DirectorySource
from quire.sources.records import records
from quire.sources.tables import sheet_headers, tag_lines


# One field and what ends it: a quoted field may hold tabs, line breaks and
# doubled quotes; lines end with \n, \r\n or \r.
FIELD = r'("(?:[^"]++|"")*+"|[^\t\r\n]*+)(\t|\r\n|\n|\r|$)'


def parsed_lines(text: Column) -> Column:
    """Lines of a TSV text as arrays of unquoted fields; blank lines left out."""
    raw = F.regexp_extract_all(text, F.lit(FIELD), F.lit(1))
    stop = F.regexp_extract_all(text, F.lit(FIELD), F.lit(2))
    # the pattern also matches the nothing behind the last line end
    ends = F.filter(F.transform(stop, lambda s, i: F.when(s != "\t", i + 1)), lambda e: e.isNotNull())
    plain = F.transform(raw, lambda f: F.when(
        f.startswith('"') & f.endswith('"') & (F.length(f) > 1),
        F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))
    lines = F.transform(ends, lambda e, k: F.slice(
        plain, F.when(k > 0, F.get(ends, k - 1)).otherwise(0) + 1, e - F.when(k > 0, F.get(ends, k - 1)).otherwise(0)))
    return F.filter(lines, lambda x: (F.size(x) > 1) | (F.get(x, F.lit(0)) != ""))


def record_cells(spark: SparkSession, root: str, tasks: Sequence[str] | None = None) -> DataFrame:
    """S9 cells ``(subject_id, session_id, task, file_path, row_index, col_seq,
    column, value)`` of every ``*_beh.tsv`` under ``root``: of each requested
    task whose name the file bears, or, without a list, of the one in its name."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*beh.tsv").select(
        decoded_path(F.col("_metadata.file_path")).alias("file_path"), parsed_lines(F.col("value")).alias("lines"))
    task = F.explode(file_tasks("file_path", tasks)) if tasks else path_task("file_path")
    rows = files.select("file_path", "lines", task.alias("task")).select(
        "file_path", "task", F.get("lines", F.lit(0)).alias("names"),
        F.posexplode(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).alias("row_index", "fields"))
    cells = rows.select("file_path", "task", "row_index", "names", F.posexplode("fields").alias("col_seq", "raw"))
    return cells.select(
        path_subject(F.col("file_path")).alias("subject_id"),
        path_session(F.col("file_path")).alias("session_id"),
        "task", "file_path", "row_index", "col_seq",
        F.try_element_at("names", F.col("col_seq") + 1).alias("column"),
        na_token_to_null(F.col("raw")).alias("value"),
    )


def participants_rows(spark: SparkSession, root: str) -> tuple[DataFrame, list[str]]:
    """S8 long rows ``(row_seq, col_seq, subject_id, column, value)`` and the
    column list; ``participant_id`` is renamed ``subject_id``; NA tokens
    become null.  The file is read as split records, so quoted line breaks need
    no task that holds it whole; its header alone comes to the driver."""
    path = os.path.join(root, "participants.tsv")
    recs = records(tag_lines(spark.read.option("lineSep", "\n").text(path)), "\t")
    _, classes, data = sheet_headers(recs)
    head = classes.select("raw").first()
    names = ["subject_id" if c == "participant_id" else c for c in head["raw"]] if head else []
    if "subject_id" not in names:
        raise ValueError("participants.tsv has no subject column (participant_id or subject_id)")
    at = names.index("subject_id")
    cols = [(i, c) for i, c in enumerate(names) if i != at and c]
    cells = F.array(*[F.struct(F.lit(k + 1).alias("col_seq"), F.lit(c).alias("column"), F.get("fields", F.lit(i)).alias("value"))
                      for k, (i, c) in enumerate(cols)]).cast("array<struct<col_seq: int, column: string, value: string>>")
    rows = data.select(F.col("row_key").alias("row_seq"), F.get("fields", F.lit(at)).alias("subject_id"), F.inline(cells))
    return rows.select("row_seq", "col_seq", "subject_id", "column", na_token_to_null(F.col("value")).alias("value")), [
        "subject_id", *(c for _, c in cols)]


def directory_spine(spark: SparkSession, root: str, parts: int = 32) -> DataFrame:
    """(subject_id, session_id) of every ``sub-*`` / ``ses-*`` directory, also
    empty ones; a subject without session directories is session ``1``.

    The directories are listed by the tasks of a data source, ``parts`` of them, each
    with its share of the subjects; the driver lists nothing."""
    spark.dataSource.register(DirectorySource)
    return spark.read.format("quire_directories").option("root", root).option("parts", parts).load()


def sidecar_tasks(spark: SparkSession, root: str) -> list[str]:
    """Tasks named by ``task-*_beh.json`` in the root, sorted, distinct."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "task-*_beh.json").load(root).select(
        sidecar_task(F.col("_metadata.file_name")).alias("t"))
    tasks = sorted({r[0] for r in df.filter(F.col("t").isNotNull()).distinct().collect()})
    if not tasks:
        raise ValueError(f"no task sidecars under {root}")
    return tasks
