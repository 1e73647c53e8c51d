"""Gather a BIDS tree into one row per (subject, session) (J4, J5, W6, W7,
P13, O2, O3, A6).

Inputs (long, all text)::

    spine(subject_id, session_id)                       -- every session directory
    cells(subject_id, session_id, task, file_path, row_index, col_seq, column, value)
    participants(row_seq, col_seq, subject_id, column, value)

Semantics kept: per task the first file (by name, D3) and its first row only;
participant attributes of the **last** participants row of a subject; then
``session_id``; then tasks in the requested order, a later task overriding an
earlier one on the same column **with nulls**; ``participant_id`` and
``session_id`` columns of task files skipped.  Deviation D12: the key always
comes from the path, also for subjects absent from participants.

The precedence merge is a ``max_by`` aggregation: map-side combine, no window
over a hot subject.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.util import stored_table

SKIP_COLUMNS = ("participant_id", "session_id")
KEY = ("subject_id", "session_id")


def first_rows(cells: DataFrame) -> DataFrame:
    """First file by name per (subject, session, task), row 0 only.

    The first name is a min aggregation over keys and paths; the cells follow by
    a semi-join, so no window sorts them.  ``cells`` is read twice: pass a stored table."""
    row0 = cells.filter(F.col("row_index") == 0)
    first = row0.groupBy(*KEY, "task").agg(F.min("file_path").alias("file_path"))
    return row0.join(first, [*KEY, "task", "file_path"], "left_semi")


def last_participants(participants: DataFrame) -> DataFrame:
    """The last participants row of a subject wins (dict assignment): its
    cells, by one ``max_by`` per subject and column."""
    return participants.groupBy("subject_id", "column").agg(F.max_by("value", "row_seq").alias("value"))


def task_values(cells: DataFrame, tasks: Sequence[str]) -> DataFrame:
    """Cells of the requested tasks' first rows with their precedence."""
    task_rank = F.create_map(*[x for i, t in enumerate(tasks) for x in (F.lit(t), F.lit(i + 2))])
    t = cells.filter(F.col("task").isin(*tasks) & ~F.col("column").isin(*SKIP_COLUMNS))
    return first_rows(t).select(*KEY, "column", "value", task_rank[F.col("task")].alias("prec"),
                                F.col("col_seq").cast("long").alias("col_seq"))


def merged_cells(spine: DataFrame, cells: DataFrame, participants: DataFrame, tasks: Sequence[str]) -> DataFrame:
    """J4 + J5 + W7 as long cells ``(subject_id, session_id, column, value)``."""
    p = last_participants(participants).filter(F.col("column") != "subject_id")
    p = p.join(spine, on="subject_id", how="inner")  # J4: attach to each session of the subject
    p = p.select(*KEY, "column", "value", F.lit(0).alias("prec"))
    s = spine.select(*KEY, F.lit("session_id").alias("column"), F.col("session_id").alias("value"), F.lit(1).alias("prec"))
    allc = p.unionByName(s).unionByName(task_values(cells, tasks).drop("col_seq"))
    return allc.groupBy(*KEY, "column").agg(F.max_by(F.col("value"), F.col("prec")).alias("value"))


def column_order(values: DataFrame, participants: DataFrame, spine: DataFrame,
                 participant_columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Participant columns that some subject of the tree has, and task
    columns by first appearance (subject, session, precedence, header
    position).  Min aggregations; one row per distinct column comes back (a
    header list)."""
    order = F.struct("subject_id", "session_id", "prec", "col_seq")
    firsts = values.groupBy("column").agg(F.min(order).alias("o")).orderBy("o").collect()
    here = participants.join(spine.select("subject_id").distinct(), "subject_id", "left_semi")
    held = {r["column"] for r in here.select("column").distinct().collect()}
    front = [c for c in participant_columns if c in held and c not in KEY]
    return front, [r["column"] for r in firsts]


def gather_wide(spine: DataFrame, cells: DataFrame, participants: DataFrame, tasks: Sequence[str],
                participant_columns: Sequence[str]) -> DataFrame:
    """K6 table: one row per (subject, session), every session directory kept
    (also without task files), columns in P13 order.

    Tasks are pivoted once per session and participants once per subject; a
    task column replaces a participant column where the session has the cell,
    null or not."""
    values = stored_table(task_values(cells, tasks), "task-values")  # for the column order and the pivot
    front, rest = column_order(values, participants, spine, participant_columns)
    spine = spine.select(*KEY)
    out = spine
    if rest:
        names = {f"_t{i}": c for i, c in enumerate(rest)}
        both = [c for c in rest if c in front]
        pick = lambda c: F.col("column") == c
        t = values.groupBy(*KEY).agg(
            *[F.max_by(F.when(pick(c), F.struct("value")), F.when(pick(c), F.col("prec")))["value"].alias(n) for n, c in names.items()],
            *[F.max(pick(c)).alias(f"_has{i}") for i, c in enumerate(both)])
        out = out.join(t, on=list(KEY), how="left")
    if front:
        last = participants.filter(F.col("column").isin(*front)).groupBy("subject_id").agg(
            *[F.max_by(F.when(F.col("column") == c, F.struct("value")), F.when(F.col("column") == c, F.col("row_seq")))["value"].alias(f"_p{i}")
              for i, c in enumerate(front)])
        out = out.join(last, on="subject_id", how="left")
    slot = {c: n for n, c in names.items()} if rest else {}
    cols = []
    for i, c in enumerate(front):
        mine = F.col(f"_p{i}")
        if c in slot:
            mine = F.when(F.coalesce(F.col(f"_has{both.index(c)}"), F.lit(False)), F.col(slot[c])).otherwise(mine)
        cols.append(mine.alias(c))
    return out.select(*KEY, *cols, *[F.col(slot[c]).alias(c) for c in rest if c not in front])
