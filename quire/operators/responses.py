"""Session responses: wide sheets to long rows, task matching, latest record,
long back to wide (P2-P6, P10, J1, W1, U1, D10).

Canonical long table (one row per response cell)::

    responses(study, file_seq, file_name, row_seq, subject_raw, session_raw,
              item_seq, item, value)

Session sheets of different shapes union as long rows (U1), so there is one
plan for any number of files, tasks and studies.  ``study`` leads every key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.ids import item_name, session_id, subject_id
from quire.functions.text import as_text

KEY_COLUMNS = ("id", "ses")


def key_column_names(columns: Sequence[str]) -> tuple[str, str]:
    """The ``id`` and ``ses`` columns, any case.  Raises when either is
    missing (V2 on key columns is the one check that stops a run)."""
    found = {}
    for c in columns:
        lc = c.lower()
        if lc in KEY_COLUMNS and lc not in found:
            found[lc] = c
    missing = [k for k in KEY_COLUMNS if k not in found]
    if missing:
        raise ValueError(f"session sheet without key column(s) {missing}")
    return found["id"], found["ses"]


def normalized_header_map(spark, names: Sequence[str]) -> dict[str, str]:
    """C4 over a sheet's header names (schema metadata, evaluated once with the
    same Column expression as the data path)."""
    if not names:
        return {}
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    return {r[0]: r[1] for r in rows.select("name", item_name(F.col("name"))).collect()}


def sheet_to_long(
    sheet: DataFrame,
    study: Column | str = "study",
    file_seq: Column | str = "file_seq",
    row_seq: Column | str = "row_seq",
    file_name: Column | str | None = "file_name",
    item_columns: Sequence[str] | None = None,
    normalize: bool = True,
) -> DataFrame:
    """P5 wide -> long for a landing sheet (all cells as text, nulls kept).

    ``item_seq`` keeps the sheet's column order (P6 uses it for TSV headers).
    With ``normalize`` the item names go through C4 (P2); names that collide
    after normalisation keep the rightmost column (D10).  ``unpivot`` plans as
    an Expand inside whole-stage codegen: a narrow step, no shuffle.
    """
    cols = sheet.columns
    id_col, ses_col = key_column_names(cols)
    reserved = {id_col, ses_col, _name(study), _name(file_seq), _name(row_seq)}
    if file_name is not None:
        reserved.add(_name(file_name))
    items = [c for c in (item_columns or cols) if c not in reserved]
    norm = normalized_header_map(sheet.sparkSession, items) if normalize else {c: c for c in items}
    rightmost = {norm[c]: i for i, c in enumerate(items)}
    kept = [(i, c) for i, c in enumerate(items) if rightmost[norm[c]] == i]
    keys = [
        _c(study).alias("study"),
        _c(file_seq).alias("file_seq"),
        (_c(file_name) if file_name is not None else F.lit(None).cast("string")).alias("file_name"),
        _c(row_seq).alias("row_seq"),
        F.col(f"`{id_col}`").cast("string").alias("subject_raw"),
        F.col(f"`{ses_col}`").cast("string").alias("session_raw"),
    ]
    slots = [f"_c{i}" for i, _ in kept]
    types = dict((f.name, f.dataType) for f in sheet.schema.fields)
    # typed landing columns are rendered as the sheet shows them (C8: 3.0 -> 3)
    wide = sheet.select(*keys, *[as_text(F.col(f"`{c}`"), types[c]).alias(f"_c{i}") for i, c in kept])
    key_names = ["study", "file_seq", "file_name", "row_seq", "subject_raw", "session_raw"]
    if not slots:
        return wide.select(*key_names, F.lit(None).cast("int").alias("item_seq"), F.lit(None).cast("string").alias("item"),
                           F.lit(None).cast("string").alias("item_raw"), F.lit(None).cast("string").alias("value")).limit(0)
    long = wide.unpivot(key_names, slots, "_slot", "value")
    lookup = lambda pick: F.create_map(*[x for i, c in kept for x in (F.lit(f"_c{i}"), F.lit(pick(i, c)))])
    return long.select(
        *key_names,
        lookup(lambda i, c: i)[F.col("_slot")].alias("item_seq"),
        lookup(lambda i, c: norm[c])[F.col("_slot")].alias("item"),
        lookup(lambda i, c: c)[F.col("_slot")].alias("item_raw"),
        "value",
    )


def normalize_items(responses: DataFrame) -> DataFrame:
    """P2 + D10 for long rows that did not come through ``sheet_to_long``.

    Collisions are a header property, so they are resolved on the header table
    (distinct ``study, file_seq, item, item_seq``: partial aggregation keeps
    that shuffle tiny) and applied with a semi-join, instead of a window over
    every response cell.
    """
    norm = responses.withColumn("item_raw", F.col("item")).withColumn("item", item_name(F.col("item")))
    keys = ["study", "file_seq", "item"]
    winners = norm.groupBy(*keys).agg(F.max("item_seq").alias("item_seq"))
    return norm.join(winners, on=keys + ["item_seq"], how="left_semi")


def with_keys(responses: DataFrame) -> DataFrame:
    """C1/C2 on the record keys (D1: ids are read as text, so id 1 is
    ``sub-001`` even when the sheet also holds floats)."""
    return responses.withColumn("subject_id", subject_id(F.col("subject_raw"))).withColumn(
        "session", session_id(F.col("session_raw"))
    )


def match_task_items(responses: DataFrame, task_items: DataFrame) -> DataFrame:
    """Keep a response cell for task T when its normalised name is one of
    T's items **and** contains upper(T).  A column that belongs to several
    tasks goes to each of them.

    ``task_items`` needs ``study, task, item_norm`` (F2 already applied).  The
    join is an equi-join on ``(study, item)`` with the substring test as a
    residual predicate.  Spark broadcasts the definitions by their size, and
    otherwise splits the large keys of the shuffle join.
    """
    items = task_items.select("study", "task", F.col("item_norm").alias("item")).distinct()
    joined = responses.join(items, on=["study", "item"], how="inner")
    return joined.filter(F.upper(F.col("item")).contains(F.upper(F.col("task"))))


def latest_records(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("file_seq", "row_seq")) -> DataFrame:
    """The latest whole record per key wins (file order, then row order).

    ``rank() == 1`` over long rows keeps every cell of the winning record
    (they tie on the order columns), nulls included.  Spark plans this with a
    partial window group limit before the shuffle, so a hot key is cut down on
    the map side rather than sorted whole in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rk", F.rank().over(w)).filter(F.col("_rk") == 1).drop("_rk")


def matched_columns(headers: DataFrame, task_items: DataFrame) -> DataFrame:
    """J1 on headers: ``(study, class, task, columns)``, the columns (item_seq,
    item) of a header class that are a task's items and contain its name.  ``headers``
    holds ``study, class, item_seq, item``; the join is of header size."""
    items = task_items.select("study", "task", F.col("item_norm").alias("item")).distinct()
    met = headers.join(items, ["study", "item"]).filter(F.upper("item").contains(F.upper("task")))
    return met.groupBy("study", "class", "task").agg(F.array_sort(F.collect_set(F.struct("item_seq", "item"))).alias("columns"))


def winning_rows(rows: DataFrame, matched: DataFrame, order: Sequence[str]) -> DataFrame:
    """W1 on row keys: the latest row by ``order`` for each (study, subject,
    session, lower(task)) among the rows whose class has items of the task.

    Only keys and locators move, combined on the map side; a hot key is one
    row per map task.  A task spelled in two ways keeps each spelling of the winner's class."""
    keys = ["study", "subject_id", "session", "task_lc"]
    tasks = matched.select("study", "class", F.lower("task").alias("task_lc")).distinct()
    own = rows.select("study", "class", "subject_id", "session", F.struct(*order).alias("_at"))
    best = own.join(tasks, ["study", "class"]).groupBy(*keys).agg(F.max("_at").alias("_at"))
    return best.select(*keys, "_at.*")


def fetched_cells(rows: DataFrame, winners: DataFrame, matched: DataFrame, order: Sequence[str]) -> DataFrame:
    """The cells of the winning rows: ``rows`` holds ``study, class, subject_id,
    session, *order, fields``; of a winner's fields only its task's columns are read."""
    won = rows.join(winners, ["study", "subject_id", "session", *order])
    wanted = matched.withColumn("task_lc", F.lower("task"))
    met = won.join(wanted, ["study", "class", "task_lc"])
    values = F.transform("columns", lambda c: F.struct(c["item_seq"].alias("item_seq"), c["item"].alias("item"),
                                                       F.get("fields", c["item_seq"]).alias("value")))
    keep = [c for c in met.columns if c not in ("fields", "columns", "class")]
    return met.select(*keep, F.inline(values))


def records_of_rows(rows: DataFrame, headers: DataFrame, task_items: DataFrame,
                    order: Sequence[str] = ("file_seq", "row_seq")) -> DataFrame:
    """Program A data path on sheet rows (``tables.sheet_rows``): J1 on headers,
    W1 on keys, then the winners' cells.  Equals ``task_records`` on the
    exploded cells."""
    matched = matched_columns(headers, task_items)
    return fetched_cells(rows, winning_rows(rows, matched, order), matched, order)


def records_to_wide(df: DataFrame, keys: Sequence[str], items: Sequence[str], value: str = "value") -> DataFrame:
    """P6 long -> wide with the item list known up front (no extra distinct
    job, no pivot-value cap).  One value per (key, item) after W1."""
    return df.groupBy(*keys).pivot("item", list(items)).agg(F.first(value))


def task_records(responses: DataFrame, task_items: DataFrame) -> DataFrame:
    """Program A data path on normalised long cells (``sheet_to_long``):
    C1/C2 -> J1 -> W1 per (study, subject, session, lower(task)) -> record
    cells ready for a per-task pivot or sink.  Key columns are not item cells
    (P10)."""
    matched = match_task_items(with_keys(responses), task_items)
    matched = matched.withColumn("task_lc", F.lower("task"))
    return latest_records(matched, ["study", "subject_id", "session", "task_lc"])


def _name(c) -> str:
    return c if isinstance(c, str) else ""


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
