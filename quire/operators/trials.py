"""Single-file converter: answer sheets -> trial tables (P1, P11, P12, W2, W3,
J7, A4, U3, K7-K10).

Input ``answers``: one row per answer-sheet row of every task workbook::

    study, file_seq, task, row_seq, id, [ses], <any other columns as text>

Semantics kept: rows of a participant in one workbook form one trial table
named with the participant's **first** session; ``onset`` is the 0-based row
position when the sheet has none, ``duration`` 1.0 and ``trial_type``
``response`` when absent; columns ordered onset, duration, trial_type,
response_time, then the rest.  Participants are listed per workbook,
duplicates kept; demographics attach by the **first** row with an equal raw id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.paths import trial_file_name
from quire.operators.ordering import group_positions

# Trial column names, defaults and leading order.
ONSET, DURATION, TRIAL_TYPE, RESPONSE_TIME = "onset", "duration", "trial_type", "response_time"
DEFAULT_DURATION = 1.0
DEFAULT_TRIAL_TYPE = "response"
LEADING = (ONSET, DURATION, TRIAL_TYPE, RESPONSE_TIME)
FILL_TEXT = "n/a"
KEYS = ("study", "file_seq", "task", "row_seq")


def fill_missing(df: DataFrame) -> DataFrame:
    """P1 (single-file converter): lower/strip names, nulls -> ``n/a``."""
    renamed = df.toDF(*[c.strip().lower() for c in df.columns])
    text_cols = [c for c, t in renamed.dtypes if t == "string"]
    return renamed.fillna(FILL_TEXT, subset=text_cols)


def first_sessions(answers: DataFrame) -> DataFrame:
    """W2 + A4: per (workbook, participant) the first row's session and the
    first row position.  ``min_by`` aggregates combine map-side, so a hot
    participant is not one task's work."""
    ses = F.col("ses") if "ses" in answers.columns else F.lit("1")
    return answers.groupBy("study", "file_seq", "task", "id").agg(
        F.min_by(ses, F.col("row_seq")).alias("session"), F.min("row_seq").alias("first_row")
    )


def trial_rows(answers: DataFrame) -> DataFrame:
    """P11/P12/W3 + K7 names: one output row per answer row, with
    ``file_name`` = ``sub-<id>_ses-<first ses>_task-<task>_beh.tsv``."""
    cols = answers.columns
    df = answers
    # one pass gives the positions and the first session (W2) of each participant
    ses = F.col("ses") if "ses" in cols else F.lit("1")
    df = group_positions(df, ["study", "file_seq", "id"], ["row_seq"], out="_position", first={"_session": ses})
    if ONSET not in cols:
        df = df.withColumn(ONSET, F.col("_position"))
    if DURATION not in cols:
        df = df.withColumn(DURATION, F.lit(DEFAULT_DURATION))
    if TRIAL_TYPE not in cols:
        df = df.withColumn(TRIAL_TYPE, F.lit(DEFAULT_TRIAL_TYPE))
    df = df.withColumn("file_name", trial_file_name(F.col("id"), F.col("_session"), F.col("task")))
    rest = [c for c in cols if c not in LEADING and c not in ("study", "file_seq", "task", "row_seq")]
    lead = [c for c in LEADING if c in df.columns]
    return df.select("study", "file_seq", "task", "file_name", "row_seq", *lead, *rest)


def first_demographics(demographics: DataFrame) -> DataFrame:
    """J7 right side: the first demographics row per raw id (aggregate with
    partial combine, not a window over a possibly hot id)."""
    attrs = [c for c in demographics.columns if c not in ("id", "ses", "row_seq")]
    payload = F.struct(*[F.col(f"`{c}`") for c in attrs])
    return demographics.groupBy("id").agg(F.min_by(payload, F.col("row_seq")).alias("d")).select(
        "id", *[F.col("d")[c].alias(c) for c in attrs]
    )


def trial_participants(answers: DataFrame, demographics: DataFrame | None = None) -> DataFrame:
    """One row per (workbook, participant), duplicates across
    workbooks kept: ``participant_id = sub-<id>``, ``session = ses-<first>``,
    then the first matching demographics row's attributes."""
    p = first_sessions(answers).select(
        "study", "file_seq", "task", "first_row", "id",
        F.concat(F.lit("sub-"), F.col("id")).alias("participant_id"),
        F.concat(F.lit("ses-"), F.col("session")).alias("session"),
    )
    if demographics is None:
        return p
    d = first_demographics(demographics)
    return p.join(d, on="id", how="left")


def task_json_items(items: DataFrame) -> DataFrame:
    """K9 items: ``{itemname: {Description, Levels: {}}}`` for non-empty names;
    a duplicate name keeps the last row at the first position.  The levels
    sheet never fills Levels in the source; that is kept."""
    named = items.filter(F.col("itemname").isNotNull() & (F.col("itemname") != ""))
    return named.groupBy("study", "task", "itemname").agg(
        F.min("row_seq").alias("position"), F.max_by("itemdescription", "row_seq").alias("description")
    )


def task_json(items: DataFrame, bids_version: str = "1.8.0", tasks: DataFrame | None = None) -> DataFrame:
    """K9 document per (study, task): ``TaskName``, ``TaskDescription``,
    ``BIDSVersion``, ``Items`` (each ``{Description, Levels: {}}``).  A task of
    ``tasks`` without items gets empty ``Items``."""
    it = task_json_items(items)
    entry = F.struct(
        "position",
        F.concat(F.regexp_extract(F.to_json(F.array("itemname")), r"^\[(.*)\]$", 1), F.lit(": "),
                 F.to_json(F.struct(F.col("description").alias("Description"),
                                    F.create_map().cast("map<string,string>").alias("Levels")))).alias("t"),
    )
    docs = it.groupBy("study", "task").agg(F.array_sort(F.collect_list(entry)).alias("a"))
    if tasks is not None:
        docs = tasks.select("study", "task").join(docs, ["study", "task"], "left").withColumn(
            "a", F.coalesce("a", F.array().cast(docs.schema["a"].dataType)))
    head = F.to_json(F.struct(F.col("task").alias("TaskName"),
                              F.concat(F.lit("Behavioral task: "), F.col("task")).alias("TaskDescription"),
                              F.lit(bids_version).alias("BIDSVersion")))
    body = F.concat(F.lit('"Items": {'), F.concat_ws(", ", F.transform("a", lambda x: x["t"])), F.lit("}"))
    return docs.select("study", "task", F.concat(F.regexp_replace(head, r"\}$", ", "), body, F.lit("}")).alias("json"))


def participants_json_b(participant_rows: DataFrame) -> DataFrame:
    """K8 sidecar: every participants column as ``{"Description": "Participant
    <col>", "DataType": "string"}`` (column list is schema metadata)."""
    cols = [c for c in participant_rows.columns if c not in ("study", "file_seq", "task", "first_row", "id")]
    obj = ", ".join('"%s": {"Description": "Participant %s", "DataType": "string"}' % (c, c) for c in cols)
    return participant_rows.sparkSession.createDataFrame([("{" + obj + "}",)], "json string")


def dataset_description_b(studies: DataFrame, bids_version: str = "1.8.0") -> DataFrame:
    """Name from the study, constants otherwise (deviation: no authors or
    generator names of the source are copied; ``GeneratedBy`` names this
    library)."""
    return studies.select("study", F.to_json(F.struct(
        F.col("study").alias("Name"), F.lit(bids_version).alias("BIDSVersion"), F.lit("raw").alias("DatasetType"),
        F.array(F.struct(F.lit("quire").alias("Name"))).alias("GeneratedBy"))).alias("json"))
