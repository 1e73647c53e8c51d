"""End-to-end conversions (programs A, B and C of SURVEY section 3) as Spark
plans over whole fleets of sheet files.

A. ``convert_sheets``: definitions + session sheets + demographics ->
   participants files, dataset description, task sidecars, one TSV per
   (subject, session, task), issue rows.
B. ``convert_trials``: answer sheets -> trial TSVs + participants rows.
C. ``gather_tree``: a written BIDS tree -> one wide row per (subject, session).

Driver work is limited to definition-sized metadata (headers, declared
variables, task lists); response cells never leave the executors.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.ids import task_from_file
from quire.functions.paths import decoded_path, record_path
from quire.operators import casting, dataset, gather, participants, quality, responses, sidecar, trials
from quire.operators.ordering import group_positions, sorted_parts, sorted_positions
from quire.operators.util import cut_lineage, stored_table
from quire.sinks import bids
from quire.sources import bids_tree, records, tables

LEVEL_VALUE = r"^levels(\.(\d+))?$"
LEVEL_DESC = r"^leveldescription(\.(\d+))?$"


def task_items_from_cells(cells: DataFrame) -> DataFrame:
    """S2 main sheets (cells of ``<task>.csv``) -> canonical ``task_items``.

    Column names are kept in case but stripped; the row index (for P14) is a
    0-based position within the sheet; repeated ``levels[.i]`` /
    ``leveldescription[.i]`` pairs become the ``levels`` array."""
    c = cells.withColumn("task", task_from_file(F.col("file_name")))
    rows = c.select("study", "task", "file_seq", "row_key").distinct()
    rows = group_positions(rows, ["study", "file_seq"], ["row_key"], out="row_seq")
    lv_i = F.coalesce(F.regexp_extract("column", LEVEL_VALUE, 2).try_cast("int"), F.lit(0))
    ld_i = F.coalesce(F.regexp_extract("column", LEVEL_DESC, 2).try_cast("int"), F.lit(0))
    is_lv, is_ld = F.col("column").rlike(LEVEL_VALUE), F.col("column").rlike(LEVEL_DESC)
    per_row = c.groupBy("study", "task", "file_seq", "row_key").agg(
        F.max(F.when(F.col("column") == "itemname", F.col("value"))).alias("itemname"),
        F.max(F.when(F.col("column") == "itemdescription", F.col("value"))).alias("itemdescription"),
        F.max(F.when(F.col("column") == "likert_scale", F.col("value"))).alias("likert_scale"),
        F.collect_list(F.when(is_lv, F.struct(lv_i.alias("i"), F.col("value").alias("v")))).alias("lv"),
        F.collect_list(F.when(is_ld, F.struct(ld_i.alias("i"), F.col("value").alias("d")))).alias("ld"),
    )
    n = F.greatest(F.size("lv"), F.size("ld"))
    levels = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(
            i.alias("i"),
            F.try_element_at(F.filter("lv", lambda x: x["i"] == i), F.lit(1))["v"].alias("value"),
            F.try_element_at(F.filter("ld", lambda x: x["i"] == i), F.lit(1))["d"].alias("description"),
        ),
    )
    items = per_row.select("study", "task", "file_seq", "row_key", "itemname", "itemdescription", "likert_scale",
                           F.when(n > 0, levels).otherwise(F.array().cast("array<struct<i:int,value:string,description:string>>")).alias("levels"))
    return items.join(rows, ["study", "task", "file_seq", "row_key"]).drop("row_key", "file_seq")


def task_meta_from_cells(cells: DataFrame, sheet_seq: int) -> DataFrame:
    """Metadata sheets (``key name``, ``description``; names lower-cased)."""
    c = cells.withColumn("task", task_from_file(F.col("file_name")))
    lc = F.lower(F.col("column"))
    rows = c.groupBy("study", "task", "file_seq", "row_key").agg(
        F.max(F.when(lc == "key name", F.col("value"))).alias("key"),
        F.max(F.when(lc == "description", F.col("value"))).alias("value"),
    )
    rows = group_positions(rows, ["study", "task", "file_seq"], ["row_key"], out="row_seq")
    return rows.select("study", "task", F.lit(sheet_seq).alias("sheet_seq"), "row_seq", "key", "value")


def convert_sheets(spark: SparkSession, session_glob: str, items_glob: str, out_root: str,
                   study: str, demographics: DataFrame | None = None, variables: DataFrame | None = None,
                   dataset_meta: DataFrame | None = None, meta_globs: tuple[str, ...] = (),
                   anonymize: bool = False, key_mode: str = "raw") -> DataFrame:
    """Program A over delimited sheets.  Returns the issue rows (V2, V3 = J2 +
    J3 + A1, J8)."""
    lines = tables.read_lines(spark, session_glob)
    sheets = records.records(lines)  # parsed once for records, cells and checks
    rows, headers = tables.sheet_rows(sheets)
    sess_cells = tables.cells_from_lines(sheets)
    item_cells = tables.read_sheet_cells(spark, items_glob)
    meta_cells = [tables.read_sheet_cells(spark, g, lowercase_names=True) for g in meta_globs]
    issues = convert_core(spark, tables.row_cells(rows, headers), sess_cells, item_cells, meta_cells, out_root, study, demographics,
                          variables, dataset_meta, anonymize, key_mode, (rows, headers))
    return issues.unionByName(records.open_quote_issues(lines))


def convert_workbooks(spark: SparkSession, data_dir: str, resources_dir: str, out_root: str, study: str,
                      anonymize: bool = False, key_mode: str = "raw") -> DataFrame:
    """Program A on the source's own layout: ``data_dir`` holds the session
    workbooks plus ``demographics.xlsx`` and ``participants_dataset.xlsx``
    (variables on sheet 1, dataset description on sheet 2);
    ``resources_dir`` holds one task workbook per task (items, task
    description, non-likert sheets).  All workbooks of a folder are parsed in
    one job (S1); the study name is given, as for the source's command line."""
    from quire.sources import workbook

    # The listing is cut down by name before any workbook is parsed, and the
    # cells that several outputs need are kept once.
    def load(folder: str, **names) -> DataFrame:
        return workbook.workbook_cells(spark, folder, **names).withColumn("study", F.lit(study))

    sess = cut_lineage(load(data_dir, exclude_reserved=True))
    sess_cells = workbook.sheet_cells(sess, sheet_idx=0)
    resp = tables.cells_to_responses(sess_cells)
    defs = cut_lineage(load(resources_dir))
    described = cut_lineage(load(data_dir, only=("participants_dataset.xlsx",)))
    demo_book = cut_lineage(load(data_dir, only=("demographics.xlsx",)))
    item_cells = workbook.sheet_cells(defs, sheet_idx=0)
    meta_cells = [workbook.sheet_cells(defs, sheet_idx=i, lowercase_names=True) for i in (1, 2)]

    demo_cells = workbook.sheet_cells(demo_book, sheet_idx=0, lowercase_names=True)
    var_cells = workbook.sheet_cells(described, sheet_idx=0)
    demographics = variables = None
    if not demo_cells.isEmpty() and not var_cells.isEmpty():
        demo_cols = [r[0] for r in demo_cells.select("column").distinct().collect()]  # header names only
        demographics = tables.pivot_sheet(demo_cells, demo_cols).drop("study", "file_name", "file_seq")
        var_cols = ["VariableName", "DataType", "Description", "Levels"]
        variables = participants.normalize_variables(
            tables.pivot_sheet(var_cells, var_cols).select(F.col("row_key.mono").alias("seq"), *var_cols))
    desc = described.filter((F.col("sheet_idx") == 1) & (F.col("row") > 0) & (F.col("col") < 2))
    dataset_meta = desc.groupBy("study", "row").agg(
        F.max(F.when(F.col("col") == 0, F.col("value"))).alias("key"),
        F.max(F.when(F.col("col") == 1, F.col("value"))).alias("value"),
    ).filter(F.col("key").isNotNull()).select("study", F.col("row").cast("long").alias("seq"), "key", "value")
    issues = convert_core(spark, resp, sess_cells, item_cells, meta_cells, out_root, study, demographics, variables,
                          dataset_meta, anonymize, key_mode)
    books = workbook.workbook_issues(sess, 1).unionByName(workbook.workbook_issues(defs, 3))
    books = books.unionByName(workbook.workbook_issues(described, 2)).unionByName(workbook.workbook_issues(demo_book, 1))
    return issues.unionByName(books)


def convert_core(spark: SparkSession, resp: DataFrame, sess_cells: DataFrame, item_cells: DataFrame,
                 meta_cells: list[DataFrame], out_root: str, study: str, demographics: DataFrame | None,
                 variables: DataFrame | None, dataset_meta: DataFrame | None, anonymize: bool,
                 key_mode: str, sheets: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Shared program A steps over canonical responses and definition cells.
    ``sheets``: the rows and headers of ``tables.sheet_rows``, whose records are
    stored already; then winners are picked on row keys and only their cells read."""
    # Responses and latest records feed several outputs (records, sidecars,
    # issues): each is stored once in the shared checkpoint folder instead of
    # re-parsing the sheet fleet per output.
    resp = stored_table(resp, "responses") if sheets is None else resp
    task_items = task_items_from_cells(item_cells)
    task_meta = None
    for i, cells in enumerate(meta_cells):
        m = task_meta_from_cells(cells, i + 1)
        task_meta = m if task_meta is None else task_meta.unionByName(m)

    # Records: J1 -> W1 -> K2
    names = sidecar.task_item_names(task_items)
    if sheets is None:
        recs = responses.task_records(resp, names)
    else:
        recs = responses.records_of_rows(responses.with_keys(sheets[0]), sheets[1], names)
    recs = stored_table(recs, "task-records")
    bids.write_files(bids.record_files(recs.withColumn("task", F.col("task_lc")), "task"), out_root)

    # Sidecars only for tasks with records (J8 decides before writing; K11).
    entries = sidecar.sidecar_entries(task_items, task_meta, anonymize=anonymize, key_mode=key_mode)
    used = recs.select("study", "task").distinct()
    docs = sidecar.sidecar_documents(entries.join(used, ["study", "task"], "left_semi"))
    bids.write_files(docs.select(
        F.concat(F.col("study"), F.lit("/rawdata/task-"), F.lower("task"), F.lit("_beh.json")).alias("path"),
        F.col("json").alias("content")), out_root, json_indent=4)

    # Participants (K3/K4) and dataset description (K5).
    if demographics is not None and variables is not None:
        # sheet order: the row key of the sheet readers, else the order of arrival
        order = next((c for c in ("row_key", "row_seq") if c in demographics.columns), None)
        if order is None:
            order, demographics = "row_seq", demographics.withColumn("row_seq", F.monotonically_increasing_id())
        typed, resolved = participants.participants_table(demographics, variables, order)
        tsv = participants.participants_tsv_rows(typed, resolved, order)
        cols = [c for c in tsv.columns if c != order]
        ppath = f"{study}/rawdata/participants.tsv"
        lines = tsv.select(F.lit(ppath).alias("path"), F.col(order).alias("order"),
                           F.concat_ws("\t", *[F.coalesce(bids.tsv_field(F.col(f"`{c}`")), F.lit("")) for c in cols]).alias("line"))
        bids.write_lines(lines, out_root, {ppath: "\t".join(cols)})
        pj = participants.participants_json(participants.participants_metadata(variables))
        bids.write_files(pj.select(F.lit(f"{study}/rawdata/participants.json").alias("path"), F.col("json").alias("content")),
                         out_root, json_indent=4)
    meta = dataset_meta if dataset_meta is not None else spark.createDataFrame([], "study string, seq long, key string, value string")
    studies = spark.createDataFrame([(study,)], "study string")
    dj = dataset.dataset_json(dataset.dataset_rows(meta, studies))
    bids.write_files(dj.select(F.concat(F.col("study"), F.lit("/rawdata/dataset_description.json")).alias("path"),
                               F.col("json").alias("content")), out_root, json_indent=4)

    # Issues: V2, V3 (J2, J3, A1), J8, and for the participants V4, V6, J9.
    heads = quality.header_table(resp)
    tasks = task_items.select("study", "task").distinct()
    tcols = quality.task_columns(heads, tasks)
    ft = tcols.select("study", "file_seq", "task").distinct()
    item_list = names.select("study", "task", "item_norm").distinct()
    names_of = lambda cells: cells.select("study", F.col("file_name").alias("object"), "column").distinct()
    issues = [
        tables.sheet_key_issues(sess_cells),
        quality.required_columns(names_of(item_cells), ("itemname", "itemdescription")),
        *[quality.required_columns(names_of(cells), ("key name", "description"), lowercase=True) for cells in meta_cells],
        quality.issue_rows(quality.missing_items(tcols, item_list, ft), "V3.missing_items", "warning", "task", "item"),
        quality.issue_rows(quality.extra_columns(tcols, item_list), "V3.extra_columns", "info", "task", "item"),
        quality.issue_rows(quality.null_counts(resp, tcols), "V3.nan_values", "info", "item", "nan_count"),
        quality.issue_rows(quality.unused_tasks(tasks, recs), "J8.unused_task", "info", "task", F.lit("no records")),
        unwritten_records(recs, out_root, study),
    ]
    if demographics is None or variables is None:
        issues.append(_one_issue(spark, study, "J11.missing_file", "error", "participants",
                                 "demographics or variables missing: no participants files"))
    else:
        named = participants.normalize_column_names(demographics)
        for name in participants.missing_variables(demographics, variables):
            issues.append(_one_issue(spark, study, "J9.missing_variable", "warning", name, "declared, not in the demographics"))
        long = named.unpivot(["id"], [F.col(f"`{c}`") for c in named.columns if c not in ("id", order)], "variable", "value")
        types = casting.inferred_dtypes(long, variables.select(F.lower("VariableName").alias("variable"),
                                                               F.col("DataType").alias("data_type")))
        issues.append(quality.issue_rows(types.filter("mismatch").withColumn("study", F.lit(study)), "V4.type_mismatch",
                                         "info", "variable", F.concat(F.lit("declared "), "data_type", F.lit(", read as "), "inferred")))
        twice = quality.duplicate_keys(named, ["id"]).withColumn("study", F.lit(study))
        issues.append(quality.issue_rows(twice, "V6.duplicate_subject", "warning", "id", "n"))
    out = issues[0]
    for i in issues[1:]:
        out = out.unionByName(i)
    return out


def unwritten_records(recs: DataFrame, out_root: str, study: str) -> DataFrame:
    """J11/V8 on the written tree: issue rows for record files that the run should have
    written and that a listing of the output folder lacks.  The listing is Spark's own
    (names and sizes; no file is opened)."""
    spark, root = recs.sparkSession, bids.local_root(out_root).rstrip("/") + "/"
    want = recs.select("study", F.concat(F.col("study"), F.lit("/rawdata/"), record_path(
        F.col("subject_id"), F.col("session"), F.col("task_lc"))).alias("file_name")).distinct()
    folder = os.path.join(root, study, "rawdata")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*_beh.tsv").load(folder)
    path = decoded_path(F.col("path"))
    name = F.substr(path, F.locate(root, path) + len(root))
    present = found.select(F.lit(study).alias("study"), name.alias("file_name"))
    return quality.issue_rows(quality.missing_files(want.where(F.col("study") == study), present), "J11.missing_file", "error",
                              "file_name", F.lit("record was not written"))


def _one_issue(spark: SparkSession, study: str, check: str, severity: str, obj: str, detail: str) -> DataFrame:
    return spark.createDataFrame([(study, check, severity, obj, detail)], quality.ISSUE_SCHEMA)


def gather_tree(spark: SparkSession, root: str, tasks: list[str] | None = None) -> DataFrame:
    """Program C: one row per (subject, session) of a written BIDS tree."""
    tasks = tasks or bids_tree.sidecar_tasks(spark, root)
    cells = stored_table(bids_tree.record_cells(spark, root, tasks), "tree-cells")
    prow, pcols = bids_tree.participants_rows(spark, root)
    spine = bids_tree.directory_spine(spark, root)
    return gather.gather_wide(spine, cells, prow, tasks, pcols)


def csv_lines(wide: DataFrame) -> DataFrame:
    """Keys and the CSV text ``line`` of every gathered row (null -> empty)."""
    line = F.concat_ws(",", *[F.coalesce(bids.csv_field(F.col(f"`{c}`").cast("string")), F.lit("")) for c in wide.columns])
    return wide.select("subject_id", "session_id", line.alias("line"))


def gather_csv_lines(wide: DataFrame) -> DataFrame:
    """K6/O2: ``line_no`` (0-based, behind the header) and ``line`` of the gather CSV."""
    lines = sorted_positions(csv_lines(wide), [F.col("subject_id"), F.col("session_id")], "line_no")
    return lines.select("line_no", "line")


def write_gather_csv(wide: DataFrame, root: str, tasks: list[str], single_file: bool = False) -> str:
    """K6: ``derivatives/phenotype_task-<t1_t2...>_beh.csv`` (null -> empty).

    By default a folder of part files in key order, each with the header, written by
    all tasks, and beside it ``<name>.manifest``: file, first_row (rows in earlier
    parts), rows and the first key of each part, so a row's place in the whole file is
    known without reading the others.  With ``single_file`` one file, which one
    task sorts and streams."""
    name = f"phenotype_task-{'_'.join(tasks)}_beh.csv"
    rel = os.path.join("derivatives", name)
    cols = wide.columns
    header = ",".join(c if not any(x in c for x in ',"\r\n') else '"' + c.replace('"', '""') + '"' for c in cols)
    lines = csv_lines(wide)
    if not single_file:
        placed, ranges = sorted_parts(lines, [F.col("subject_id"), F.col("session_id")])
        file = F.concat(F.lit(f"{rel}/"), F.format_string("part-%05d.csv", "_range"))
        first = placed.where(F.col("_row") == 0).select("_range", "subject_id", "session_id")
        manifest = stored_table(ranges.join(first, "_range").select(
            file.alias("file"), F.col("_before").alias("first_row"), F.col("_rows").alias("rows"), "subject_id", "session_id"), "manifest")
        heads = {r["file"]: header for r in manifest.select("file").collect()}  # one per range
        bids.write_lines(placed.select(file.alias("path"), F.col("_row").alias("order"), "line"), root, heads)
        path = os.path.join(root, rel)
        manifest.coalesce(1).sortWithinPartitions("first_row").write.mode("overwrite").option("header", True).csv(path + ".manifest")
        return path
    lines = lines.select(F.lit(rel).alias("path"), F.struct("subject_id", "session_id").alias("order"), "line")
    bids.write_lines(lines, root, {rel: header})
    return os.path.join(root, rel)


def convert_trials(spark: SparkSession, answers: DataFrame, out_root: str, demographics: DataFrame | None = None) -> DataFrame:
    """Program B: trial TSVs per (workbook, participant) and the participants
    rows (duplicates across workbooks kept)."""
    rows = trials.trial_rows(answers)
    data_cols = [c for c in rows.columns if c not in ("study", "file_seq", "task", "file_name", "row_seq")]
    line = F.concat_ws("\t", *[F.coalesce(bids.tsv_field(F.col(f"`{c}`").cast("string")), F.lit("")) for c in data_cols])
    path = F.concat(F.col("study"), F.lit("/"), F.col("file_name"))
    lines = rows.select(path.alias("path"), F.col("row_seq").alias("order"), line.alias("line"))
    # header lines: one per trial file (file names are known only from data)
    heads = rows.select(path.alias("path")).distinct().select(
        "path", F.lit(None).cast(lines.schema["order"].dataType).alias("order"), F.lit("\t".join(data_cols)).alias("line"))
    bids.write_lines(lines.withColumn("_first", F.lit(1)).unionByName(heads.withColumn("_first", F.lit(0)))
                     .select("path", F.struct("_first", "order").alias("order"), "line"), out_root)
    return trials.trial_participants(answers, demographics)


def trial_workbook_issues(spark: SparkSession, data_dir: str, study: str) -> DataFrame:
    """Issue rows for the workbooks that ``convert_trial_workbooks`` skips."""
    from quire.sources import workbook

    cells = workbook.workbook_cells(spark, data_dir, exclude_reserved=True).withColumn("study", F.lit(study))
    sheets = cells.groupBy("study", "file_name").agg(F.collect_set("sheet_name").alias("_s"),
                                                     F.max(F.col("sheet_idx") < 0).alias("_bad"))
    lacking = F.array_except(F.array(*map(F.lit, ("items", "answers", "levels"))), F.col("_s"))
    named = sheets.filter(~F.col("_bad") & (F.size(lacking) > 0))
    return workbook.unreadable(cells).unionByName(
        quality.issue_rows(named, "V1.sheets", "error", "file_name", F.concat_ws(", ", lacking)))


def convert_trial_workbooks(spark: SparkSession, data_dir: str, out_root: str, study: str) -> DataFrame:
    """Program B on the source's own layout: every task workbook in
    ``data_dir`` (sheets ``items``, ``answers``, ``levels``) -> trial TSVs, task
    JSON (K9), participants rows (K8, duplicates kept) and a dataset
    description (K10); ``demographics.xlsx`` (needs ``id`` and ``ses``, V9)
    is joined by the first row with an equal id (J7).

    Works on the long cell grid of all answer sheets at once: each workbook
    keeps its own columns and column order, no per-workbook plan is built.
    Workbooks that cannot be read or lack one of the three named sheets are
    skipped (``trial_workbook_issues`` lists them; the source stops the whole
    run instead).  Returns the participants rows."""
    from quire.operators.trials import (
        DEFAULT_DURATION, DEFAULT_TRIAL_TYPE, FILL_TEXT, LEADING, dataset_description_b, participants_json_b, task_json,
    )
    from quire.sources import workbook

    cells = cut_lineage(workbook.workbook_cells(spark, data_dir).withColumn("study", F.lit(study)))
    reserved = F.col("file_name").isin(*tables.RESERVED_FILES)
    named = cells.filter(~reserved).groupBy("study", "file_name").agg(F.collect_set("sheet_name").alias("sheets"))
    ok = named.filter(F.array_contains("sheets", "items") & F.array_contains("sheets", "answers")
                      & F.array_contains("sheets", "levels")).select("study", "file_name")
    books = cells.filter(~reserved).join(ok, ["study", "file_name"], "left_semi")
    books = books.withColumn("task", F.regexp_extract("file_name", r"^(.*)\.[^.]*$", 1))

    # P1 on the answers sheet: names stripped + lower-cased; the full grid of
    # each row is built from the file's header so empty cells become n/a.
    ans = books.filter(F.col("sheet_name") == "answers")
    hdr = ans.filter((F.col("row") == 0) & F.col("value").isNotNull()).select("study", "file_name", "task", "col", F.lower(F.btrim("value")).alias("column"))
    rows = ans.filter(F.col("row") > 0).select("study", "file_name", "task", "row").distinct()
    grid = rows.join(hdr, ["study", "file_name", "task"]).join(
        ans.filter(F.col("row") > 0).select("study", "file_name", "row", "col", "value"), ["study", "file_name", "row", "col"], "left")
    grid = grid.withColumn("value", F.coalesce("value", F.lit(FILL_TEXT)))
    lc = F.col("column")
    keys = grid.groupBy("study", "file_name", "task", "row").agg(
        F.max(F.when(lc == "id", F.col("value"))).alias("id"), F.max(F.when(lc == "ses", F.col("value"))).alias("ses"))
    keys = keys.filter(F.col("id").isNotNull())
    cols_per_file = hdr.groupBy("study", "file_name").agg(F.collect_set("column").alias("cols"))
    answers = keys.join(cols_per_file, ["study", "file_name"]).withColumn(
        "ses", F.when(F.array_contains("cols", "ses"), F.col("ses")).otherwise(F.lit("1")))
    answers = answers.select("study", F.col("file_name").alias("file_seq"), "task", F.col("row").cast("long").alias("row_seq"),
                             "id", "ses", "cols")
    per_row = group_positions(answers, ["study", "file_seq", "id"], ["row_seq"], out="pos", first={"session": F.col("ses")})

    # Cells of a row in output order: onset, duration, trial_type,
    # response_time, then the rest in sheet order (P11/P12); absent leading
    # columns are filled with the defaults.
    lead = F.create_map(*[x for i, c in enumerate(LEADING) for x in (F.lit(c), F.lit(i))])
    sheet_cells = grid.select("study", F.col("file_name").alias("file_seq"), F.col("row").cast("long").alias("row_seq"),
                              "column", "value", F.coalesce(lead[F.col("column")], F.col("col") + len(LEADING)).alias("k"))
    synth = per_row.select("study", "file_seq", "row_seq", F.inline(F.array(
        F.struct(F.lit("onset").alias("column"), F.col("pos").cast("string").alias("value"), F.lit(0).alias("k")),
        F.struct(F.lit("duration").alias("column"), F.lit(str(DEFAULT_DURATION)).alias("value"), F.lit(1).alias("k")),
        F.struct(F.lit("trial_type").alias("column"), F.lit(DEFAULT_TRIAL_TYPE).alias("value"), F.lit(2).alias("k")),
    )))
    present = sheet_cells.select("study", "file_seq", "column").distinct()
    synth = synth.join(present, ["study", "file_seq", "column"], "left_anti")
    allc = sheet_cells.unionByName(synth)
    path = F.concat(F.col("study"), F.lit("/sub-"), F.col("id"), F.lit("_ses-"), F.col("session"), F.lit("_task-"),
                    F.col("task"), F.lit("_beh.tsv"))
    per_line = allc.groupBy("study", "file_seq", "row_seq").agg(F.array_sort(F.collect_list(F.struct("k", "column", "value"))).alias("c"))
    per_line = per_line.join(per_row.select("study", "file_seq", "row_seq", "id", "session", "task"), ["study", "file_seq", "row_seq"])
    lines = per_line.select(path.alias("path"), F.struct(F.lit(1).alias("h"), "row_seq").alias("order"),
                            F.concat_ws("\t", F.transform("c", lambda x: bids.tsv_field(x["value"]))).alias("line"),
                            F.concat_ws("\t", F.transform("c", lambda x: bids.tsv_field(x["column"]))).alias("header"))
    heads = lines.groupBy("path").agg(F.first("header").alias("line")).select(
        "path", F.struct(F.lit(0).alias("h"), F.lit(None).cast("long").alias("row_seq")).alias("order"), "line")
    bids.write_lines(lines.drop("header").unionByName(heads), out_root)

    # K9 task JSON per workbook from the items sheet.
    items = books.filter(F.col("sheet_name") == "items")
    ih = items.filter(F.col("row") == 0).select("study", "file_name", "col", F.lower(F.btrim("value")).alias("column"))
    iv = items.filter(F.col("row") > 0).join(ih, ["study", "file_name", "col"])
    item_rows = iv.filter(F.col("value").isNotNull()).groupBy("study", "task", "row").agg(
        F.max(F.when(F.col("column") == "itemname", F.col("value"))).alias("itemname"),
        F.max(F.when(F.col("column") == "itemdescription", F.col("value"))).alias("itemdescription"),
    ).select("study", "task", F.col("row").cast("long").alias("row_seq"),
             F.coalesce("itemname", F.lit(FILL_TEXT)).alias("itemname"),
             F.coalesce("itemdescription", F.lit(FILL_TEXT)).alias("itemdescription"))
    # a workbook whose items sheet has no rows still gets its document
    tj = task_json(item_rows, tasks=books.select("study", "task").distinct())
    bids.write_files(tj.select(F.concat(F.col("study"), F.lit("/task-"), F.col("task"), F.lit("_beh.json")).alias("path"),
                               F.col("json").alias("content")), out_root, json_indent=2)

    # K8 participants rows (+ J7 demographics), K10 dataset description.
    demo_cells = workbook.sheet_cells(cells.filter(F.col("file_name") == "demographics.xlsx"), sheet_idx=0, lowercase_names=True)
    parts = trials.trial_participants(answers.drop("cols"))
    demo_cols = [r[0] for r in demo_cells.select("column").distinct().collect()]  # header names only
    if demo_cols and not quality.participant_key_columns(demo_cols):
        demo = tables.pivot_sheet(demo_cells, demo_cols).select(
            F.col("row_key.mono").alias("row_seq"), *[F.coalesce(F.col(f"`{c}`"), F.lit(FILL_TEXT)).alias(c) for c in demo_cols])
        parts = trials.trial_participants(answers.drop("cols"), demo.drop("ses"))
    dd = dataset_description_b(spark.createDataFrame([(study,)], "study string"))
    bids.write_files(dd.select(F.concat(F.col("study"), F.lit("/dataset_description.json")).alias("path"),
                               F.col("json").alias("content")), out_root, json_indent=2)
    # K8: participants.tsv (workbooks in name order, participants by first
    # row, duplicates across workbooks kept) and participants.json.
    pcols = [c for c in parts.columns if c not in ("study", "file_seq", "task", "first_row", "id")]
    ppath = f"{study}/participants.tsv"
    plines = parts.select(F.lit(ppath).alias("path"), F.struct("file_seq", "first_row").alias("order"),
                          F.concat_ws("\t", *[F.coalesce(bids.tsv_field(F.col(f"`{c}`").cast("string")), F.lit(""))
                                             for c in pcols]).alias("line"))
    bids.write_lines(plines, out_root, {ppath: "\t".join(pcols)})
    pj = participants_json_b(parts)
    bids.write_files(pj.select(F.lit(f"{study}/participants.json").alias("path"), F.col("json").alias("content")), out_root,
                     json_indent=2)
    return parts
