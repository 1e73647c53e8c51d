"""Sheet fleets: many delimited sheet files of different shapes in one job
(S2-S8, S11, S12, F4, P1, D3).

Every file keeps its own header.  Lines are read with their file path, split
offset and a monotonically increasing id, which together order the lines of a
file (within one split the reader emits lines in file order; a later split of
the same file has a larger offset).  ``records.records`` glues the lines of
quoted fields and parses every record once, into a stored table of field arrays,
which also fixes the row keys.  The first record of each file is its header.
Files of one header form a class: names are normalised, key columns found and
collisions masked once per class, whatever the number of files, and the data
rows are projected by their class's positions.

Output of ``read_sheet_cells`` (long, all text)::

    study, file_name, file_seq, row_key STRUCT<blk, mono>, col_seq, column, value
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.ids import item_name
from quire.functions.paths import decoded_path
from quire.operators.ordering import dense_ranks
from quire.operators.util import stored_table
from quire.sources.records import records

# Names that are never session sheets.
TEMP_PREFIX = "~$"
RESERVED_FILES = ("participants_dataset.xlsx", "demographics.xlsx")


def read_lines(spark: SparkSession, paths, study_from_parent: bool = True) -> DataFrame:
    """Lines as they stand between line feeds, so CRLF within quotes stays."""
    return tag_lines(spark.read.option("lineSep", "\n").text(paths), study_from_parent)


def file_columns(df: DataFrame) -> DataFrame:
    """Line text with its file path, name and split offset (streaming-safe)."""
    return df.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.file_block_start").alias("_blk"),
    )


def tag_lines(df: DataFrame, study_from_parent: bool = True) -> DataFrame:
    """Lines with study, file path/name and an in-file order key.  Accepts a
    plain text read or the output of ``file_columns`` (a micro-batch)."""
    if "_path" not in df.columns:
        df = file_columns(df)
    path = decoded_path(F.col("_path"))
    study = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1) if study_from_parent else F.lit(None).cast("string")
    return df.select(
        study.alias("study"),
        path.alias("file_path"),
        F.col("_name").alias("file_name"),
        F.struct(F.col("_blk").alias("blk"), F.monotonically_increasing_id().alias("mono")).alias("row_key"),
        F.col("value").alias("line"),
    ).filter(~F.col("file_name").startswith(TEMP_PREFIX))


def read_sheet_cells(spark: SparkSession, paths, sep: str = ",", study_from_parent: bool = True,
                     lowercase_names: bool = False) -> DataFrame:
    """Long cells of every sheet file under ``paths`` (one job, no per-file
    driver loop).  Column names are stripped (and lower-cased on request, P1)."""
    return cells_from_lines(read_lines(spark, paths, study_from_parent), sep, lowercase_names)


def parsed(lines: DataFrame, sep: str) -> DataFrame:
    """The records of ``lines``, or ``lines`` itself where it holds records already."""
    return lines if "fields" in lines.columns else records(lines, sep)


def sheet_headers(recs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``files`` (study, file_path, file_name, file_seq, class, hdr_mono), ``classes``
    (class, raw: the stripped names) and the data rows of ``recs`` with both.  The
    first record of a file lies in its first split."""
    first = recs.where(F.col("row_key.blk") == 0).groupBy("file_path").agg(F.min("row_key.mono").alias("hdr_mono"))
    own = recs.join(first, "file_path").where((F.col("row_key.blk") == 0) & (F.col("row_key.mono") == F.col("hdr_mono")))
    own = own.select("study", "file_path", "file_name", "hdr_mono", F.transform("fields", lambda x: F.btrim(x)).alias("raw"))
    own = stored_table(own, "headers")
    classes = own.groupBy("raw").agg(F.min("file_path").alias("class"))
    seq = dense_ranks(own, ["study"], "file_name", "file_seq").withColumn("file_seq", F.col("file_seq").cast("int"))
    same = own["study"].eqNullSafe(seq["study"]) & (own["file_name"] == seq["file_name"])
    files = own.join(seq, same).drop(seq["study"]).drop(seq["file_name"])
    files = files.join(classes, "raw").drop("raw")
    data = recs.drop("study", "file_name").join(files, "file_path")
    data = data.where((F.col("row_key.blk") > 0) | (F.col("row_key.mono") > F.col("hdr_mono"))).drop("hdr_mono")
    return files, classes, data


def cells_from_lines(lines: DataFrame, sep: str = ",", lowercase_names: bool = False) -> DataFrame:
    """Long cells of lines or records of many files.  Names without text have no cells."""
    _, classes, data = sheet_headers(parsed(lines, sep))
    names = F.transform("raw", lambda x: F.lower(x)) if lowercase_names else F.col("raw")
    named = classes.select("class", names.alias("names"))
    rows = data.join(named, "class")
    cells = rows.select("study", "file_name", "file_seq", "row_key", F.posexplode(at_names("fields", "names")).alias("col_seq", "x"))
    return cells.select(
        "study", "file_name", "file_seq", "row_key", "col_seq", F.col("x.name").alias("column"), F.col("x.value").alias("value"),
    ).where(F.coalesce(F.col("column"), F.lit("")) != "")


def at_names(fields: str, names: str) -> F.Column:
    """(name, value) for each name; a short record lacks its last values."""
    return F.transform(names, lambda n, i: F.struct(n.alias("name"), F.get(F.col(fields), i).alias("value")))


def sheet_rows(lines: DataFrame, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """S3 + P2 + P3 + D10 without a shuffle of the data: ``rows`` (study, file_seq,
    file_name, row_seq, class, subject_raw, session_raw, fields) and ``headers``
    (study, class, item_seq, item, item_raw).

    Header work (C4 on names, the rightmost-wins mask for colliding names, key
    positions) is one row per class; ``id`` and ``ses`` are read from the field
    array at the class's positions.  Files without ``id`` or ``ses`` give no rows
    (``sheet_key_issues`` reports them)."""
    files, classes, data = sheet_headers(parsed(lines, sep))
    lower = F.transform("raw", lambda x: F.lower(x))
    wide = classes.select(
        "class", "raw", F.transform("raw", lambda x: item_name(x)).alias("norm"),
        F.array_position(lower, "id").cast("int").alias("id_pos"), F.array_position(lower, "ses").cast("int").alias("ses_pos"),
    ).where((F.col("id_pos") > 0) & (F.col("ses_pos") > 0))
    # A name is kept only if no later column normalises to the same name
    last = lambda x, i: ~F.exists(F.slice("norm", i + 2, F.size("norm")), lambda z: z.eqNullSafe(x))
    item = lambda n, i: F.struct(i.alias("item_seq"), n.alias("item"), F.get("raw", i).alias("item_raw"),
                                 (last(n, i) & (F.get("raw", i) != "")).alias("keep"))
    items = F.filter(F.transform("norm", item), lambda x: x["keep"] & (x["item_seq"] + 1 != F.col("id_pos")) &
                     (x["item_seq"] + 1 != F.col("ses_pos")))
    wide = wide.select("class", "id_pos", "ses_pos", items.alias("items"))
    rows = data.join(wide.drop("items"), "class").select(
        "study", "file_seq", "file_name", F.col("row_key").alias("row_seq"), "class",
        F.get("fields", F.col("id_pos") - 1).alias("subject_raw"), F.get("fields", F.col("ses_pos") - 1).alias("session_raw"), "fields")
    used = files.select("study", "class").distinct()
    headers = used.join(wide, "class").select("study", "class", F.inline("items")).drop("keep")
    return rows, headers


def lines_to_responses(lines: DataFrame, sep: str = ",") -> DataFrame:
    """S3 + P2 + P3 + P5 + D10: the item cells of lines or records."""
    return row_cells(*sheet_rows(lines, sep))


def row_cells(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """P5: the item cells of ``sheet_rows`` as long rows."""
    items = headers.groupBy("study", "class").agg(F.collect_list(F.struct("item_seq", "item", "item_raw")).alias("items"))
    cells = F.transform("items", lambda x: F.struct(x["item_seq"], x["item"], x["item_raw"], F.get("fields", x["item_seq"]).alias("value")))
    items = items.select(F.col("study").alias("_study"), F.col("class").alias("_class"), "items")
    return rows.join(items, F.col("study").eqNullSafe(F.col("_study")) & (F.col("class") == F.col("_class"))).select(
        "study", "file_seq", "file_name", "row_seq", "subject_raw", "session_raw", F.inline(cells))


def cells_to_responses(cells: DataFrame) -> DataFrame:
    """S3 + P3 + P2 + U1: sheet cells -> canonical responses.

    ``id``/``ses`` (any case, not trimmed) are found per file; their values
    ride along each row's cells via a per-row aggregate over only the two key
    cells (small), joined back on the row key.  Files without both keys yield
    issue rows via ``sheet_key_issues`` and no responses."""
    lc = F.lower(F.col("column"))
    keys = cells.filter(lc.isin("id", "ses")).groupBy("study", "file_seq", "row_key").agg(
        F.max(F.when(lc == "id", F.col("value"))).alias("subject_raw"),
        F.max(F.when(lc == "ses", F.col("value"))).alias("session_raw"),
        F.count_if(lc == "id").alias("_has_id"), F.count_if(lc == "ses").alias("_has_ses"),
    )
    items = cells.filter(~lc.isin("id", "ses"))
    items = items.withColumn("item_raw", F.col("column")).withColumn("item", item_name(F.col("column")))
    # Colliding normalised names keep the rightmost column (header-level).
    rightmost = items.select("study", "file_seq", "item", "col_seq").groupBy("study", "file_seq", "item").agg(
        F.max("col_seq").alias("col_seq"))
    items = items.join(rightmost, ["study", "file_seq", "item", "col_seq"], "left_semi")
    out = items.join(keys.filter((F.col("_has_id") > 0) & (F.col("_has_ses") > 0)), ["study", "file_seq", "row_key"])
    return out.select(
        "study", "file_seq", "file_name", F.col("row_key").alias("row_seq"), "subject_raw", "session_raw",
        F.col("col_seq").alias("item_seq"), "item", "item_raw", "value",
    )


def sheet_key_issues(cells: DataFrame) -> DataFrame:
    """V2 on session sheets: files missing ``id`` or ``ses`` (case-insensitive)."""
    lc = F.lower(F.col("column"))
    per_file = cells.groupBy("study", "file_name").agg(
        F.count_if(lc == "id").alias("n_id"), F.count_if(lc == "ses").alias("n_ses"))
    return per_file.filter((F.col("n_id") == 0) | (F.col("n_ses") == 0)).select(
        "study", F.lit("V2").alias("check"), F.lit("error").alias("severity"), F.col("file_name").alias("object"),
        F.concat_ws(", ", F.when(F.col("n_id") == 0, F.lit("id")), F.when(F.col("n_ses") == 0, F.lit("ses"))).alias("detail"))


def read_table(spark: SparkSession, path: str, fmt: str = "csv", sep: str = ",") -> DataFrame:
    """One sheet as a wide string table (S4/S5/S12): header row, no type
    inference (ids like ``001`` stay text), ``row_seq`` in file order."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns],
                         F.col("_metadata.row_index").alias("row_seq"))
    df = spark.read.option("header", True).option("inferSchema", False).option("sep", sep).option(
        "escape", '"').option("multiLine", True).csv(path)
    return df.withColumn("row_seq", F.monotonically_increasing_id())


def pivot_sheet(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Long cells of sheets with a known header -> wide rows (one per row key),
    for definition sheets (items, variables, metadata)."""
    return cells.groupBy("study", "file_name", "file_seq", "row_key").pivot("column", columns).agg(F.first("value"))
