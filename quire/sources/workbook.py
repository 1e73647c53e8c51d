"""A fleet of ``.xlsx`` workbooks as sheet cells, in one job.

``binaryFile`` lists and reads the workbooks; ``mapInPandas`` streams each into
cell rows with the standard library (``zipfile`` + ``xml.etree``; no
spreadsheet package is needed on the workers).  Everything after that (header
promotion, ``.1``/``.2`` suffixes for repeated headers, file order) is Spark.

Output of ``workbook_cells``::

    study, file_name, file_seq, sheet_idx, sheet_name, row, col, value

``sheet_cells`` promotes the first row of one sheet to the header and returns
the long cells shape of ``sources.tables.read_sheet_cells``, so the same
conversions run on CSV and on workbooks.  Numbers: integral floats are
written without ``.0`` (C8); dates stay serial numbers; booleans become
``True``/``False``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators.ordering import dense_ranks
from quire.sources.tables import RESERVED_FILES, TEMP_PREFIX

UNREADABLE = -1
CELL_SCHEMA = "path string, sheet_idx int, sheet_name string, row int, col int, value string"
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _number_text(text: str) -> str:
    x = float(text)
    if x.is_integer() and abs(x) < 9.2e18:
        return str(int(x))
    return repr(x)


def _cell_text(cell, shared: list[str]) -> str | None:
    kind, v = cell.get("t"), cell.find(f"{_NS}v")
    if kind == "inlineStr":
        return "".join(x.text or "" for x in cell.iter(f"{_NS}t"))
    if v is None or v.text is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "True" if v.text == "1" else "False"
    return v.text if kind in ("str", "e") else _number_text(v.text)


def _streamed(member, tag: str):
    """Elements of one kind as they end; the tree behind them is let go."""
    import xml.etree.ElementTree as ET

    parents = []
    for event, element in ET.iterparse(member, events=("start", "end")):
        if event == "start":
            parents.append(element)
            continue
        parents.pop()
        if element.tag == tag:
            yield element
            if parents:
                parents[-1].clear()


def sheet_rows(member, shared: list[str]):
    """(row, {col: text}) of a worksheet's rows that hold a value, one at a time."""
    at = -1
    for element in _streamed(member, f"{_NS}row"):
        at = int(element.get("r")) - 1 if element.get("r") else at + 1
        cells, col = {}, -1
        for c in element.iter(f"{_NS}c"):
            ref = c.get("r") or ""
            col = _col_index(ref) if ref[:1].isalpha() else col + 1
            text = _cell_text(c, shared)
            if text is not None:
                cells[col] = text
        if cells:
            yield at, cells


def parse_xlsx(path: str, content: bytes):
    """Cell tuples of one workbook (a per-file helper run inside tasks).

    Rows are streamed: beside the file itself and its table of distinct strings, one
    row is held.  Every row below the header up to the last one with a value has a
    cell, blank or not, for each header column.  A damaged file raises before its
    first cell: each member is checked and tested to be well-formed beforehand."""
    import io
    import xml.etree.ElementTree as ET
    import zipfile
    from xml.parsers import expat

    z = zipfile.ZipFile(io.BytesIO(content))
    names = set(z.namelist())
    for name in sorted(names):
        with z.open(name) as member:
            if name.endswith((".xml", ".rels")):
                expat.ParserCreate().ParseFile(member)
            else:
                while member.read(1 << 20):  # the end of a member checks its sum
                    pass
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels}
    shared = []
    if "xl/sharedStrings.xml" in names:
        with z.open("xl/sharedStrings.xml") as member:
            shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in _streamed(member, f"{_NS}si")]
    sheets = wb.find(f"{_NS}sheets")
    for idx, sh in enumerate(list(sheets) if sheets is not None else []):
        target = targets.get(sh.get(f"{_REL}id"), "")
        name = target.lstrip("/") if target.startswith("/") else "xl/" + target
        if name not in names:
            continue
        header: list[int] = []
        done = 0  # rows given out
        with z.open(name) as member:
            for row, cells in sheet_rows(member, shared):
                if row == 0:
                    header = sorted(cells)
                for blank in range(max(done, 1), row):
                    yield from ((path, idx, sh.get("name"), blank, col, None) for col in header)
                for col in sorted(cells.keys() | set(header)):
                    yield (path, idx, sh.get("name"), row, col, cells.get(col))
                done = row + 1


#: Cells that a task hands on at once.
CELLS_AT_ONCE = 50_000


def _parse_batches(batches):
    """Frames of cells; a workbook that cannot be read is one row with
    ``sheet_idx`` -1 and the reason as its value."""
    import itertools

    import pandas as pd

    columns = ["path", "sheet_idx", "sheet_name", "row", "col", "value"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            cells = parse_xlsx(path, bytes(content))
            try:
                while some := list(itertools.islice(cells, CELLS_AT_ONCE)):
                    yield pd.DataFrame(some, columns=columns)
            except Exception as bad:  # noqa: BLE001 - any damage of a file is that file's issue
                yield pd.DataFrame([(path, UNREADABLE, None, 0, 0, f"{type(bad).__name__}: {bad}")], columns=columns)


def workbook_cells(spark: SparkSession, root: str, exclude_reserved: bool = False, only: tuple[str, ...] = ()) -> DataFrame:
    """Cells of every ``*.xlsx`` under ``root`` (temp files ``~$*`` skipped;
    with ``exclude_reserved`` also the demographics/variables workbooks; with
    ``only`` just the files of those names).  Names are tested on the listing,
    before a workbook is parsed."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(root)
    name_of = F.regexp_extract("path", r"([^/]+)$", 1)
    keep = ~name_of.startswith(TEMP_PREFIX)
    if exclude_reserved:
        keep = keep & ~name_of.isin(*RESERVED_FILES)
    if only:
        keep = keep & name_of.isin(*only)
    listing = listing.filter(keep)
    study_of = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    # File order from the listing alone (the content column is pruned).
    named = listing.select("path", study_of.alias("study"), name_of.alias("file_name"))
    rank = dense_ranks(named, ["study"], "file_name", "file_seq").select(
        F.col("study").alias("_s"), F.col("file_name").alias("_f"), F.col("file_seq").cast("int").alias("file_seq"))
    seq = named.join(rank, (F.col("study") == F.col("_s")) & (F.col("file_name") == F.col("_f"))).drop("_s", "_f")
    cells = listing.select("path", "content").mapInPandas(_parse_batches, CELL_SCHEMA)
    out = cells.join(seq, "path")  # one row per workbook on the right: AQE broadcasts it
    return out.select("study", "file_name", "file_seq", "sheet_idx", "sheet_name", "row", "col", "value")


def sheet_counts(cells: DataFrame) -> DataFrame:
    """V1 input: number of sheets per readable workbook."""
    return cells.filter(F.col("sheet_idx") >= 0).groupBy("study", "file_name").agg(
        F.countDistinct("sheet_idx").alias("n_sheets"))


def unreadable(cells: DataFrame) -> DataFrame:
    """Issue rows for workbooks that could not be read."""
    return cells.filter(F.col("sheet_idx") == UNREADABLE).select(
        "study", F.lit("S1.unreadable").alias("check"), F.lit("error").alias("severity"),
        F.col("file_name").alias("object"), F.col("value").alias("detail"))


def workbook_issues(cells: DataFrame, sheets: int) -> DataFrame:
    """Unreadable workbooks and V1: fewer than the ``sheets`` a kind of workbook needs."""
    few = sheet_counts(cells).filter(F.col("n_sheets") < sheets)
    return unreadable(cells).unionByName(few.select(
        "study", F.lit("V1.sheets").alias("check"), F.lit("error").alias("severity"), F.col("file_name").alias("object"),
        F.format_string(f"%d of {sheets} sheets", "n_sheets").alias("detail")))


def sheet_cells(cells: DataFrame, sheet_idx: int | None = None, sheet_name: str | None = None,
                lowercase_names: bool = False) -> DataFrame:
    """One sheet of every workbook as long cells with header names: row 0 is
    the header; repeated names get ``.1``, ``.2`` ... in column order."""
    s = cells
    if sheet_idx is not None:
        s = s.filter(F.col("sheet_idx") == sheet_idx)
    if sheet_name is not None:
        s = s.filter(F.col("sheet_name") == sheet_name)
    hdr = s.filter((F.col("row") == 0) & F.col("value").isNotNull()).select(
        "study", "file_name", "col", F.btrim(F.col("value")).alias("name"))
    if lowercase_names:
        hdr = hdr.withColumn("name", F.lower("name"))
    k = F.row_number().over(Window.partitionBy("study", "file_name", "name").orderBy("col")) - 1
    hdr = hdr.withColumn("column", F.when(k == 0, F.col("name")).otherwise(F.concat("name", F.lit("."), k.cast("string"))))
    data = s.filter(F.col("row") > 0).join(hdr.select("study", "file_name", "col", "column"),
                                          ["study", "file_name", "col"])
    return data.select(
        "study", "file_name", "file_seq",
        F.struct(F.lit(0).cast("bigint").alias("blk"), F.col("row").cast("bigint").alias("mono")).alias("row_key"),
        F.col("col").alias("col_seq"), "column", "value",
    )
