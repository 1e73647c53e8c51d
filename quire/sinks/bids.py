"""BIDS file layout writers.

Built-in writers cannot choose file names, so the exact BIDS names go through
a small Python Data Source (``format("quire_files")``): every row is
``(path, content)`` and the task writing it creates that one file.  The
content is built by Spark expressions; the writer only writes bytes.  Each
file is written to a temporary name and renamed, so a retried task rewrites
the same content (idempotent); a task that fails removes its temporary file.

The output root is a folder that driver and workers share (a mount).  Other
file systems (``hdfs://``, ``s3a://``) are refused, and so is a folder in which
a worker does not find the marker that the driver has just put there: a tree
spread over the machines' own disks would look like success.

The per-record TSVs are many small files by design of the layout.  Files that are one file by the standard
(``participants.tsv``, trial tables, the gather CSV) go through
``write_lines``: the task that must write such a file streams its sorted lines
instead of holding them as one array.  JSON documents hold at most one entry
per declared variable / item.
"""

from __future__ import annotations

import itertools
import json
import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from quire.functions.paths import record_path
from quire.functions.text import clean_text

FORMAT = "quire_files"
#: folders a task remembers to have made
KNOWN_FOLDERS = 10_000


def local_root(root: str) -> str:
    """The folder of an output root; anything but a mounted folder is refused."""
    scheme, sep, rest = root.partition("://")
    if sep and scheme != "file":
        raise ValueError(f"{root}: file names of the layout need a mounted folder, not {scheme}://")
    return rest if sep else root.removeprefix("file:")


@contextmanager
def _marked(root: str):
    """A marker file in ``root`` while a job writes there."""
    os.makedirs(root, exist_ok=True)
    marker = os.path.join(root, f".writing-{uuid.uuid4().hex}")
    with open(marker, "w", encoding="utf-8"):
        pass
    try:
        yield marker
    finally:
        os.remove(marker)


def _check_shared(marker: str) -> None:
    if not os.path.exists(marker):
        raise RuntimeError(f"{os.path.dirname(marker)} is not shared between the driver and this worker")


def _make_folder(folder: str, known: set[str]) -> None:
    """Make ``folder`` and those above it, but the ``known`` ones, which it joins.

    Nobody looks first whether a folder is there: where many tasks fill one folder,
    each look-up of a new name would wait once more for the lock that making it takes.
    """
    if folder in known:
        return
    above = os.path.dirname(folder)
    if above not in ("", folder):
        _make_folder(above, known)
    try:
        os.mkdir(folder)
    except OSError:
        if not os.path.isdir(folder):
            raise
    known.add(folder)


class _Written(WriterCommitMessage):
    def __init__(self, n: int):
        self.n = n


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, root: str, marker: str, json_indent: int | None = None):
        self.root, self.marker = root, marker
        self.json_indent = json_indent

    def write(self, iterator):
        n, start = 0, {"", self.root.rstrip("/")}
        known = set(start)
        _check_shared(self.marker)
        for row in iterator:
            full = os.path.join(self.root, row["path"])
            if len(known) > KNOWN_FOLDERS:
                known = set(start)
            _make_folder(os.path.dirname(full), known)
            tmp = f"{full}.{uuid.uuid4().hex}.tmp"
            content = row["content"] or ""
            if self.json_indent is not None and full.endswith(".json"):
                # one small document: re-serialised with the source's layout
                content = json.dumps(json.loads(content), indent=self.json_indent, ensure_ascii=False)
            try:
                with open(tmp, "wb") as fh:
                    fh.write(content.encode())
                os.replace(tmp, full)
            except BaseException:
                if os.path.exists(tmp):
                    os.remove(tmp)
                raise
            n += 1
        return _Written(n)

    def commit(self, messages):
        return None

    def abort(self, messages):
        return None


class NamedFilesDataSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "path string, content string"

    def writer(self, schema, overwrite):
        indent = self.options.get("json_indent")
        return NamedFilesWriter(self.options["path"], self.options["marker"], int(indent) if indent else None)


LINES_FORMAT = "quire_lines"


class LinesWriter(DataSourceWriter):
    """Streams ``(path, line)`` rows that arrive grouped by path and in line
    order into one file per path; memory use is one line, not one file."""

    def __init__(self, root: str, marker: str):
        self.root, self.marker = root, marker

    def write(self, iterator):
        _check_shared(self.marker)
        n = 0
        for path, rows in itertools.groupby(iterator, key=lambda r: r["path"]):
            full = os.path.join(self.root, path)
            os.makedirs(os.path.dirname(full) or ".", exist_ok=True)
            tmp = f"{full}.{uuid.uuid4().hex}.tmp"
            try:
                with open(tmp, "w", encoding="utf-8", newline="") as fh:
                    for row in rows:
                        fh.write((row["line"] or "") + "\n")
                os.replace(tmp, full)
            finally:
                if os.path.exists(tmp):
                    os.remove(tmp)
            n += 1
        return _Written(n)

    def commit(self, messages):
        return None

    def abort(self, messages):
        return None


class LinesDataSource(DataSource):
    @classmethod
    def name(cls):
        return LINES_FORMAT

    def schema(self):
        return "path string, line string"

    def writer(self, schema, overwrite):
        return LinesWriter(self.options["path"], self.options["marker"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NamedFilesDataSource)
    spark.dataSource.register(LinesDataSource)


def write_lines(lines: DataFrame, root: str, header: dict[str, str] | None = None) -> None:
    """Write ``(path, order, line)`` rows as text files, one per path, lines
    in ``order``.  Rows are hash-partitioned by path and sorted within
    partitions (an external sort that spills), so a large file is streamed by
    the one task that must write it and is never held as one array.
    ``header`` maps a path to its first line."""
    spark = lines.sparkSession
    register(spark)
    body = lines.select("path", F.lit(1).alias("_h"), F.col("order").alias("_o"), "line")
    if header:
        heads = spark.createDataFrame(sorted(header.items()), "path string, line string")
        body = body.unionByName(heads.select("path", F.lit(0).alias("_h"),
                                             F.lit(None).cast(body.schema["_o"].dataType).alias("_o"), "line"))
    rows = body.repartition("path").sortWithinPartitions("path", "_h", "_o").select("path", "line")
    root = local_root(root)
    with _marked(root) as marker:
        rows.write.format(LINES_FORMAT).mode("append").option("path", root).option("marker", marker).save()


def write_files(files: DataFrame, root: str, json_indent: int | None = None) -> None:
    """Write ``(path, content)`` rows as files under ``root``; ``.json``
    documents are pretty-printed with ``json_indent`` when given (the source
    writes indent 4 in the modular converter, 2 in the single-file one).  Rows
    are dealt out by path first: a file takes far longer to make than its row
    to read, and the partitions of a small scan are few."""
    spark = files.sparkSession
    register(spark)
    # a given count, as AQE would join partitions of so few bytes
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = files.select("path", "content").repartition(parts, "path")
    root = local_root(root)
    with _marked(root) as marker:
        w = files.write.format(FORMAT).mode("append").option("path", root).option("marker", marker)
        if json_indent is not None:
            w = w.option("json_indent", str(json_indent))
        w.save()


def tsv_field(c) -> F.Column:
    """Minimal quoting of a TSV field: a field holding a tab, quote or line
    break is quoted, quotes doubled (what a standard delimited writer does)."""
    col = F.col(c) if isinstance(c, str) else c
    needs = col.rlike('[\t"\r\n]')
    return F.when(needs, F.concat(F.lit('"'), F.replace(col, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(col)


def csv_field(c) -> F.Column:
    """Minimal CSV quoting: fields with a comma, quote or line break are
    quoted, quotes doubled (what a standard CSV writer does)."""
    col = F.col(c) if isinstance(c, str) else c
    needs = col.rlike('[,"\r\n]')
    return F.when(needs, F.concat(F.lit('"'), F.replace(col, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(col)


def record_files(records: DataFrame, task_col: str = "task") -> DataFrame:
    """K2 contents: one file per (study, subject, session, task) with a header
    of the record's columns in sheet order and one line of values.

    Text cells go through C6; null cells are empty; a record with one empty
    column is written as ``""`` (what the source's writer produces).  The
    group is one record (its columns), never more.
    """
    cell = F.struct(F.col("item_seq").alias("s"), tsv_field(F.col("item")).alias("h"),
                    F.coalesce(tsv_field(clean_text(F.col("value"))), F.lit("")).alias("v"))
    rec = records.groupBy("study", "subject_id", "session", task_col).agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    values = F.concat_ws("\t", F.transform("cells", lambda x: x["v"]))
    values = F.when((F.size("cells") == 1) & (values == ""), F.lit('""')).otherwise(values)
    content = F.concat(F.concat_ws("\t", F.transform("cells", lambda x: x["h"])), F.lit("\n"), values, F.lit("\n"))
    path = F.concat(F.col("study"), F.lit("/rawdata/"), record_path(F.col("subject_id"), F.col("session"), F.col(task_col)))
    return rec.select(path.alias("path"), content.alias("content"))

