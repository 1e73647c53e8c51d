"""Delimited records that may span lines, without one task per file.

A quoted field may hold separators, doubled quotes and line breaks, so a line of
a file is a record only if it starts outside quotes.  Whether it does depends on
all lines before it, on any split.  The scan is made split-safe like this:

1. Each line is a function of the state it starts in.  Two pattern tests say
   whether it ends inside quotes when started outside (``_open``) and when
   started inside (``_stay``); a line without a quote leaves the state as it is.
2. A file without a line that opens is finished: its lines are its records, and
   they never shuffle.
3. The lines of the other files are composed block by block.  A block is the
   split and a range of line numbers in it, so a window holds a bounded number of
   lines whatever the file's size; a function on two states is either constant,
   or a swap or not, so running sums of swaps and the last constant compose a
   block, and a table of one row per block is composed the same way.
4. Lines between two that start outside are glued with their line break.

A field that starts with no quote takes quotes literally, as do fields whose
quote never closes: where a file ends inside quotes, the lines of that last
record are records of their own (``open_quote_issues`` names the file).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.ordering import BLOCK_WIDTH, order_block
from quire.operators.util import stored_table

_QUOTED = r'"(?:[^"]++|"")*+"'


def _class(sep: str) -> str:
    return {"\t": r"\t", ",": ",", ";": ";", "|": r"\|"}[sep]


def ends_open(line: Column, sep: str, inside: bool = False) -> Column:
    """Whether ``line`` ends within a quoted field, started outside or inside one."""
    s = _class(sep)
    whole = rf'{s}(?:{_QUOTED}[^{s}]*+|[^"{s}][^{s}]*+|(?={s}|$))'
    pattern = rf'^(?:{whole})*+{s}"(?:[^"]++|"")*+$'
    found = F.concat(F.lit(sep + '"' if inside else sep), line).rlike(pattern)
    return F.when(line.contains('"'), found).otherwise(F.lit(inside))


def record_fields(record: Column, sep: str) -> Column:
    """The unquoted fields of one record; empty ones are null."""
    s = _class(sep)
    found = F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(rf"{s}({_QUOTED}[^{s}]*+|[^{s}]*+)"), F.lit(1))
    closed = rf"^{_QUOTED}"

    def unquoted(f: Column) -> Column:
        """A field that starts with a quote; what stands behind the closing quote is kept."""
        inner = F.substr(f, F.lit(2), F.length(f) - 2)
        text = F.replace(inner, F.lit('""'), F.lit('"'))
        simple = f.endswith('"') & (F.length(f) > 1) & ~F.replace(inner, F.lit('""'), F.lit("")).contains('"')
        head = F.regexp_extract(f, closed, 0)
        rest = F.concat(F.replace(F.substr(head, F.lit(2), F.length(head) - 2), F.lit('""'), F.lit('"')), F.regexp_replace(f, closed, ""))
        return F.when(simple, text).when(f.rlike(closed), rest).otherwise(f)

    plain = F.when(record.contains('"'), F.transform(found, lambda f: F.when(f.startswith('"'), unquoted(f)).otherwise(f)))
    fields = plain.otherwise(F.split(record, re.escape(sep), -1))
    return F.transform(fields, lambda f: F.nullif(f, F.lit("")))


def _composed(const: Column, swaps: Column, start: Column) -> Column:
    """State after lines whose last constant is ``const`` (counted back over all ``swaps``), started in ``start``."""
    return F.when(const.isNotNull(), (const + swaps) % 2).otherwise((start + swaps) % 2)


def line_blocks(lines: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """``lines`` of torn files with ``_before``: 1 where the line starts inside
    quotes, ``_start``: the row key of the line that starts its record, and
    ``_lost``: whether that record never closes."""
    at = ["file_path", "_block"]
    rows = lines.withColumn("_block", order_block(lines, "row_key", width))
    rows = rows.withColumn("_swap", (F.col("_open") & ~F.col("_stay")).cast("int"))
    inside = Window.partitionBy(*at).orderBy("row_key")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_w", F.sum("_swap").over(upto))
    const = F.when(F.col("_open") == F.col("_stay"), (F.col("_open").cast("int") + F.col("_w")) % 2)
    rows = rows.withColumn("_c", F.last(const, True).over(upto))
    rows = rows.withColumns({"_wb": F.coalesce(F.lag("_w").over(inside), F.lit(0)), "_cb": F.lag("_c").over(inside)})
    # one row per block: what it does to the state, composed over the blocks of a file
    blocks = rows.groupBy(*at).agg(F.max_by(F.struct("_w", "_c"), "row_key").alias("end"))
    blocks = blocks.select(*at, (F.col("end._w") % 2).alias("_bw"), ((F.col("end._c") + F.col("end._w")) % 2).alias("_bc"))
    through = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = blocks.withColumn("_sw", F.sum("_bw").over(through))
    blocks = blocks.withColumn("_sc", F.last((F.col("_bc") + F.col("_sw")) % 2, True).over(through))
    after = _composed(F.col("_sc"), F.col("_sw"), F.lit(0))
    order = Window.partitionBy("file_path").orderBy("_block")
    ends = F.last(after).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    blocks = blocks.select(*at, F.coalesce(F.lag(after).over(order), F.lit(0)).alias("_s"), ends.alias("_end"))
    rows = rows.join(blocks, at)
    rows = rows.withColumn("_before", _composed(F.col("_cb"), F.col("_wb"), F.col("_s")))
    rows = rows.withColumn("_start", F.max(F.when(F.col("_before") == 0, F.col("row_key"))).over(upto))
    # a record that goes on from an earlier block starts at the last start there
    starts = rows.groupBy(*at).agg(F.max("_start").alias("_start"))
    earlier = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file_path")
    starts = starts.select(*at, F.max("_start").over(earlier).alias("_from"), F.max("_start").over(whole).alias("_last"))
    rows = rows.join(starts, at)
    start = F.coalesce("_start", "_from")
    return rows.select(*lines.columns, "_before", start.alias("_start"), ((F.col("_end") == 1) & (start == F.col("_last"))).alias("_lost"))


def glued(lines: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """The records of torn files: study, file_path, file_name, row_key (of the first line), line."""
    rows = line_blocks(lines, width)
    rows = rows.withColumn("_start", F.when(F.col("_lost"), F.col("row_key")).otherwise(F.col("_start")))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row_key", "line"))), lambda x: x["line"]), "\n")
    return rows.groupBy("study", "file_path", "file_name", F.col("_start").alias("row_key")).agg(text.alias("line"))


def marked_lines(lines: DataFrame, sep: str) -> DataFrame:
    return lines.withColumns({"_open": ends_open(F.col("line"), sep), "_stay": ends_open(F.col("line"), sep, inside=True)})


def torn_files(lines: DataFrame, sep: str) -> DataFrame:
    """Files with a line that ends inside quotes: one row per file, combined on the map side."""
    return lines.where(ends_open(F.col("line"), sep)).select("file_path").distinct()


def records(lines: DataFrame, sep: str = ",", width: int = BLOCK_WIDTH) -> DataFrame:
    """study, file_path, file_name, row_key, fields: each record of each file
    parsed once, in a stored table.  Blank lines are no records; a record's line
    end may be CRLF, and a byte order mark before it is left out."""
    lines = lines.withColumn("line", without_bom(F.col("line")))
    torn = stored_table(torn_files(lines, sep), "torn")
    whole = lines
    if not torn.isEmpty():
        broken = lines.join(torn, "file_path", "left_semi")
        whole = lines.join(torn, "file_path", "left_anti").unionByName(glued(marked_lines(broken, sep), width))
    end = F.when(F.col("line").endswith("\r"), F.substr("line", F.lit(1), F.length("line") - 1)).otherwise(F.col("line"))
    whole = whole.withColumn("line", end).where(F.col("line") != "")
    parsed = whole.select("study", "file_path", "file_name", "row_key", record_fields(F.col("line"), sep).alias("fields"))
    return stored_table(parsed, "records")


def without_bom(line: Column) -> Column:
    return F.when(line.startswith("\ufeff"), F.substr(line, F.lit(2))).otherwise(line)


def open_quote_issues(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Files that end inside quotes."""
    lines = lines.withColumn("line", without_bom(F.col("line")))
    broken = marked_lines(lines.join(torn_files(lines, sep), "file_path", "left_semi"), sep)
    lost = line_blocks(broken).where("_lost").select("study", "file_name").distinct()
    return lost.select("study", F.lit("S3").alias("check"), F.lit("warning").alias("severity"), F.col("file_name").alias("object"),
                       F.lit("ends inside quotes").alias("detail"))
