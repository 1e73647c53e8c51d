"""Positions within groups without a single-task hot group.

``row_number() over (partition by g order by o)`` sends a whole group to one
task.  When one participant or file holds a third of all rows that task is the
whole job.  ``group_positions`` computes the same 0-based position with the
group split by a **function of the row alone**, the same in every plan, task
and retry:

1. a row's block is ``floor(order value / width)``; a struct order (split
   offset, line id) is cut by its last number within the ones before;
2. a window numbers the rows of one (group, block), at most ``width`` order
   values;
3. a table of ``(group, block) -> rows`` gets prefix sums over a group's blocks
   (and the group's first values on request);
4. position = rows in earlier blocks + position in the block, joined on
   ``(group, block)``, whose keys are as small as a block.

``sorted_positions`` numbers a whole table by any sortable columns, strings too:
the rows are range-partitioned and sorted once, the sorted rows are stored with
their range and their index in it, so the boundaries are drawn only once, and a
table of ``range -> rows`` gets prefix sums.  ``dense_ranks`` numbers distinct
values the same way, after the repeats are aggregated away on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.util import stored_table

BLOCK_WIDTH = 1 << 16


def order_block(df: DataFrame, column: str, width: int) -> Column:
    """Block of an order value; blocks sort as the values do."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.StructType):
        *lead, last = kind.names
        return F.struct(*[c[x].alias(x) for x in lead], F.floor(c[last] / width).alias(last))
    if isinstance(kind, T.NumericType):
        return F.floor(c / width)
    raise TypeError(f"{column} is {kind.simpleString()}: the first order column must be a number or a struct ending in one")


def group_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position",
                    first: Mapping[str, Column] | None = None, width: int = BLOCK_WIDTH) -> DataFrame:
    """``df`` with the 0-based position ``out`` of each row within its group
    and, per entry of ``first``, that expression's value on the group's first
    row.  Null keys form groups like any other value."""
    first = dict(first or {})
    rows = df.withColumn("_block", order_block(df, order[0], width))
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    rows = rows.withColumn("_inside", F.row_number().over(inside) - 1)
    names = {f"_f{i}": name for i, name in enumerate(first)}
    lead = F.struct(*[F.col(o) for o in order])
    blocks = df.withColumn("_block", order_block(df, order[0], width)).groupBy(*keys, "_block").agg(
        F.count(F.lit(1)).alias("_n"), *[F.min_by(F.struct(first[n].alias("v")), lead).alias(k) for k, n in names.items()])
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_block").alias("_kb"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *[F.first(k).over(whole)["v"].alias(n) for k, n in names.items()],
    )
    same = F.col("_block").eqNullSafe(F.col("_kb"))
    for i, k in enumerate(keys):
        same = same & rows[k].eqNullSafe(F.col(f"_k{i}"))
    return rows.join(blocks, same).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_inside")).alias(out), *list(first))


def sorted_parts(df: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """``df`` range-partitioned and sorted by ``order``, stored with ``_range`` and
    ``_row`` (the 0-based index in the range), and the table of its ranges:
    ``_range, _rows, _before`` (rows in earlier ranges).  Range and index give a
    row's place in the whole order; no task sees more than its range."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumns({"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    placed = stored_table(placed.withColumn("_row", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))), "sorted")
    ranges = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed, ranges.withColumn("_before", before)  # a row per range


def sorted_positions(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """``df`` with the 0-based position ``out`` of each row in the order of ``order``.

    Rows that tie on ``order`` share a range, so it should end in a column that tells
    rows apart where many tie; rows equal in all of ``order`` get any order among them.
    ``df`` is read twice (Spark samples it for the boundaries): pass a stored table
    if it is costly.
    """
    placed, ranges = sorted_parts(df, order)
    return placed.join(ranges, "_range").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_row")).alias(out))


def dense_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank") -> DataFrame:
    """Distinct ``(keys, value)`` rows with the 1-based dense rank ``out`` of ``value``
    within ``keys`` (what ``dense_rank`` gives), without a window over a whole group."""
    distinct = df.select(*keys, value).distinct()
    spots = sorted_positions(distinct, [F.col(k) for k in (*keys, value)], "_at")
    if not keys:
        return spots.select(value, (F.col("_at") + 1).alias(out))
    starts = spots.groupBy(*keys).agg(F.min("_at").alias("_start")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_start")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & spots[k].eqNullSafe(F.col(f"_k{i}"))
    return spots.join(starts, same).select(*keys, value, (F.col("_at") - F.col("_start") + 1).alias(out))
