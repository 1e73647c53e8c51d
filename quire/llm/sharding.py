"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of one text form a group that is never split.  Packing every group in one
task would not scale, so it runs in two levels, both best-fit-decreasing with the
open bins in a balanced tree by remaining capacity:

1. Groups above a grain (``1/grains`` of a shard's bytes, or of its rows) are few,
   at most ``2 * shards * grains``.  All smaller groups are packed where Spark's
   hash partitioning has put them, largest first, into cartons of one grain's
   capacity, or, for one small group in FINE, of 1/FINE of that, which evens out the
   shards later.  A partition leaves at most one carton of a kind less than half full,
   so there are at most ``4 * shards * grains`` cartons and two per partition.
2. The large groups and the cartons, a bounded list whatever the input's size, are
   packed into ``shards`` bins of the smallest capacity that best-fit-decreasing
   can do with.  A group larger than an even share gets a shard of its own and the
   others share the rest evenly.

Groups that hold many rows are looked up through a broadcast of that bounded list,
the others through a shuffle join, so no key is hot.  Slots are positions within
hash buckets of bounded size plus the rows of the buckets before.

Cases: a null text counts as empty (size 1); equal texts, nulls and empties among
them, share a shard; repeated rows get slots of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import stored


FINE = 16


class CapacityTree:
    """Balanced search tree (AA tree) of (remaining capacity, bin)."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root = None

    # a node is [key, level, left, right]
    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least key with at least ``size`` remaining."""
        node, best, want = self.root, None, (size, -1)
        while node is not None:
            if node[0] >= want:
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best

    def _add(self, node, key):
        if node is None:
            return [key, 1, None, None]
        side = 2 if key < node[0] else 3
        node[side] = self._add(node[side], key)
        return _split(_skew(node))

    def _remove(self, node, key):
        if node is None:
            return None
        if key < node[0]:
            node[2] = self._remove(node[2], key)
        elif key > node[0]:
            node[3] = self._remove(node[3], key)
        elif node[2] is None:
            return node[3]
        elif node[3] is None:
            return node[2]
        else:
            heir = node[3]
            while heir[2] is not None:
                heir = heir[2]
            node[0] = heir[0]
            node[3] = self._remove(node[3], heir[0])
        level = 1 + min(node[2][1] if node[2] else 0, node[3][1] if node[3] else 0)
        if level < node[1]:
            node[1] = level
            if node[3] and level < node[3][1]:
                node[3][1] = level
        node = _skew(node)
        if node[3]:
            node[3] = _skew(node[3])
            if node[3][3]:
                node[3][3] = _skew(node[3][3])
        node = _split(node)
        if node[3]:
            node[3] = _split(node[3])
        return node


def _skew(node):
    left = node[2]
    if left is not None and left[1] == node[1]:
        node[2], left[3] = left[3], node
        return left
    return node


def _split(node):
    right = node[3]
    if right is not None and right[3] is not None and right[3][1] == node[1]:
        node[3], right[2] = right[2], node
        right[1] += 1
        return right
    return node


class BestFit:
    """Best fit for sizes that arrive in descending order; bins open as needed."""

    def __init__(self, capacity: int):
        self.capacity, self.tree, self.bins = capacity, CapacityTree(), 0

    def place(self, size: int) -> int:
        fit = self.tree.tightest(size)
        if fit is None:
            left, at = self.capacity, self.bins
            self.bins += 1
        else:
            left, at = fit
            self.tree.remove(fit)
        if left > size:
            self.tree.add((left - size, at))
        return at


def pack(sizes: list[int], bins: int) -> list[int]:
    """Bin of each size, for ``bins`` bins of the smallest workable equal capacity.

    ``sizes`` must be descending.  A size above the even share of what is left takes
    a bin of its own first.
    """
    out, first, rest = [0] * len(sizes), 0, sum(sizes)
    while first < bins - 1 and first < len(sizes) and sizes[first] * (bins - first) > rest:
        out[first] = first
        rest -= sizes[first]
        first += 1
    left, n = sizes[first:], bins - first

    def packed(capacity: int) -> list[int] | None:
        fit, at = BestFit(capacity), []
        for s in left:
            at.append(fit.place(s))
            if fit.bins > n:
                return None
        return at

    if left:
        low = max(left[0], -(-rest // n))
        high, got = low, packed(low)
        while got is None:
            high += max(1, high // 256)
            got = packed(high)
        low = max(low, high - high // 256)
        while low < high:
            mid = (low + high) // 2
            if (trial := packed(mid)) is None:
                low = mid + 1
            else:
                high, got = mid, trial
        out[first:] = [first + b for b in got]
    return out


def pack_documents(
    docs: DataFrame,
    shards: int = 16,
    grains: int = 512,
    rows_per_bucket: int = 2000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("g1"),
            F.xxhash64(F.lit(1), text).alias("g2"),
        ),
        "shard-rows",
    )
    total, rows = base.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    grain = max(1, -(-total // (shards * grains)))
    fine_grain = max(1, grain // FINE)
    row_grain = max(1, -(-rows // (shards * grains)))
    groups = base.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    large = (F.col("bytes") > grain) | (F.col("n") > row_grain)

    def cartons(batches):
        # the rows of a partition arrive largest first: one best fit over all its batches
        coarse, fine, part = BestFit(grain), BestFit(fine_grain), TaskContext.get().partitionId() << 32
        for b in batches:
            rows = zip(b.column("bytes").to_pylist(), b.column("large").to_pylist(), b.column("g2").to_pylist())
            at = [
                None
                if large
                else part | fine.place(size) << 1
                if size <= fine_grain and not key % FINE
                else part | coarse.place(size) << 1 | 1
                for size, large, key in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column("g1"), b.column("g2"), b.column("bytes"), b.column("large"), pa.array(at, pa.int64())],
                names=["g1", "g2", "bytes", "large", "carton"],
            )

    placed = stored(
        groups.select("g1", "g2", "bytes", large.alias("large"))
        .sortWithinPartitions(F.col("bytes").desc(), "g1", "g2")
        .mapInArrow(cartons, "g1 long, g2 long, bytes long, large boolean, carton long"),
        "shard-groups",
    )
    # bounded by the grains, not by the input (see above)
    items = [(r.bytes, 1, r.g1, r.g2) for r in placed.where("large").collect()]
    items += [(r.b, 0, r.carton, 0) for r in placed.where("not large").groupBy("carton").agg(F.sum("bytes").alias("b")).collect()]
    items.sort(key=lambda x: (-x[0], *x[1:]))
    bins = pack([x[0] for x in items], shards)
    spark = docs.sparkSession
    of_group = spark.createDataFrame(
        [(x[2], x[3], b) for x, b in zip(items, bins) if x[1]], "g1 long, g2 long, shard int"
    )
    of_carton = spark.createDataFrame([(x[2], b) for x, b in zip(items, bins) if not x[1]], "carton long, shard int")
    keys = ["g1", "g2"]
    small = placed.where("not large").join(F.broadcast(of_carton), "carton").select(*keys, "shard")
    assigned = base.join(F.broadcast(of_group), keys).unionByName(
        base.join(F.broadcast(of_group), keys, "left_anti").join(small, keys).select(*keys, "doc_id", "size", "text_crc32", "shard")
    )
    buckets = max(1, -(-rows // (shards * rows_per_bucket)))
    assigned = stored(
        assigned.select(
            "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "g1"), F.lit(buckets)).alias("bucket")
        ),
        "shard-assigned",
    )
    before = (
        assigned.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n"))
    )
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return (
        assigned.withColumn("place", place)
        .join(before.select("shard", "bucket", "before"), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place") - 1).cast("long").alias("slot"))
    )
