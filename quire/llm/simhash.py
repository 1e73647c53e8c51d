"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint has 64 bits.  Cut into 2-bit segments, the numbers of set bits per segment
form a vector whose Manhattan distance between two fingerprints never exceeds their
Hamming distance.  Fingerprints within ``MAX_BITS`` = 4 bits (the bound holds up to 5)
are therefore within Manhattan distance 2 in one of the two halves, 16 segments each,
and two points of a grid within distance 2 have a common cell within distance 1 of both.
So every distinct fingerprint goes to its own cell of each half and to the cells one step
away (about 25 of some 2 ** 24 likely cells), only fingerprints that meet in a cell are
compared, and each such pair is verified by counting the differing bits.

Within a cell the links found are reduced to a spanning forest, so neither a task nor the
shuffle ever holds all pairs of a large group; forests are joined by alternating star
contraction (min aggregations and joins, written to the shared folder each round).  Equal
fingerprints are one point, whatever number of documents shares them.

Cases: null and empty texts, and texts of white space, have fingerprint zero and are
linked like any other; repeated rows get equal answers; ties in the order of documents do
not matter since the component is named by its least id (null if all its ids are null);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import fresh, stored, utf8

MAX_BITS = 4
SHINGLE = 4
_EVEN = np.uint64(0x55555555)
_HALF = np.uint64(0xFFFFFFFF)
#: Runs up to this length are compared by offset, longer ones by a search from link to link.
SHORT_RUN = 24
#: Rows of cells that a task looks at together.
ROWS_AT_ONCE = 400_000


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text in UTF-8 (A-Z lower-cased, XXH64 with seed 42)."""
    words = data.lower().split()  # on bytes both know ASCII only
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(words[i : i + shingle]), 42) for i in range(last)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > last, bitorder="little")
    return int(bits.view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, print (the fingerprint as a signed long) for every row."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def run(batches):
        for b in batches:
            prints = np.array([fingerprint(x, shingle) for x in utf8(b.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(prints.view(np.int64))],
                schema=pa.schema([b.schema.field(0), b.schema.field(1), pa.field("print", pa.int64())]),
            )

    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("print", T.LongType())])
    return rows.mapInArrow(run, schema)


def cells_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, row) for every grid cell at most one step from a fingerprint's vector, in both halves.

    A vector is coded with two bits per segment; a step changes one segment's count by one.
    """
    cells, rows = [], []
    index = np.arange(len(prints))
    for half in range(2):
        bits = (prints >> np.uint64(32 * half)) & _HALF
        code = (bits & _EVEN) + ((bits >> np.uint64(1)) & _EVEN)
        base = code | np.uint64(half << 32)
        cells.append(base)
        rows.append(index)
        for i in range(16):
            count = (code >> np.uint64(2 * i)) & np.uint64(3)
            step = np.uint64(1 << 2 * i)
            up, down = count < 2, count > 0
            cells += [base[up] + step, base[down] - step]
            rows += [index[up], index[down]]
    return np.concatenate(cells), np.concatenate(rows)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links (a, b) with the least node of its component, roots left out."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = where[: len(a)], where[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]


def links_in_cells(cells: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among fingerprints that share a cell; rows are sorted by cell."""
    start = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    size = np.diff(np.append(start, len(cells)))
    found_a, found_b = [], []
    longest = min(int(size.max()), SHORT_RUN) if len(size) else 0
    short = np.repeat(size <= SHORT_RUN, size)
    for d in range(1, longest):
        i = np.flatnonzero((cells[d:] == cells[:-d]) & short[d:])
        if not len(i):
            break
        near = np.bitwise_count(prints[i] ^ prints[i + d]) <= max_bits
        found_a.append(prints[i[near]])
        found_b.append(prints[i[near] + d])
    for first, n in zip(start[size > SHORT_RUN], size[size > SHORT_RUN]):
        rest = prints[first : first + n]
        while len(rest):
            # from one fingerprint to all it reaches; what is reached is not compared again
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                x = queue.pop()
                near = np.bitwise_count(rest ^ x) <= max_bits
                if near.any():
                    got = rest[near]
                    found_a.append(np.full(len(got), x))
                    found_b.append(got)
                    queue.extend(got)
                    rest = rest[~near]
    if not found_a:
        return prints[:0], prints[:0]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    return forest(a, b) if len(a) else (a, b)


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a > b: links of distinct fingerprints (column ``print``) whose components are
    those of all pairs within ``max_bits``."""
    if max_bits > 5:
        raise ValueError("the two halves cover up to 5 differing bits")

    def spread(batches):
        for b in batches:
            p = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            cells, rows = cells_of(p)
            for at in range(0, len(cells), 100_000):
                cut = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[cut].view(np.int64)), pa.array(p[rows[cut]].view(np.int64))], names=["cell", "print"]
                )

    def link(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def found(cells, points):
            a, b = links_in_cells(cells, points.view(np.uint64), max_bits)
            a, b = a.view(np.int64), b.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

        for batch in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            waiting += batch.num_rows
            if waiting >= ROWS_AT_ONCE:
                cells, points = (np.concatenate(x) for x in zip(*held))
                last = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on
                if last:
                    yield found(cells[:last], points[:last])
                held, waiting = [(cells[last:], points[last:])], len(cells) - last
        if waiting:
            yield found(*(np.concatenate(x) for x in zip(*held)))

    spread_out = prints.select("print").mapInArrow(spread, "cell long, print long")
    met = spread_out.repartition("cell").sortWithinPartitions("cell").mapInArrow(link, "a long, b long")
    return met.distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(a, b): every linked node but the least of its component, with that least node.

    Alternating large-star and small-star until nothing changes.  A node's least
    neighbour is a min aggregation, so a hub's neighbours never meet in one task.
    """

    def state(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(links.select("a", "b"), name)
    before = state(edges)
    while True:
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionAll(edges.select("b", "a"))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        low = stored(low, name)  # joined from a table of its own, so Spark can split the rows of a hub
        larger = edges.select(F.col("b").alias("v"), F.col("a").alias("u")).join(low, "v")
        # (u, m) with u > m: u hangs from the least neighbour of its smaller neighbour
        hung = larger.select(F.col("u").alias("a"), F.col("m").alias("b")).distinct()
        least = hung.groupBy("a").agg(F.min("b").alias("m"))
        joined = hung.join(least, "a")
        moved = joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(least.select("a", F.col("m").alias("b")).unionAll(moved).distinct(), name)
        now = state(edges)
        if now == before:
            return edges
        before = now


def group_rows(docs: DataFrame, id_col: str, text_col: str, max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, print, root (the component's fingerprint of least value) for every row."""
    rows = stored(with_fingerprints(docs, id_col, text_col, shingle), "prints")
    tree = components(near_links(rows.select("print").distinct(), max_bits))
    hung = tree.select(F.col("a").alias("print"), F.col("b").alias("root"))
    return rows.join(hung, "print", "left").withColumn("root", F.coalesce("root", "print"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, shingle: int = SHINGLE
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for every row."""
    rows = stored(group_rows(docs, id_col, text_col, max_bits, shingle), "groups")
    # a table of its own, so Spark can split the rows of a large component in the join
    names = stored(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "names")
    return rows.join(names, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, shingle: int = SHINGLE
) -> DataFrame:
    """One row of each component, that of the least id (then of the least text hash), with the columns of ``docs``."""
    rows = group_rows(docs, id_col, text_col, max_bits, shingle)
    first = rows.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first")
    )
    key, mark = fresh(docs, "keep_id"), fresh(docs, "keep_hash")
    chosen = first.select(F.col("first.doc_id").alias(key), F.col("first.text_hash").alias(mark)).distinct()
    hashed = docs.withColumn(mark, F.xxhash64(text_col))
    same = (F.col(id_col).eqNullSafe(chosen[key])) & (hashed[mark] == chosen[mark])
    return hashed.join(chosen, same, "left_semi").dropDuplicates([id_col, mark]).select(*docs.columns)
