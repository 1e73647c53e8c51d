"""Phrase collocations by top-order marginalisation.

Only the longest windows are ever counted: every word leads one row of ``order`` columns,
itself and the words one, two, ... places on in its piece, padded with nulls where the
piece ends.  Equal windows are counted, and a ROLLUP over the columns sums the counts into
those of every shorter phrase (the windows that begin with it) down to the total of a
group.  No text is exploded once per phrase length.

A task first counts its own windows, a bounded number of words at a time, and sends them
on as sorted lines, one row for each part of the pairs of leading words; the number of
parts follows the size of the corpus.  Where a part's rows meet, the counts are added up,
and a window's tail that makes a phrase of fewer than ``min_count`` occurrences is padded
off: no such phrase can be a candidate or a part of one, and the counts of its beginnings
stay the same.  What the ROLLUP has left to add up are the frequent phrases and the words.

A candidate's parts occur at least as often as the candidate, so the tables that meet in
the joins hold phrases of ``min_count`` or more occurrences only, each once.

Cases: null and empty texts hold no word; a null group counts as ``und``; a piece of one
word leads one window, all pads behind it; texts of any length are split within their
row; repeated rows count as often as they occur; scores that tie are ranked by count,
then by the phrase's bytes; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import stored, utf8

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_SPLIT = bytes(10 if c in _PIECE_ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words that a task counts together, and bytes of text for each part that the windows are dealt to.
WORDS_AT_ONCE = 1_500_000
PART_BYTES = 4 << 20
#: Stands for a pad in the lines; it ends pieces, so no word holds it.
PAD = b","
#: The best of a group are found in so many shares first, so no task ranks a whole group.
SHARES = 64


def pieces_of(data: bytes) -> list[list[bytes]]:
    """The words of each piece of a text in UTF-8, A-Z lower-cased; pieces end at ``.,;:!?`` and
    line breaks, words at spaces and tabs."""
    return [words for piece in data.translate(_SPLIT).split(b"\n") if (words := piece.split())]


def count_windows(columns: list[np.ndarray], times: np.ndarray | None, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of ``columns`` (numbers below ``size``) in ascending order, and how often each occurs."""
    key = np.zeros(len(columns[0]), np.int64)
    for c in columns:  # a prefix's place among the distinct ones and the next word make the next prefix
        _, first, key = np.unique(key * size + c, return_index=True, return_inverse=True)
    n = np.bincount(key, times, minlength=len(first)) if times is not None else np.bincount(key, minlength=len(first))
    return [c[first] for c in columns], n.astype(np.int64)


def lead_columns(ids: list[int], order: int) -> list[np.ndarray]:
    """Column k holds, for each word, the word k places on; ``ids`` has order - 1 zeros behind each piece."""
    flat = np.array(ids, np.int64)
    return [np.append(flat[k:], np.zeros(k, np.int64))[flat > 0] for k in range(order)]


def lines_by_part(number: dict[bytes, int], ids: list[int], order: int, parts: int, group: str) -> pa.RecordBatch:
    """grp, part, lines: the windows of one group, each line a window and its count."""
    columns, n = count_windows(lead_columns(ids, order), None, len(number) + 1)
    mixed = np.array([0, *map(zlib.crc32, number)], np.uint64)
    with np.errstate(over="ignore"):
        pair = mixed[columns[0]] * np.uint64(0x9E3779B97F4A7C15) + mixed[columns[1]] * np.uint64(0xC2B2AE3D27D4EB4F)
    part = ((pair >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    by_part = np.argsort(part, kind="stable")
    words = pa.array([PAD, *number], pa.binary())
    text = [words.take(pa.array(c[by_part])) for c in columns]
    lines = pc.binary_join_element_wise(*text, pa.array(n[by_part]).cast(pa.string()).cast(pa.binary()), b" ")
    part = part[by_part]
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    bounds = pa.array(np.append(starts, len(part)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([group] * len(starts)),
            pa.array(part[starts]),
            pc.binary_join(pa.ListArray.from_arrays(bounds, lines), b"\n"),
        ],
        names=["grp", "part", "lines"],
    )


def lead_windows(docs: DataFrame, order: int, parts: int, text_col: str = "text", group_col: str = "lang") -> DataFrame:
    """grp, part, lines: the padded longest windows of all texts, counted by task."""
    rows = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("grp"), F.col(text_col).alias("text"))

    def run(batches):
        held: dict[str, tuple[dict[bytes, int], list[int]]] = {}
        waiting = 0
        for b in batches:
            for group, data in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                number, ids = held.setdefault(group, ({}, []))
                for words in pieces_of(data):
                    ids += [number.setdefault(w, len(number) + 1) for w in words]
                    ids += [0] * (order - 1)
                    waiting += len(words)
                if waiting >= WORDS_AT_ONCE:
                    yield from (lines_by_part(*x, order, parts, g) for g, x in held.items() if x[1])
                    held, waiting = {}, 0
        yield from (lines_by_part(*x, order, parts, g) for g, x in held.items() if x[1])

    return rows.mapInArrow(run, "grp string, part long, lines binary")


def pad_rare(columns: list[np.ndarray], n: np.ndarray, min_count: int) -> None:
    """Sets the tails of sorted windows to 0 where the phrase up to there has under ``min_count`` occurrences."""
    for k in range(len(columns), 1, -1):
        new = np.zeros(len(n), bool)
        new[:1] = True
        for c in columns[:k]:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(n, starts) if len(n) else n
        columns[k - 1] = np.where(np.repeat(sums, np.diff(np.append(starts, len(n)))) >= min_count, columns[k - 1], 0)


def merged_windows(order: int, min_count: int):
    """For one part of a group: its windows' counts added up, rare tails padded off."""

    def run(key: tuple[pa.Scalar, ...], met: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {PAD: 0}
        cells = b"\n".join(met.column("lines").to_pylist()).split()
        ids = [
            np.fromiter((number.setdefault(w, len(number)) for w in cells[k :: order + 1]), np.int64) for k in range(order)
        ]
        times = np.array(cells[order :: order + 1]).astype(np.int64)
        del cells
        columns, n = count_windows(ids, times, len(number))
        pad_rare(columns, n, min_count)
        columns, n = count_windows(columns, n, len(number))
        words = pa.array([None, *list(number)[1:]], pa.binary()).cast(pa.string())
        return pa.table(
            [pa.array([key[0].as_py()] * len(n), pa.string()), *(words.take(pa.array(c)) for c in columns), pa.array(n)],
            names=["grp", *(f"w{k}" for k in range(order)), "f"],
        )

    return run


def phrase_counts(
    docs: DataFrame, order: int, min_count: int, text_col: str = "text", group_col: str = "lang"
) -> DataFrame:
    """grp, size, phrase (words joined by a space), f: the phrases of 2 to ``order`` words with
    ``min_count`` occurrences or more, and all words; size 0 with a null phrase is the group's number of words."""
    slots = [f"w{k}" for k in range(order)]
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    met = lead_windows(docs, order, size // PART_BYTES + 1, text_col, group_col).groupBy("grp", "part")
    fields = ", ".join(f"{s} string" for s in slots)
    padded = met.applyInArrow(merged_windows(order, min_count), f"grp string, {fields}, f long")
    longest = stored(padded.groupBy("grp", *slots).agg(F.sum("f").alias("f")), "windows")
    sums = longest.rollup("grp", *slots).agg(F.sum("f").alias("f"), F.grouping_id().alias("rolled"))
    # rolled has a bit for each column summed over; a prefix that ends in a pad is counted as the shorter one
    size = reduce(
        lambda rest, k: F.when(F.col("rolled") == (1 << (order - k)) - 1, F.lit(k)).otherwise(rest),
        range(order + 1),
        F.lit(-1),
    )
    ends = F.coalesce(*(F.when(F.col("size") == k, F.col(slots[k - 1]).isNotNull()) for k in range(1, order + 1)), F.lit(True))
    found = sums.withColumn("size", size).where((F.col("size") >= 0) & ends)
    return found.select("grp", "size", F.when(F.col("size") > 0, F.concat_ws(" ", *slots)).alias("phrase"), "f")


def _exact(c: str, digits: int) -> Column:
    return F.col(c).cast(f"decimal({digits},0)")


def collocations(
    docs: DataFrame, order: int = 3, min_count: int = 10, top: int = 2000, text_col: str = "text", group_col: str = "lang"
) -> DataFrame:
    """grp, rank, phrase, a, l, r, n, score: the ``top`` phrases of each group.

    A phrase of 2 to ``order`` words with ``a`` >= ``min_count`` occurrences is scored at its
    weakest cut, floor(1000000 * a * a / (l * r)) with ``l`` and ``r`` the occurrences of the
    two parts (of equal scores the earliest cut); it goes if a longer candidate around it
    has at least half of its occurrences.  Products are decimals of 38 digits, exact as
    long as no phrase occurs 10 ** 15 times.
    """
    often = phrase_counts(docs, order, min_count, text_col, group_col)
    often = stored(often.where((F.col("f") >= min_count) | (F.col("size") == 0)), "phrases")
    totals = often.where("size = 0").select("grp", F.col("f").alias("n"))
    grams = often.where("size > 0")
    found = grams.where("size > 1").select("grp", "phrase", F.split("phrase", " ").alias("words"), F.col("f").alias("a"))

    def joined(words: Column, first: Column | int, n: Column | int) -> Column:
        return F.array_join(F.slice(words, first, n), " ")

    cut = found.select(
        "grp", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).select(
        "grp", "phrase", "a", "k",
        joined(F.col("words"), 1, F.col("k")).alias("first"),
        joined(F.col("words"), F.col("k") + 1, F.size("words")).alias("rest"),
    )
    left = grams.select("grp", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = grams.select("grp", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    parts = cut.join(left, ["grp", "first"]).join(right, ["grp", "rest"])
    square = _exact("a", 15) * _exact("a", 15)
    # the quotient is at most 1000000: a part occurs at least as often as the phrase
    score = F.call_function("div", (square * F.lit(1_000_000).cast("decimal(7,0)")), _exact("l", 19) * _exact("r", 19))
    weakest = parts.withColumn("score", score).groupBy("grp", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("at")
    )
    inner = found.where(F.size("words") > 2).select("grp", "a", "words").select(
        "grp", "a", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("m")
    ).select(
        "grp", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)).alias("i")
    ).select("grp", "a", joined(F.col("words"), F.col("i"), F.col("m")).alias("phrase"))
    around = inner.groupBy("grp", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(around, ["grp", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a"))
    )
    best = [F.col("at.score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    some = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("grp", "share").orderBy(*best)))
    some = some.where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*best)).cast("long"))
    ranked = ranked.where(F.col("rank") <= top).join(totals, "grp")
    return ranked.select("grp", "rank", "phrase", "a", F.col("at.l").alias("l"), F.col("at.r").alias("r"), "n", F.col("at.score").alias("score"))
