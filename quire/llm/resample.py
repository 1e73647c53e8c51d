"""Importance resampling towards a target distribution, with segment deduplication.

Features are runs of 1 to ``max_n`` consecutive words, hashed into buckets.  Newlines are
never part of a word, so they cut a text into lines whose features can be counted apart:
equal lines are aggregated first, a distinct line's features are counted once and
multiplied by its occurrences, and the runs that cross a line's end (none if ``max_n``
is 1) are counted from the texts and added.  What a bucket's features gain under the
target, relative to the corpus, is a table of ``buckets`` numbers; a document's weight is
the sum over its features, and Gumbel noise from a hash of its id turns weights into
scores whose highest are a draw without replacement.

Cases: a null or empty text, or one without a word, has no feature and weight 0; equal
rows weigh alike and rank in any order among them; a null id is hashed as an empty
string and ranks behind all ids of its score; texts and lines of any length are read
whole; an empty corpus or target leaves its counts zero; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored, utf8
from quire.operators.ordering import sorted_positions

BUCKETS = 10_000
#: Words longer than this are hashed anew each time; the memo of a task holds so many others.
LONG_WORD, MEMO = 64, 300_000
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c in _WORD else 32 for c in range(256))


def words_of(data: bytes) -> list[bytes]:
    """Words of a text in UTF-8: runs of digits, ASCII letters (lower-cased) and all non-ASCII characters."""
    return data.translate(_LOWER).split()


def features_of(words: list[bytes], max_n: int) -> list[bytes]:
    """All runs of 1 to ``max_n`` consecutive words."""
    found = words if max_n == 1 else list(words)
    for n in range(2, max_n + 1):
        found += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return found


def crossing_features(data: bytes, max_n: int) -> list[bytes]:
    """The runs of 2 to ``max_n`` words that do not lie within one line."""
    words, line_of = [], []
    for i, line in enumerate(data.split(b"\n")):
        more = words_of(line)
        words += more
        line_of += [i] * len(more)
    return [
        b" ".join(words[i : i + n])
        for n in range(2, max_n + 1)
        for i in range(len(words) - n + 1)
        if line_of[i] != line_of[i + n - 1]
    ]


class Memo(dict):
    """A word's value, worked out once while it is held; long words are not held."""

    def __init__(self, value):
        super().__init__()
        self.value = value

    def __missing__(self, word: bytes) -> int:
        found = self.value(word)
        if len(word) <= LONG_WORD:
            self[word] = found
        return found

    def of(self, words: list[bytes]) -> list[int]:
        if len(self) > MEMO:
            self.clear()
        return list(map(self.__getitem__, words))


def _summed(rows: DataFrame, buckets: int, features) -> DataFrame:
    """Rows of (times, text) to (bucket, n), one sum per task."""

    def run(batches):
        memo = Memo(lambda w: zlib.crc32(w) % buckets)
        counts = np.zeros(buckets, np.int64)
        for b in batches:
            for times, data in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                np.add.at(counts, memo.of(features(data)), times)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    return rows.mapInArrow(run, "bucket long, n long")


def bucket_counts(docs: DataFrame, text_col: str = "text", max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how often features of all texts fall into each bucket (absent: 0)."""
    lines = docs.select(F.explode(F.split(text_col, "\n")).alias("line"))
    lines = lines.where(F.col("line").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    lines = lines.groupBy("line").agg(F.count(F.lit(1)).alias("times")).select("times", "line")
    parts = _summed(lines, buckets, lambda data: features_of(words_of(data), max_n))
    if max_n > 1:
        texts = docs.select(F.lit(1).cast("long").alias("times"), F.col(text_col).alias("text"))
        parts = parts.unionByName(_summed(texts, buckets, lambda data: crossing_features(data, max_n)))
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _array(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets)
    for r in counts.collect():  # one row a bucket at most
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln of the ratio of add-one estimates) per bucket, from two ``bucket_counts``."""
    s, t = _array(source, buckets), _array(target, buckets)
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def document_weights(
    docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_n: int = 1
) -> DataFrame:
    """id, n_words, n_features, weight of every row; a map over whole texts."""
    from pyspark.sql import types as T

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table, buckets = gains.tolist(), len(gains)

    def run(batches):
        memo = Memo(lambda w: table[zlib.crc32(w) % buckets])
        for b in batches:
            found = []
            for data in utf8(b.column(1)):
                words = words_of(data)
                n = len(words)
                values = memo.of(features_of(words, max_n))
                found.append((n, len(values), sum(values)))
            cols = np.array(found, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(cols[:, i]) for i in range(3))],
                schema=pa.schema([b.schema.field(0), *((x, pa.int64()) for x in ("n_words", "n_features", "weight"))]),
            )

    longs = [T.StructField(x, T.LongType()) for x in ("n_words", "n_features", "weight")]
    return rows.mapInArrow(run, T.StructType([rows.schema.fields[0], *longs]))


def gumbel(id_: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise), drawn from the first 32 bits of sha256("<seed>:<id>")."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    max_n: int = 1,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_features, weight, score, rank of every row of ``docs``.

    Of the N rows with ``min_words`` words, the floor(``percent`` * N / 100) highest scores
    are drawn and ranked from 1, ties to the smaller id; ``rank`` is null in all others.
    """
    gains = bucket_gains(
        bucket_counts(docs, text_col, max_n, buckets), bucket_counts(target, text_col, max_n, buckets), buckets
    )
    rows = document_weights(docs, gains, id_col, text_col, max_n)
    rows = stored(rows.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "weights")
    fit = F.col("n_words") >= min_words
    drawn = rows.where(fit).count() * percent // 100
    # rows that tie in score and id spread over the ranges by their other columns
    placed = sorted_positions(rows.where(fit), [F.desc("score"), F.asc_nulls_last("id"), F.asc("weight"), F.asc("n_features")], "at")
    ranked = placed.select(
        "id", "n_features", "weight", "score", F.when(F.col("at") < drawn, F.col("at") + 1).alias("rank")
    )
    rest = rows.where(~fit).select("id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
