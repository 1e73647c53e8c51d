"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams (1 to 4 characters of the
lower-cased letters, other characters being one space; hashed into ``DIM`` buckets) that
both hold, divided by the root of the product of their own numbers: a blended-spectrum
presence kernel.  Nystroem landmarks stand for the training texts, and one-versus-rest
kernel ridge regression is solved on them.  A score is the product of a batch's presence
matrix with the landmarks' presence matrix times the solution; the latter two do not
depend on the batch and are multiplied once.

Training takes a bounded sample (``sample`` texts in all, an equal number per language,
those of least text hash, each text once) and sends DIM / 8 bytes for each to the driver.
Prediction maps over whole texts without a shuffle.

Cases: a null text, or one without a letter, is ``und`` with score 0; without any
training row everything is ``und``; repeated rows get equal answers; ties go to the
first language in alphabetical order; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIM = 1 << 16
GRAMS = 4
_FOLD = None


def _fold_table() -> np.ndarray:
    """Lower-cased letter, or a space, for each character of the basic plane."""
    global _FOLD
    if _FOLD is None:
        _FOLD = np.array([ord(c.lower()[0]) if (c := chr(i)).isalpha() else 32 for i in range(1 << 16)], np.uint32)
    return _FOLD


def folded(text: str) -> np.ndarray:
    """Characters of the letters of a text with one space between runs of them; empty without a letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    table = _fold_table()
    high = codes > 0xFFFF
    out = table[np.where(high, 0, codes)]
    if high.any():
        values, where = np.unique(codes[high], return_inverse=True)
        out[high] = np.array([ord(chr(v).lower()[0]) if chr(v).isalpha() else 32 for v in values], np.uint32)[where]
    space = out == 32
    if space.all():
        return out[:0]
    keep = ~space
    keep[1:] |= ~space[:-1]
    return np.concatenate([[np.uint32(32)], out[keep], [np.uint32(32)]]) if len(out) else out


def mark_grams(chars: np.ndarray, row: np.ndarray) -> None:
    """Set the buckets of all n-grams of 1 to GRAMS characters in ``row``."""
    h = chars * np.uint32(0x9E3779B1)
    one = h
    for n in range(1, GRAMS + 1):
        if n > 1:
            if len(chars) < n:
                return
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + one[n - 1 :]
        row[((h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + np.uint32(n * 0x27D4EB2F)) >> np.uint32(16)] = 1


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    weights: np.ndarray  # DIM x languages: the landmarks' presence matrix times the solution

    def predict(self, texts: list[str | None], batch: int = 64) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        for at in range(0, len(texts), batch):
            part = [folded(t) if t else None for t in texts[at : at + batch]]
            presence = np.zeros((len(part), DIM), np.float32)
            for row, chars in zip(presence, part):
                if chars is not None and len(chars):
                    mark_grams(chars, row)
            size = presence.sum(1, dtype=np.float64)
            known = (size > 0) & bool(self.langs)
            raw = (presence @ self.weights) / np.sqrt(np.maximum(size, 1))[:, None] if self.langs else None
            for i in range(len(part)):
                if known[i]:
                    best = int(raw[i].argmax())
                    langs.append(self.langs[best])
                    scores.append(float(np.clip((raw[i, best] + 1) / 2, 0, 1)))
                else:
                    langs.append("und")
                    scores.append(0.0)
        return langs, scores


def fit(presence: np.ndarray, langs: list[str], landmarks: int = 256, ridge: float = 1e-3) -> LanguageModel:
    """Kernel ridge regression on Nystroem features; ``presence`` is 0/1, texts x DIM."""
    names = sorted(set(langs))
    if not names:
        return LanguageModel((), np.zeros((DIM, 0), np.float32))
    x = presence.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    # landmarks: equally many of each language, in the order given
    rank, seen = [], dict.fromkeys(names, 0)
    for lang in langs:
        rank.append(seen[lang])
        seen[lang] += 1
    chosen = np.array(sorted(range(len(langs)), key=lambda i: (rank[i], langs[i]))[:landmarks])
    marks = x[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # landmarks x features
    features = (x @ marks.T).astype(np.float64) @ root
    target = np.array([[1.0 if lang == n else -1.0 for n in names] for lang in langs])
    gram = features.T @ features + ridge * len(langs) * np.eye(features.shape[1])
    solution = root @ np.linalg.solve(gram, features.T @ target)  # landmarks x languages
    return LanguageModel(tuple(names), (marks.T @ solution.astype(np.float32)).astype(np.float32))


def training_sample(rows: DataFrame, sample: int) -> DataFrame:
    """lang, text: about ``sample // languages`` distinct texts of each language, those of least hash.

    A first cut by hash thins each language to twice that number, so the ranking
    never sees a whole language; equal texts meet before it.
    """
    rows = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"))
    known = counts.collect()  # one row per language
    each = max(1, sample // max(1, len(known)))
    wide = 1 << 40
    cut = F.lit(0).cast("long")
    for r in known:
        share = min(1.0, 2 * (each + 20) / max(1, r["n"]))
        cut = F.when(F.col("lang") == r["lang"], F.lit(int(share * wide))).otherwise(cut)
    thin = rows.where(F.pmod("h", F.lit(wide)) < cut).groupBy("lang", "h").agg(F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(wide)), "h")
    return thin.withColumn("k", F.row_number().over(order)).where(F.col("k") <= each).select("lang", "h", "text")


def train(rows: DataFrame, sample: int = 1024, landmarks: int = 256, ridge: float = 1e-3) -> LanguageModel:
    """Model of the rows' lang and text; rows without either, or without a letter, teach nothing."""

    def packed(batches):
        for b in batches:
            bits = []
            for t in b.column("text").to_pylist():
                row = np.zeros(DIM, np.uint8)
                chars = folded(t)
                if len(chars):
                    mark_grams(chars, row)
                bits.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("lang"), b.column("h"), pa.array(bits, pa.binary())], names=["lang", "h", "bits"]
            )

    chosen = training_sample(rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()), sample)
    got = chosen.mapInArrow(packed, "lang string, h long, bits binary").collect()
    got = sorted(((r["h"], r["lang"], bytes(r["bits"])) for r in got if any(r["bits"])), key=lambda r: r[:2])
    bits = np.frombuffer(b"".join(r[2] for r in got), np.uint8).reshape(len(got), DIM // 8)
    return fit(np.unpackbits(bits, axis=1), [r[1] for r in got], landmarks, ridge)


def predict(docs: DataFrame, model: LanguageModel, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred and score for every row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(*keep, F.col(text_col).alias("text_"))
    width = len(rows.columns) - 1
    extra = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*rows.schema.fields[:width], *extra])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM x languages numbers

    def run(batches):
        for b in batches:
            langs, scores = shared.value.predict(b.column(width).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:width], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                schema=pa.schema([*list(b.schema)[:width], *list(arrow)[width:]]),
            )

    return rows.mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """The fifth of the documents that teaches nothing: crc32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))
