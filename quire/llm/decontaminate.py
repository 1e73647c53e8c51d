"""Benchmark decontamination with one Aho-Corasick automaton over the test items.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after A-Z are lower-cased.
Every ``window`` consecutive words of an item (all of them, if it has fewer) are a
pattern over word numbers, so a document is scanned once, word by word, however many
items there are.  Hits are kept as word positions and mapped back to character offsets
of the original text.

The items are a query set: they are read in blocks of at most ``block_bytes`` of text,
each block becomes one automaton on every worker, and with more than one block the
documents are scanned once per block.  Documents never shuffle.

Cases: null and empty texts have no word and no hit; an item without a word has no
window; a null item id counts as an empty id; items with equal ids count once; repeated
rows get equal answers; empty tables give no rows, or no hits; other columns pass through.
"""

from __future__ import annotations

import re
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import fresh

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(_SPAN)),
        T.StructField("words", T.BinaryType()),
    ]
)


# each byte of a word lower-cased, each other byte a space
_WORD_BYTES = bytes(c if WORD.match(bytes([c])) else 32 for c in bytes(range(256)).lower())


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_WORD_BYTES).split()


class ItemScanner:
    """Automaton over the windows of one block of items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text))
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(ids[i : i + window], set()).add(item)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, who in owners.items():
            self.machine.add_word(key, (len(key), sorted(who)))
        self.empty = not owners
        if owners:
            self.machine.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges [first, after) of all occurrences, and the items they come from."""
        if self.empty or not words:
            return [], set()
        spans, items = [], set()
        for last, (size, who) in self.machine.iter(tuple(map(self.numbers.get, words, repeat(0)))):
            spans.append((last - size + 1, last + 1))
            items.update(who)
        return spans, items


def char_spans(data: bytes, hit: np.ndarray) -> list[dict]:
    """Character ranges of the maximal runs of hit words in the original text."""
    at = [m.span() for m in WORD.finditer(data.lower())]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    out, byte, char = [], 0, 0
    for first, after in zip(edge[::2], edge[1::2]):
        pair = []
        for to in (at[first][0], at[after - 1][1]):
            char += len(data[byte:to].decode("utf-8"))
            byte = to
            pair.append(char)
        out.append({"start": pair[0], "end": pair[1]})
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[list[tuple[str, bytes]]]:
    """The items that have a text, in blocks of about ``block_bytes``, fetched one block at a time."""
    rows = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text")
    ).where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b) if n > 1 else rows
        yield sorted((r["id"], r["text"].encode()) for r in part.collect())


def find_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    block_bytes: int = 8 << 20,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    out: str = "hits",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (all columns, or ``keep`` and the text) and as last column, named ``out`` or longer
    where that is taken, a struct of RESULT."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = list(docs.columns) if keep is None else list(dict.fromkeys([*keep, text_col]))
    df = docs.select(*kept)
    out = fresh(df, out)
    at, width = kept.index(text_col), len(kept)
    schema = T.StructType([*df.schema.fields, T.StructField(out, RESULT)])
    arrow = to_arrow_schema(schema)
    for k, block in enumerate(item_blocks(items, item_col, item_text_col, block_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared, more=k > 0):
            scanner = ItemScanner(shared.value, window)
            for b in batches:
                texts = b.column(at).cast(pa.binary()).to_pylist()
                old = b.column(width).to_pylist() if more else [None] * len(texts)
                rows = []
                for data, was in zip(texts, old):
                    words = words_of(data or b"")
                    spans, found = scanner.scan(words)
                    packed = b"".join(np.array(s, "<u4").tobytes() for s in sorted(set(spans)))
                    if was:
                        packed += was["words"]
                        found |= set(was["items"])
                    hit = np.zeros(len(words) + 1, np.int64)
                    ranges = np.frombuffer(packed, "<u4").reshape(-1, 2)
                    np.add.at(hit, ranges[:, 0], 1)
                    np.add.at(hit, ranges[:, 1], -1)
                    hit = np.cumsum(hit)[:-1] > 0
                    rows.append(
                        {
                            "n_words": len(words),
                            "n_hit": int(hit.sum()),
                            "items": sorted(found),
                            "spans": char_spans(data, hit) if len(ranges) else [],
                            "words": packed,
                        }
                    )
                got = pa.array(rows, type=arrow.field(out).type)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:width], got], schema=pa.schema([*list(b.schema)[:width], arrow.field(width)])
                )

        df = df.mapInArrow(run, schema)
    return df


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """The documents that hold no window of any item, with the columns of ``docs``."""
    found = find_items(docs, items, window, text_col=text_col)
    return found.where(F.col(found.columns[-1])["n_hit"] == 0).select(*docs.columns)
