"""Token-id files compressed by Re-Pair grammars.

Documents go in ascending id order into shards of about ``shard_ids`` token ids.  Each
shard is compressed on its own: frequent adjacent id pairs are replaced by new symbols
again and again, a round at a time, taking the most frequent pairs that cannot overlap
each other, until no pair occurs ``least`` times.  Pairs never cross a document's
end, so a document can be decoded alone: the shard holds the rules, each rule's expansion length
and each document's place in the compressed sequence.

A shard is one binary value (format of ``pack_shard``) in a row of a Parquet table, so
Spark's commit protocol makes the files safe against lost executors and they can lie in
any store that Spark writes to.

Text is encoded with the tokenizers library.  Its byte-level rules never join text
across the start of a run of white space, so a text is cut there, the library encodes
each distinct piece once and a bounded memo serves the rest; a text that holds a special
token's string is encoded whole.

Cases: null counts as empty (the end id alone); documents with equal ids stay together,
ordered by a hash of their text; a null id comes first; a document longer than a shard
is a shard of its own; an empty table writes an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARD_IDS = 1 << 20
TEXT_BYTES = 8 << 20
PART_BYTES = 256 << 20
PAIRS_A_ROUND, LEAST_COUNT = 4096, 8
MEMO_PIECES, MEMO_CHARS = 500_000, 48
JOINED_PIECES = 64
MAGIC = b"RPG1"
_OTHER_SPACE = r"\t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = re.compile(rf"[ \n{_OTHER_SPACE}]*[^ \n{_OTHER_SPACE}]+|[ \n{_OTHER_SPACE}]+")
# no white space but one space in front
_LONE = re.compile(r" ?\S+").fullmatch
# white space other than one space or line feed between two words
_UNEVEN = (
    r"[ \n][ \n]|\A[ \n]|[ \n]\z|[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# ASCII signs but the apostrophe, which begins contractions
_SIGNS = np.array([33 <= c < 127 and c != 39 and not chr(c).isalnum() for c in range(256)])
SIGNS_IN_A_ROW = 8


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point below 65,536, whether it is a letter or digit."""
    points = np.array([c for c in range(1 << 16) if not 0xD800 <= c < 0xE000])
    out = np.zeros(1 << 16, bool)
    out[points] = pc.match_substring_regex(pa.array(map(chr, points.tolist())), r"[\pL\pN]").to_numpy(zero_copy_only=False)
    return out


def _cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places in ``data``, the UTF-8 bytes of texts without uneven white space, where a piece
    starts; the last place is the end.  The texts lie between ``starts``."""
    cut = np.zeros(len(data) + 1, bool)
    np.equal(data, 32, out=cut[:-1])
    cut[:-1] |= data == 10
    cut[starts] = True
    ends = np.flatnonzero(cut)[1:]
    # behind a letter or digit, ASCII signs up to white space are a piece of their own
    at = ends[_SIGNS[data[ends - 1]]] - 1
    for _ in range(SIGNS_IN_A_ROW):
        at = at[~cut[at]]  # a text may begin with signs
        more = _SIGNS[data[at - 1]]
        first, at = at[~more], at[more] - 1
        a, b, c = (data[np.maximum(first - k, 0)].astype(np.int32) for k in (3, 2, 1))
        wide = np.where(b >= 0xC0, (b & 31) << 6 | c & 63, (a & 15) << 12 | (b & 63) << 6 | c & 63)
        wide[(b < 0xC0) & (a >> 4 != 14)] = 0  # neither two bytes nor three
        cut[first[_letters()[np.where(c < 128, c, wide)]]] = True
    return np.flatnonzero(cut)


class TokenEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.size = self.library.get_vocab_size()
        lines = self._encode(["\n", "a\n b\nc"])
        # the id of a line feed, if it is one wherever it stands between two words
        self.gap = lines[0].ids[0] if len(lines[0].ids) == 1 and lines[1].ids.count(lines[0].ids[0]) == 2 else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list:
        return self.library.encode_batch_fast(texts, add_special_tokens=False)

    def encode_batch(self, texts: list[str] | pa.Array, end: int) -> list[np.ndarray]:
        """Ids of each text and the end id."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        plain = pc.invert(pc.match_substring_regex(texts, _UNEVEN))
        for s in self.special:
            plain = pc.and_(plain, pc.invert(pc.match_substring(texts, s)))
        out: list = [None] * len(texts)
        even, odd = np.flatnonzero(plain.to_numpy(zero_copy_only=False)), pc.invert(plain)
        if len(even):
            chosen = texts.filter(plain).cast(pa.large_string())
            _, starts, data = chosen.buffers()
            starts = np.frombuffer(starts, np.int64)[chosen.offset : chosen.offset + len(chosen) + 1]
            data, starts = np.frombuffer(data or b"", np.uint8)[starts[0] : starts[-1]], starts - starts[0]
            cuts = _cuts(data, starts)
            pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
            self._encode_pieces(pieces, np.searchsorted(cuts, starts), even, end, out, lambda p: p[0] != "\n")
        if len(even) < len(texts):
            rest = texts.filter(odd).to_pylist()
            rest = pa.array([[t] if any(s in t for s in self.special) else _PIECES.findall(t) for t in rest], pa.list_(pa.string()))
            where = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            self._encode_pieces(rest.flatten(), rest.offsets.to_numpy(), where, end, out, _LONE)
        if len(self.young) > MEMO_PIECES:
            # two generations bound the memo: what two fillings have not used is forgotten
            self.old, self.young = {p: v for p, v in self.young.items() if len(p) <= MEMO_CHARS}, {}
        return out

    def _encode_pieces(
        self, pieces: pa.Array, starts: np.ndarray, where: np.ndarray, end: int, out: list, lone: Callable[[str], object]
    ) -> None:
        """Put the ids of the texts, whose pieces lie between ``starts``, into ``out`` at ``where``."""
        known = pieces.dictionary_encode()  # each distinct piece is looked up once
        names = known.dictionary.to_numpy(zero_copy_only=False).tolist()
        coded = list(map(self.young.get, names))
        if None in coded:
            new = [i for i, c in enumerate(coded) if c is None]
            for i, c in zip(new, self._learn([names[i] for i in new], lone)):
                coded[i] = c
        joined = pa.array(coded, pa.large_binary()).take(known.indices)
        ends = np.frombuffer(joined.buffers()[1], np.int64)
        ids = np.frombuffer(joined.buffers()[2] or b"", "<u4", int(ends[len(joined)]) // 4)
        cuts = ends[starts] // 4
        for i, a, b in zip(where, cuts[:-1], cuts[1:]):
            out[i] = np.append(ids[a:b], np.uint32(end))

    def _learn(self, pieces: list[str], lone: Callable[[str], object]) -> list[bytes]:
        """Ids of distinct pieces that the young generation lacks; ``lone`` tells those without
        white space but one space in front."""
        coded = list(map(self.old.get, pieces))
        new = [i for i, c in enumerate(coded) if c is None and self.gap is not None and lone(pieces[i])]
        # a line feed between such pieces is a token of its own that none of them holds, so many
        # are encoded as one text, which spares the library a result for each
        runs = [new[at : at + JOINED_PIECES] for at in range(0, len(new), JOINED_PIECES)]
        for run, e in zip(runs, self._encode(["\n".join([pieces[i] for i in run]) for run in runs])):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(ids == self.gap)
            if len(ends) == len(run) - 1:
                data, ends = ids.tobytes(), (4 * ends).tolist()
                for i, a, b in zip(run, [0, *[end + 4 for end in ends]], [*ends, len(data)]):
                    coded[i] = data[a:b]
        rest = [i for i, c in enumerate(coded) if c is None]
        for i, e in zip(rest, self._encode([pieces[i] for i in rest])):
            coded[i] = np.array(e.ids, "<u4").tobytes()
        self.young.update(zip(pieces, coded))
        return coded


_ENCODERS: dict[str, TokenEncoder] = {}


def encoder(path: str) -> TokenEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TokenEncoder(path)
    return _ENCODERS[path]


# Re-Pair


def frequent_pairs(
    seq: np.ndarray, may: np.ndarray, symbols: int, most: int, least: int
) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Pairs that occur ``least`` times or more, most frequent first, such that no symbol
    ends one pair and begins another (or is its own partner), so none overlap; the places of
    the pairs; and which pair is there.  A pair's places are together and ascending.

    Only places in ``may`` are looked at; those found to hold a rarer pair are taken out of
    it.  There are no pairs only if none occurs ``least`` times.  Symbols are below ``symbols``.
    """
    at = np.flatnonzero(may)
    symbol, place = np.uint64(symbols.bit_length()), np.uint64(len(seq).bit_length())
    keys = seq[at].astype(np.uint64)
    keys <<= symbol
    keys |= seq[at + 1]
    if 2 * symbol + place <= 64:
        # pair and place in one number, so one sort brings a pair's places together
        keys <<= place
        keys |= at.view(np.uint64)
        keys.sort()
        at = (keys & ((np.uint64(1) << place) - np.uint64(1))).view(np.int64)
        keys >>= place
    else:
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    first = np.flatnonzero(new)
    n = np.diff(first, append=len(keys))
    # what is rare stays rare, as only new symbols make new pairs
    may[at[np.repeat(n < least, n)]] = False
    order = np.flatnonzero(n >= least)
    order = order[np.argsort(-n[order], kind="stable")][: 2 * most]
    found = keys[first[order]]
    firsts: set[int] = set()
    seconds: set[int] = set()
    pairs, chosen = [], []
    for k, a, b in zip(order.tolist(), (found >> symbol).tolist(), (found & ((np.uint64(1) << symbol) - np.uint64(1))).tolist()):
        if len(pairs) == most:
            break
        if a in seconds or b in firsts or (a == b and (a in firsts or a in seconds)):
            continue
        firsts.add(a)
        seconds.add(b)
        if a == b:
            seconds.add(a)
        pairs.append((a, b))
        chosen.append(k)
    first, n = first[chosen], n[chosen]
    which = np.repeat(np.arange(len(pairs)), n)
    return pairs, at[np.repeat(first - np.cumsum(n) + n, n) + np.arange(len(which))], which


def replace_pairs(
    seq: np.ndarray,
    may: np.ndarray,
    ends: np.ndarray,
    pairs: list[tuple[int, int]],
    at: np.ndarray,
    which: np.ndarray,
    first_new: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequence with each pair replaced by ``first_new``, ``first_new + 1``, ...; its
    ``may``, where the pairs of new symbols are in; and the documents' ends."""
    if any(a == b for a, b in pairs):
        # a pair of equal symbols overlaps itself in a run: take every other place
        start = np.ones(len(at), bool)
        start[1:] = (np.diff(at) != 1) | (which[1:] != which[:-1])
        run = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
        even = (np.arange(len(at)) - run) % 2 == 0
        at, which = at[even], which[even]
    seq[at] = which + first_new
    may[at] = True
    may[at[at > 0] - 1] = True
    keep = np.ones(len(seq), bool)
    keep[at + 1] = False
    ends = ends - np.searchsorted(np.flatnonzero(~keep), ends)
    seq, may = seq[keep], may[keep]
    may[ends - 1] = False  # pairs do not cross a document's end
    return seq, may, ends


def compress(
    ids: np.ndarray, ends: np.ndarray, base: int, least: int = LEAST_COUNT
) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
    """(sequence, rules, documents' ends in the sequence) for ids below ``base``.

    ``ends`` are the documents' ends in ``ids``; every document has an id at least.
    """
    seq = np.array(ids, np.uint32)
    may = np.ones(len(seq), bool)  # places whose pair may still be frequent
    may[ends - 1] = False
    rules: list[tuple[int, int]] = []
    while True:
        pairs, at, which = frequent_pairs(seq, may, base + len(rules), PAIRS_A_ROUND, least)
        if not pairs:
            return seq, rules, ends
        seq, may, ends = replace_pairs(seq, may, ends, pairs, at, which, base + len(rules))
        rules += pairs


def pack_shard(docs: list[np.ndarray], base: int, least: int = LEAST_COUNT) -> bytes:
    """MAGIC; base, rules, symbols, documents, bytes a symbol (unsigned 32 bit, little
    endian); rules as pairs; expansion lengths of the rules; documents' ends in the
    sequence; the sequence."""
    ids = np.concatenate(docs)
    seq, rules, ends = compress(ids, np.cumsum([len(d) for d in docs]), base, least)
    lengths = np.ones(base + len(rules), np.uint32)
    for k, (a, b) in enumerate(rules):
        lengths[base + k] = lengths[a] + lengths[b]
    width = 2 if base + len(rules) <= 1 << 16 else 4
    return b"".join(
        [
            MAGIC,
            struct.pack("<5I", base, len(rules), len(seq), len(docs), width),
            np.array(rules, "<u4").tobytes(),
            lengths[base:].astype("<u4").tobytes(),
            ends.astype("<u4").tobytes(),
            seq.astype(f"<u{width}").tobytes(),
        ]
    )


@lru_cache(maxsize=4)
def _base_ids(base: int) -> tuple[bytes, ...]:
    ids = np.arange(base, dtype="<u4").tobytes()
    return tuple(ids[i : i + 4] for i in range(0, len(ids), 4))


class Shard:
    """A packed shard; reads all documents, or any one of them alone."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        self.base, n_rules, n_seq, self.n_docs, width = struct.unpack_from("<5I", data, 4)
        at = 24
        self.rules = np.frombuffer(data, "<u4", 2 * n_rules, at).reshape(-1, 2)
        at += 8 * n_rules
        self.lengths = np.concatenate([np.ones(self.base, np.int64), np.frombuffer(data, "<u4", n_rules, at)])
        at += 4 * n_rules
        self.ends = np.frombuffer(data, "<u4", self.n_docs, at).astype(np.int64)
        at += 4 * self.n_docs
        self.seq = np.frombuffer(data, f"<u{width}", n_seq, at)
        self._expansions = None

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Token ids of a stretch of the sequence."""
        if self._expansions is None:
            parts = list(_base_ids(self.base))
            for a, b in self.rules.tolist():
                parts.append(parts[a] + parts[b])
            self._expansions = pa.array(parts, pa.large_binary())
        got = self._expansions.take(pa.array(symbols))
        data = got.buffers()[2]
        return np.frombuffer(data, "<u4", int(self.lengths[symbols].sum())) if data and len(symbols) else np.zeros(0, "<u4")

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.seq[self.ends[i - 1] if i else 0 : self.ends[i]])

    def documents(self) -> list[np.ndarray]:
        ids = self.expand(self.seq)
        done = np.concatenate([[0], np.cumsum(self.lengths[self.seq])])
        cuts = done[self.ends]
        return [ids[a:b] for a, b in zip(np.concatenate([[0], cuts[:-1]]), cuts)]


# files


def write_token_shards(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_ids: int = SHARD_IDS,
    least: int = LEAST_COUNT,
) -> None:
    """Encode ``docs`` and write the shards in ascending id order as the Parquet table ``path``.

    Rows: part and seq (the shard's place), ids of its documents, n_ids, and the shard.
    The ranges of ids (and of hashes of the texts under one id) are Spark's range
    partitions, so the only shuffle is the one that sorts the documents.  A pair is
    replaced if it occurs ``least`` times in a shard.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("seq", T.IntegerType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("n_ids", T.LongType()),
            T.StructField("shard", T.BinaryType()),
        ]
    )
    # ranges of about PART_BYTES of text, however large the input
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / PART_BYTES))

    def run(batches):
        coder, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        ids: list = []
        coded: list[np.ndarray] = []
        size = seq = 0

        def shard():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([ids]),
                    pa.array([size], pa.int64()),
                    pa.array([pack_shard(coded, max(coder.size, end_id + 1), least)], pa.binary()),
                ],
                names=schema.names,
            )

        for b in batches:
            names, texts = b.column(0), b.column(1)
            reach = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(texts):
                # texts of about TEXT_BYTES at a time, which bounds the memory of a batch of long texts
                before = int(reach[at - 1]) if at else 0
                after = max(at + 1, int(np.searchsorted(reach, before + TEXT_BYTES, side="right")))
                done = coder.encode_batch(texts.slice(at, after - at), end_id)
                for name, t in zip(names.slice(at, after - at).to_pylist(), done):
                    if coded and size + len(t) > shard_ids:
                        yield shard()
                        ids, coded, size, seq = [], [], 0, seq + 1
                    ids.append(name)
                    coded.append(t)
                    size += len(t)
                at = after
        if coded:
            yield shard()

    (
        rows.repartitionByRange(parts, "id", F.xxhash64("text"))
        .sortWithinPartitions("id", F.xxhash64("text"))
        .mapInArrow(run, schema)
        .write.parquet(path)
    )


def read_token_shards(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """id, start (ids of all documents before it), n_tokens and the token ids (or, with
    ``digest``, their unsigned CRC-32 as little-endian unsigned 32-bit integers)."""
    import zlib

    shards = spark.read.parquet(path)
    id_type = shards.schema["ids"].dataType.elementType
    last = T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("tokens", T.ArrayType(T.IntegerType()))
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("seq", T.IntegerType()),
            T.StructField("id", id_type),
            T.StructField("offset", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            last,
        ]
    )

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                docs = Shard(b.column(3)[i].as_py()).documents()
                n = len(docs)
                sizes = np.array([len(d) for d in docs], np.int64)
                got = [zlib.crc32(d.tobytes()) for d in docs] if digest else [d.astype("<i4") for d in docs]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b.column(0)[i].as_py()] * n, pa.int32()),
                        pa.array([b.column(1)[i].as_py()] * n, pa.int32()),
                        b.column(2)[i].values,
                        pa.array(np.cumsum(sizes) - sizes),
                        pa.array(sizes),
                        pa.array(got, pa.int64() if digest else pa.list_(pa.int32())),
                    ],
                    names=schema.names,
                )

    read = shards.select("part", "seq", "ids", "shard").mapInArrow(run, schema)
    # where each shard starts: within its part, after the parts before
    of_part = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    of_part = of_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    starts = shards.select("part", "seq", inside.alias("inside")).join(of_part, "part")
    starts = starts.select("part", "seq", (F.col("inside") + F.col("before")).alias("shard_start"))
    return read.join(starts, ["part", "seq"]).select(
        "id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", last.name
    )
