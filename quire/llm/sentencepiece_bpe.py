"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder keeps an agenda (heap) of adjacent symbol pairs ordered by the score of
their merged piece, leftmost first among equals, and merges the best pair until none
is left; symbols outside the vocabulary fall back to byte pieces.  No piece of such a
vocabulary has a word mark after another character, so merges never cross the start of
a run of word marks; the same holds for a line feed, which is in no piece.  A text is
therefore cut there, the agenda runs once per distinct chunk, and a bounded memo of
chunks serves the rest.  Every chunk that the agenda encodes is checked against the
sentencepiece library, batch by batch.

Decoding joins the pieces of the ids themselves: word marks become spaces, byte pieces
become bytes, control pieces vanish and the space that encoding put in front goes.

Cases: null counts as empty (begin and end id only, decoded to the empty text); a very
long run without a space is one chunk, encoded in O(n log n) and not kept in the memo;
repeated rows get equal answers; an empty table gives an empty result.  The documents
never shuffle.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MEMO_CHUNKS = 300_000
MEMO_CHARS = 48
SHORT = 32
NO_PIECE = float("-inf")


class PieceCodec:
    def __init__(self, model_path: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = lib.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(names) if not special[i]}
        self.scores = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.bos, self.eos, self.unk = lib.bos_id(), lib.eos_id(), lib.unk_id()
        names = [
            b"" if lib.is_control(i)
            else bytes([int(names[i][3:5], 16)]) if lib.is_byte(i)
            else " ⁇ ".encode() if lib.is_unknown(i)
            else names[i].replace(MARK, " ").encode()
            for i in range(n)
        ]
        self.surface = pa.array(names, pa.large_binary())
        self.feed = lib.encode("a\n")[len(lib.encode("a")) :]
        self.lead = lib.encode("\n")
        inner = any(MARK in p.lstrip(MARK) for p in self.ids)
        feed = any("\n" in p and len(p) > 1 for p in self.ids)
        cut = f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n"
        self.plain = not (inner or feed)
        self.chunks = re.compile(cut if self.plain else r"(?s).+")
        self.memo = Memo(self.agenda)

    def agenda(self, chunk: str) -> list[int]:
        """Ids of one chunk by merging the best-scored adjacent pair first."""
        return self._ids(self._short(chunk) if len(chunk) <= SHORT else self._long(chunk))

    def _short(self, chunk: str) -> list[str]:
        """The agenda of a short chunk is the list of its pairs' scores; ``index`` gives the leftmost best."""
        score = self.scores.get
        sym = list(chunk)
        agenda = [score(a + b, NO_PIECE) for a, b in zip(sym, sym[1:])]
        while agenda and (best := max(agenda)) > NO_PIECE:
            i = agenda.index(best)
            sym[i : i + 2] = [pair := sym[i] + sym[i + 1]]
            del agenda[i]
            if i:
                agenda[i - 1] = score(sym[i - 1] + pair, NO_PIECE)
            if i < len(agenda):
                agenda[i] = score(pair + sym[i + 1], NO_PIECE)
        return sym

    def _long(self, chunk: str) -> list[str]:
        """The agenda of a long chunk is a heap; entries whose sides have changed since are skipped."""
        score = self.scores.get
        sym: list[str | None] = list(chunk)
        n = len(sym)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(-s, i, i + 1, p) for i in range(n - 1) if (s := score(p := sym[i] + sym[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, left, right, pair = heapq.heappop(heap)
            a, b = sym[left], sym[right]
            if a is None or b is None or after[left] != right or len(a) + len(b) != len(pair):
                continue
            sym[left], sym[right] = pair, None
            after[left] = nxt = after[right]
            if nxt >= 0:
                before[nxt] = left
                if (s := score(p := pair + sym[nxt])) is not None:
                    heapq.heappush(heap, (-s, left, nxt, p))
            prev = before[left]
            if prev >= 0 and (s := score(p := sym[prev] + pair)) is not None:
                heapq.heappush(heap, (-s, prev, left, p))
        return [x for x in sym if x is not None]

    def _ids(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in s.encode())
            else:
                out.append(self.unk)
        return out

    def check(self, learnt: list[tuple[str, list[int]]]) -> None:
        """Compare what the agenda has encoded with the library."""
        for at in range(0, len(learnt), 100):
            part = learnt[at : at + 100]
            # behind a line feed no chunk touches the one before it
            theirs = self.library.encode("\n" + "\n".join([c for c, _ in part]))[len(self.lead) - len(self.feed) :]
            if [i for _, mine in part for i in (*self.feed, *mine)] != theirs:
                raise ValueError(f"the agenda and the sentencepiece library differ among {part!r}")

    def cut(self, text: str) -> list[str]:
        """Chunks of a text; their join is the text behind a word mark, with word marks for spaces."""
        if self.plain and text[0] != " " and "  " not in text and MARK not in text:
            marked = MARK + text.replace(" ", " " + MARK)
            if "\n" in marked:
                marked = marked.replace("\n", " \n ")
            return marked.split(" ")
        return self.chunks.findall(MARK + text.replace(" ", MARK))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, begin and end ids included, as little-endian unsigned 32-bit integers."""
        memo, begin, end = self.memo, _packed([self.bos]), _packed([self.eos])
        get = memo.__getitem__
        out = [b"".join([begin, *map(get, self.cut(t)), end]) if t else begin + end for t in texts]
        self.check(memo.learnt)
        memo.turn_over()
        return out

    def decode_batch(self, coded: list[bytes]) -> list[bytes]:
        """Texts in UTF-8 of texts' ids (little-endian), as the library's decode() gives them."""
        pieces = self.surface.take(pa.array(np.frombuffer(b"".join(coded), "<u4")))
        _, ends, data = pieces.buffers()
        ends = np.frombuffer(ends, np.int32 if pa.types.is_binary(pieces.type) else np.int64)
        data = memoryview(data) if data else memoryview(b"")
        out, at = [], 0
        for c in coded:
            first, at = int(ends[at]), at + len(c) // 4
            text = bytes(data[first : int(ends[at])])
            out.append(text[1:] if text[:1] == b" " else text)
        return out


class Memo(dict):
    """Ids of chunks, encoded when first asked for.

    Bounded by two generations: when the young one is full it becomes the old one, and
    what two fillings have not used is forgotten.
    """

    def __init__(self, agenda):
        self.agenda, self.old, self.learnt = agenda, {"": b""}, []

    def __missing__(self, chunk: str) -> bytes:
        coded = self.old.get(chunk)
        if coded is None:
            ids = self.agenda(chunk)
            self.learnt.append((chunk, ids))
            coded = _packed(ids)
        self[chunk] = coded
        return coded

    def turn_over(self) -> None:
        self.learnt.clear()
        if len(self) > MEMO_CHUNKS:
            self.old = {c: v for c, v in self.items() if len(c) <= MEMO_CHARS}
            self.clear()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_CODECS: dict[str, PieceCodec] = {}


def codec(model_path: str) -> PieceCodec:
    """One codec per Python worker and model."""
    if model_path not in _CODECS:
        _CODECS[model_path] = PieceCodec(model_path)
    return _CODECS[model_path]


def encode_decode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", slice_chars: int = 4 << 20
) -> DataFrame:
    """id column, ids (array<int>) and decoded text for every row."""
    return _mapped(docs, model_path, id_col, text_col, slice_chars, False)


def encode_digests(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", slice_chars: int = 4 << 20
) -> DataFrame:
    """id column, n_tokens and SHA-256 of ids and of the decoded text for every row."""
    return _mapped(docs, model_path, id_col, text_col, slice_chars, True)


def _mapped(docs, model_path, id_col, text_col, slice_chars, digests):
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text_"))
    tail = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    schema = T.StructType([rows.schema.fields[0], *T.StructType.fromDDL(tail).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        coder = codec(model_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            first = 0
            while first < len(texts):
                # texts of about slice_chars at a time bound the memory of a batch of long texts
                chars, after = len(texts[first]), first + 1
                while after < len(texts) and chars + len(texts[after]) <= slice_chars:
                    chars += len(texts[after])
                    after += 1
                coded = coder.encode_batch(texts[first:after])
                decoded = coder.decode_batch(coded)
                if digests:
                    cols = [
                        [len(c) // 4 for c in coded],
                        [hashlib.sha256(c).hexdigest() for c in coded],
                        [hashlib.sha256(d).hexdigest() for d in decoded],
                    ]
                else:
                    cols = [[np.frombuffer(c, "<i4") for c in coded], [d.decode("utf-8", "replace") for d in decoded]]
                arrays = [batch.column(0).slice(first, after - first)]
                arrays += [pa.array(c, type=f.type) for c, f in zip(cols, list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([batch.schema.field(0), *list(arrow)[1:]]))
                first = after

    return rows.mapInArrow(run, schema)
