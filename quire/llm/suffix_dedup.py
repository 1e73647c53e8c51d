"""Removal of repeated byte strings with suffix arrays built by linear grouping.

A byte goes when it is covered by a ``WINDOW``-byte string that also starts earlier in
the corpus (smaller id, or the same document at an earlier place).

A suffix array of the whole corpus would need one huge task, so the corpus is cut into
independent problems by content.  Every window is represented by one anchor, its least
``GRAM``-byte gram by hash, so equal windows have equal anchors at equal offsets.  All
windows of one anchor place are a context of at most 168 bytes, and windows can only
repeat among contexts of the same anchor gram:

1. Documents emit one row per anchor place.  Contexts equal to an earlier one of the
   same batch are dropped from the shuffle at once, as removals, so a passage or text
   that a third of all documents share sends one row per batch.
2. Grouped by anchor, all contexts equal to an earlier one are removals.  Anchors with
   several different contexts go on; there a window may repeat though the context doesn't.
3. Their bytes are fetched from the documents.  The contexts of an anchor are joined into
   one string, columns that always agree or differ together becoming one symbol, and its
   suffix array gives the runs of equal windows, of which all but the earliest go.
   The array is built by Baier's linear grouping: suffixes are grouped by their Lyndon
   prefixes, the groups processed in descending order with previous-smaller pointers, and
   a second pass writes out each group's order directly.
4. Removals are merged per document and cut out.

An anchor with more than ``HOT`` different contexts (a common line or the edges of a
common passage) would be a large problem for one task; its windows go on one by one under
their own hashes instead, which splits it into as many small problems as it has different
windows and is exact too.

Cases: null and empty texts and texts shorter than a window lose nothing; rows that share
an id count as parts of one document in the order of a 64-bit text hash, which tells any
number of texts under one id apart, and identical rows are one row said twice, with equal
results; a null id comes before all others; very long texts
are scanned in pieces; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import fresh, stored, utf8

WINDOW = 100
GRAM = 32
SPAN = WINDOW - GRAM  # an anchor starts at most so many bytes after its window
HOT = 2000
PIECE = 1 << 20  # windows scanned at a time
# context marks in the place of the left offset, which is at most SPAN
WINDOW_ALONE, REMOVED = 127, 126

_TABLE = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64)
_MUL1, _MUL2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 22) - 1)


# suffix array by linear grouping


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in lexicographic order (a prefix sorts first)."""
    n = len(text)
    if not n:
        return []
    # groups of suffixes, doubly linked in ascending order; -1 ends the list
    starts: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        if c in starts:
            starts[c].append(i)
        else:
            starts[c] = [i]
    symbols = sorted(starts)
    members = [starts[c] for c in symbols]
    lower = list(range(-1, len(symbols) - 1))
    higher = list(range(1, len(symbols))) + [-1]
    rank = {c: k for k, c in enumerate(symbols)}
    group = [rank[c] for c in text]
    previous = [0] * n  # of a processed suffix: the nearest smaller one before it
    processed = bytearray(n)
    sizes: list[tuple[int, int]] = []  # (group, members), in descending order
    g = len(symbols) - 1
    while g >= 0:
        own = [s for s in members[g] if group[s] == g]
        if not own:
            g = lower[g]
            continue
        if len(own) > 1:
            own.sort()
        sizes.append((g, len(own)))
        for s in own:
            processed[s] = 1
        taken: dict[int, int] = {}  # previous smaller suffix: how many of this group follow it
        for s in own:
            p = s - 1
            while p >= 0 and processed[p]:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                taken[p] = taken.get(p, 0) + 1
        # a suffix followed by k members gets its Lyndon prefix lengthened by them: it moves
        # just above what is left of its group, the further the larger k is
        if len(taken) == 1:
            ((p, _),) = taken.items()
            _raise(p, group[p], [p], group, members, lower, higher)
        elif taken:
            moved: dict[tuple[int, int], list[int]] = {}
            for p, k in taken.items():
                moved.setdefault((group[p], -k), []).append(p)
            for (old, _), ps in sorted(moved.items()):
                _raise(ps[0], old, ps, group, members, lower, higher)
        g = lower[g]
    # write out each group's order: a suffix follows, in its group, the order of the next
    # smaller suffix behind it, which has its place already
    front = {}
    at = n
    for g, size in sizes:
        at -= size
        front[g] = at
    order = [-1] * n
    placed = bytearray(n)
    here = n  # the empty suffix is the smallest
    i = -1
    while True:
        p = here - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            f = front[g]
            order[f] = p
            front[g] = f + 1
            placed[p] = 1
            p = previous[p]
        i += 1
        if i == n:
            return order
        here = order[i]


def _raise(_, old, ps, group, members, lower, higher) -> None:
    """Move ``ps`` out of group ``old`` into a new group just above it."""
    new, above = len(members), higher[old]
    members.append(ps)
    lower.append(old)
    higher.append(above)
    higher[old] = new
    if above >= 0:
        lower[above] = new
    for p in ps:
        group[p] = new


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """Length of the common prefix of each suffix in ``order`` with the one before."""
    n = len(text)
    rank = [0] * n
    for i, s in enumerate(order):
        rank[s] = i
    out = [0] * n
    h = 0
    for s in range(n):
        r = rank[s]
        if r:
            t = order[r - 1]
            while s + h < n and t + h < n and text[s + h] == text[t + h]:
                h += 1
            out[r] = h
            if h:
                h -= 1
        else:
            h = 0
    return out


# anchors


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    h, n = _TABLE[data], 1
    while n < GRAM:
        h = h[:-n] * _MUL1 + h[n:] * _MUL2
        h ^= h >> np.uint64(29)
        n *= 2
    return h


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = (out + p) * _MUL1
        out ^= out >> np.uint64(32)
        out *= _MUL2
    return out


def anchors_of(data: np.ndarray, first: np.ndarray, after: np.ndarray):
    """Anchors of texts that lie at [first, after) of ``data``: gram hash, context hash,
    place, and the first and last window that the anchor represents."""
    hashes = _gram_hashes(data)
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width, have = SPAN + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: have - width], least[width - have :])
    place = (least & _PLACE).astype(np.int64)
    edge = np.zeros(len(place) + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, after - WINDOW + 1, -1)
    window = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    place = place[window]
    new = np.ones(len(window), bool)
    new[1:] = (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)
    at = np.flatnonzero(new)
    low, high = window[at], window[np.append(at[1:], len(window)) - 1]
    place = place[at]
    size = high - low + WINDOW
    grams = [hashes[low + np.minimum(o, size - GRAM)] for o in range(0, SPAN + WINDOW, GRAM)]
    context = _mixed([*grams, ((place - low) << 16 | size).astype(np.uint64)])
    return hashes[place], context, place, low, high


def pieces(texts: list[bytes]):
    """(data, text number, offset in its text, start, end) of buffers of about PIECE bytes;
    a long text is cut into pieces that overlap by WINDOW - 1 bytes, so each window is in one."""
    buffer, spans, size = [], [], 0
    for i, t in enumerate(texts):
        if len(t) < WINDOW:
            continue
        for o in range(0, len(t) - WINDOW + 1, PIECE):
            part = t[o : o + PIECE + WINDOW - 1]
            if size and size + len(part) > 2 * PIECE:
                yield b"".join(buffer), np.array(spans, np.int64)
                buffer, spans, size = [], [], 0
            buffer.append(part)
            spans.append((i, o, size, size + len(part)))
            size += len(part)
    if size:
        yield b"".join(buffer), np.array(spans, np.int64)


def _packed(place: np.ndarray, left: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Place of an anchor for sorting within a text: byte place; and its context."""
    return place << 14 | left << 7 | (size - WINDOW)


def _opened(at: np.ndarray):
    """(place, left, size) of packed places."""
    return at >> 14, (at >> 7) & 127, (at & 127) + WINDOW


def _later_copies(anchor, context, doc, tag, at):
    """(order, group starts, is the earliest of its context, repeats a row) for sorted rows."""
    order = np.lexsort((at, tag, doc, context, anchor))
    a, c, d, t, p = anchor[order], context[order], doc[order], tag[order], at[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    same_place = (d == d[start]) & (t == t[start]) & (p == p[start])
    return order, new, new | same_place, same_place & ~new


def merged(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Byte ranges joined where they touch, per (doc, tag)."""
    if not len(doc):
        return doc, tag, start, end
    o = np.lexsort((start, tag, doc))
    doc, tag, start, end = doc[o], tag[o], start[o], end[o]
    other = np.ones(len(o), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    # running maximum of the ends within a text, by lifting each text above the one before
    lift = np.cumsum(other) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    new = other.copy()
    new[1:] |= start[1:] + lift[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(o)) - 1
    return doc[at], tag[at], start[at], (reach - lift)[last]


# one anchor's contexts


def repeated_windows(rows: list[tuple[bytes, int]]) -> list[np.ndarray]:
    """For contexts of one anchor in corpus order, each (bytes, anchor's place in them): the
    window starts (in the context's bytes) whose window is also in an earlier context."""
    m = len(rows)
    none = np.zeros(0, np.int64)
    out = [none] * m
    # columns aligned at the anchor; outside a context each row has a value of its own
    table = np.repeat(np.arange(256, 256 + m, dtype=np.int32)[:, None], SPAN + WINDOW, 1)
    for i, (data, left) in enumerate(rows):
        table[i, SPAN - left : SPAN - left + len(data)] = np.frombuffer(data, np.uint8)
    keep = _sharing(table)
    if len(keep) < 2:
        return out
    table = table[keep]
    m = len(keep)
    # each column's classes of equal values, named by the first row that has the value
    if m <= 48:
        named = np.empty_like(table)
        for j in range(m - 1, -1, -1):
            np.copyto(named, j, where=table == table[j])
    else:
        named = np.empty_like(table)
        for c in range(table.shape[1]):
            _, at, inverse = np.unique(table[:, c], return_index=True, return_inverse=True)
            named[:, c] = at[inverse.ravel()]
    # neighbouring columns with the same classes are one symbol; columns without two equal
    # rows end the match of any window across them
    cut = np.ones(table.shape[1], bool)
    cut[1:] = (named[:, 1:] != named[:, :-1]).any(0)
    block = np.cumsum(cut) - 1
    width = int(block[-1]) + 1
    symbols = named[:, cut] + np.arange(width, dtype=np.int32) * m + m + 1
    text: list[int] = []
    for i, row in enumerate(symbols.tolist()):
        text += row
        text.append(m - i)  # ends the row; lower than all symbols and unlike any other end
    order = suffix_array(text)
    common = np.array(common_prefixes(text, order))
    order = np.array(order)
    row_of, column = np.divmod(order, width + 1)
    # suffixes that start with the same block are neighbours, as a symbol names its block
    dup = np.zeros((m, SPAN + 1), bool)
    run_start = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
    run_end = np.append(run_start[1:], len(column))
    where = {int(column[a]): (int(a), int(b)) for a, b in zip(run_start, run_end) if column[a] < width}
    known: dict[tuple[int, int], np.ndarray] = {}
    for w in range(SPAN + 1):
        u, v = int(block[w]), int(block[w + WINDOW - 1])
        later = known.get((u, v))
        if later is None:
            a, b = where[u]
            rows_here = row_of[a:b]
            start = np.flatnonzero(np.concatenate([[True], common[a + 1 : b] < v - u + 1]))
            size = np.diff(np.append(start, b - a))
            earliest = np.repeat(np.minimum.reduceat(rows_here, start), size)
            later = known[u, v] = rows_here[rows_here > earliest]
        dup[later, w] = True
    for i, k in enumerate(keep):
        left = rows[k][1]
        out[k] = np.flatnonzero(dup[i]) - (SPAN - left)
    return out


def _sharing(table: np.ndarray) -> np.ndarray:
    """Rows that may share a window with another row."""
    m = len(table)
    if m <= 24:
        same = table[:, None, :] == table[None, :, :]
        right = np.logical_and.accumulate(same[:, :, SPAN:], axis=2).sum(2)
        left = np.logical_and.accumulate(same[:, :, SPAN - 1 :: -1], axis=2).sum(2)
        long = left + right >= WINDOW
        long[np.arange(m), np.arange(m)] = False
        return np.flatnonzero(long.any(1))
    # a window has SPAN bytes besides the anchor, so half of them on one side
    may = np.zeros(m, bool)
    for side in (table[:, SPAN - SPAN // 2 : SPAN], table[:, SPAN + GRAM : SPAN + GRAM + SPAN // 2]):
        key = np.ascontiguousarray(side).view(f"V{side.shape[1] * 4}").ravel()
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        may |= count[inverse.ravel()] > 1
    return np.flatnonzero(may)


# the jobs


def _doc(c: Column) -> Column:
    return F.coalesce(c.cast("long"), F.lit(-(1 << 63)))


def _tag(text: Column) -> Column:
    """Tells texts under one id apart."""
    return F.xxhash64(text)


def _groups(batches, key: int = 0):
    """Whole groups of equal values in the sorted column ``key``, many at a time, as record batches."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        keys = b.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(keys, keys[-1]))
        if last == 0 and (len(held) == 1 or held[0].column(key)[0].as_py() == keys[0]):
            continue  # one group so far
        whole = pa.Table.from_batches([*held[:-1], b.slice(0, last)])
        if whole.num_rows:
            yield whole.combine_chunks()
        held = [b.slice(last)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _numbers(table, *columns: int) -> list[np.ndarray]:
    return [table.column(i).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(i).to_numpy() for i in columns]


def _emit_anchors(batches):
    """Rows (anchor, context, doc, tag, at); a removal has REMOVED as its left offset, its
    length as context and an arbitrary anchor."""
    names = ["anchor", "context", "doc", "tag", "at"]
    for batch in batches:
        docs, tags = _numbers(batch, 0, 1)
        got = []
        for data, spans in pieces(list(utf8(batch.column(2)))):
            data = np.frombuffer(data, np.uint8)
            gram, context, place, low, high = anchors_of(data, spans[:, 2], spans[:, 3])
            s = np.searchsorted(spans[:, 3], place, side="right")
            shift = spans[s, 1] - spans[s, 2]
            at = _packed(place + shift, place - low, high - low + WINDOW)
            owner = spans[s, 0]
            got.append((gram.view(np.int64), context.view(np.int64), docs[owner], tags[owner], at))
        if not got:
            continue
        anchor, context, doc, tag, at = (np.concatenate(x) for x in zip(*got))
        order, new, _, repeated = _later_copies(anchor, context, doc, tag, at)
        first = order[new]
        yield pa.RecordBatch.from_arrays([pa.array(x[first]) for x in (anchor, context, doc, tag, at)], names=names)
        gone = order[~new & ~repeated]
        if len(gone):
            place, left, size = _opened(at[gone])
            d, t, start, end = merged(doc[gone], tag[gone], place - left, place - left + size)
            mark = _packed(start, np.full(len(t), REMOVED), np.full(len(t), WINDOW))
            key = _mixed([x.view(np.uint64) for x in (d, t, mark)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, end - start, d, t, mark)], names=names)


def _sort_contexts(batches, hot_above: int = HOT):
    """From anchors to removals (anchor null) and contexts that have rivals."""
    for t in _groups(batches):
        anchor, context, doc, tag, at = _numbers(t, 0, 1, 2, 3, 4)
        place, left, size = _opened(at)
        done = left == REMOVED
        removed = [(doc[done], tag[done], place[done], place[done] + context[done])]
        anchor, context, doc, tag, at = (x[~done] for x in (anchor, context, doc, tag, at))
        if len(anchor):
            order, new, _, repeated = _later_copies(anchor, context, doc, tag, at)
            gone = order[~new & ~repeated]
            place, left, size = _opened(at[gone])
            removed.append((doc[gone], tag[gone], place - left, place - left + size))
            first = order[new]
            a = anchor[first]
            edge = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            rivals = np.diff(np.append(edge, len(a)))
            rivals = np.repeat(rivals, rivals)
            more = first[rivals > 1]
            hot = rivals[rivals > 1] > hot_above
            place, left, size = _opened(at[more])
            yield _located(doc[more], tag[more], place - left, place - left + size, anchor[more], left, hot)
        d, tg, s, e = merged(*(np.concatenate(x) for x in zip(*removed)))
        yield _located(d, tg, s, e, None, None, None)


_LOCATED = pa.schema(
    [("doc", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
    + [("anchor", pa.int64()), ("left", pa.int64()), ("hot", pa.bool_())]
)


def _located(doc, tag, start, end, anchor, left, hot) -> pa.RecordBatch:
    n = len(doc)
    some = [pa.nulls(n, t) if x is None else pa.array(x, t) for x, t in ((anchor, pa.int64()), (left, pa.int64()), (hot, pa.bool_()))]
    return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (doc, tag, start, end)), *some], schema=_LOCATED)


def _fetch(batches):
    """Bytes of the rival contexts: rows (key, doc, tag, at, data).  A hot context's windows
    come one by one under their hashes; those that repeat in the batch come as removals."""
    names = ["key", "doc", "tag", "at", "data"]
    for b in batches:
        docs, tags = _numbers(b, 0, 1)
        texts = b.column(2)
        keys, owner, places, data = [], [], [], []
        windows = []
        for i, wanted in enumerate(b.column(3).to_pylist()):
            text = texts[i].as_py().encode()
            for w in wanted:
                start, end = w["start"], w["end"]
                if w["hot"]:
                    part = np.frombuffer(text[start:end], np.uint8)
                    h = _gram_hashes(part)
                    n = end - start - WINDOW + 1
                    grams = [h[o : o + n] for o in (0, GRAM, 2 * GRAM, WINDOW - GRAM)]
                    windows.append((_mixed(grams), _mixed(grams[::-1]), np.full(n, i), start + np.arange(n)))
                else:
                    keys.append(w["anchor"])
                    owner.append(i)
                    places.append((start + w["left"], w["left"], end - start))
                    data.append(text[start:end])
        if keys:
            place, left, size = np.array(places, np.int64).T
            at = _packed(place, left, size)
            numbers = [pa.array(x) for x in (docs[owner], tags[owner], at)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *numbers, pa.array(data, pa.binary())], names=names)
        if windows:
            one, two, own, place = (np.concatenate(x) for x in zip(*windows))
            size = np.full(len(own), WINDOW)
            at = _packed(place, np.full(len(own), WINDOW_ALONE), size)
            one, two, doc, tag = one.view(np.int64), two.view(np.int64), docs[own], tags[own]
            order, new, _, repeated = _later_copies(one, two, doc, tag, at)
            kept, gone = order[new], order[~new & ~repeated]
            d, t, s, e = merged(doc[gone], tag[gone], place[gone], place[gone] + WINDOW)
            mark = _packed(s, np.full(len(t), REMOVED), np.full(len(t), WINDOW))
            spread = _mixed([x.view(np.uint64) for x in (d, t, mark)]).view(np.int64)
            for k, dd, tt, a, x in ((one[kept], doc[kept], tag[kept], at[kept], two[kept]), (spread, d, t, mark, e - s)):
                x = pa.array([v.tobytes() for v in x.astype("<i8")], pa.binary())
                yield pa.RecordBatch.from_arrays([*(pa.array(v) for v in (k, dd, tt, a)), x], names=names)


def _sort_suffixes(batches):
    """From contexts (and single windows) to removals (doc, tag, start, end)."""
    for t in _groups(batches):
        key, doc, tag, at = _numbers(t, 0, 1, 2, 3)
        place, left, size = _opened(at)
        data = t.column(4)
        removed = []
        done = left == REMOVED
        if done.any():
            length = np.array([int.from_bytes(x, "little") for x in data.filter(pa.array(done)).to_pylist()], np.int64)
            removed.append((doc[done], tag[done], place[done], place[done] + length))
        alone = left == WINDOW_ALONE
        if alone.any():
            second = np.frombuffer(b"".join(data.filter(pa.array(alone)).to_pylist()), "<i8")
            k, d, tg, p = key[alone], doc[alone], tag[alone], at[alone]
            order, new, _, repeated = _later_copies(k, second, d, tg, p)
            gone = order[~new & ~repeated]
            pl, _, _ = _opened(p[gone])
            removed.append((d[gone], tg[gone], pl, pl + WINDOW))
        rest = np.flatnonzero(~done & ~alone)
        if len(rest):
            order = rest[np.lexsort((at[rest], tag[rest], doc[rest], key[rest]))]
            k, d, tg, p = key[order], doc[order], tag[order], at[order]
            # identical rows have fetched the same place more than once
            once = np.ones(len(order), bool)
            once[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1]) | (tg[1:] != tg[:-1]) | (p[1:] != p[:-1])
            order, k = order[once], k[once]
            edge = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            for first, after in zip(edge, np.append(edge[1:], len(k))):
                rows = order[first:after]
                found = repeated_windows([(data[int(r)].as_py(), int(left[r])) for r in rows])
                for r, w in zip(rows, found):
                    if len(w):
                        start = place[r] - left[r] + w
                        n = len(w)
                        removed.append(merged(np.full(n, doc[r]), np.full(n, tag[r]), start, start + WINDOW))
        if removed:
            d, tg, s, e = merged(*(np.concatenate(x) for x in zip(*removed)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (d, tg, s, e)], names=["doc", "tag", "start", "end"])


def removals(docs: DataFrame, id_col: str, text_col: str, hot_above: int = HOT) -> DataFrame:
    """(doc, tag, start, end): byte ranges to remove; they may touch or overlap."""
    text = F.col(text_col)
    rows = docs.select(_doc(F.col(id_col)).alias("doc"), _tag(text).alias("tag"), text.alias("text"))
    anchors = rows.mapInArrow(_emit_anchors, "anchor long, context long, doc long, tag long, at long")
    located = stored(
        anchors.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(
            partial(_sort_contexts, hot_above=hot_above),
            "doc long, tag long, start long, end long, anchor long, left long, hot boolean",
        ),
        "contexts",
    )
    rivals = located.where(F.col("anchor").isNotNull())
    wanted = rivals.groupBy("doc", "tag").agg(
        F.collect_list(F.struct("start", "end", "anchor", "left", "hot")).alias("wanted")
    )
    fetched = rows.join(wanted, ["doc", "tag"]).select("doc", "tag", "text", "wanted")
    suffixes = (
        fetched.mapInArrow(_fetch, "key long, doc long, tag long, at long, data binary")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_sort_suffixes, "doc long, tag long, start long, end long")
    )
    plain = located.where(F.col("anchor").isNull()).select("doc", "tag", "start", "end")
    return plain.unionAll(suffixes)


def cut_out(data: bytes, ranges: list) -> tuple[bytes, int]:
    """What is left of ``data``, and the number of maximal removed runs."""
    kept, at, runs = [], 0, 0
    reach = -1
    for start, end in sorted(ranges):
        if start > reach:
            runs += 1
            kept.append(data[at:start])
        reach = max(reach, end)
        at = max(at, end)
    kept.append(data[at:])
    return b"".join(kept), runs


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    digest: bool = False,
    hot_above: int = HOT,
) -> DataFrame:
    """``docs`` (all columns, or ``keep``) with n_bytes, n_removed, n_spans and the remaining text
    (or the SHA-256 of the remaining bytes, with ``digest``) in a struct column, whose name is
    the last column's.  Cuts are made on bytes; what a cut leaves of a character goes from the text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = list(docs.columns) if keep is None else list(keep)
    gone = (
        removals(docs, id_col, text_col, hot_above)
        .groupBy("doc", "tag")
        .agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    )
    # the join keys and the text go under names that no column of docs has
    names = [fresh(docs, x) for x in ("cut_doc", "cut_tag", "cut_text", "cut_ranges", "cut")]
    doc, tag, text, ranges, out = names
    left = docs.select(
        *kept, _doc(F.col(id_col)).alias(doc), _tag(F.col(text_col)).alias(tag), F.col(text_col).alias(text)
    )
    right = gone.select(F.col("doc").alias(doc), F.col("tag").alias(tag), F.col("ranges").alias(ranges))
    rows = left.join(right, [doc, tag], "left").select(*kept, text, ranges)
    width = len(kept)
    last = T.StructField("kept_sha256", T.StringType()) if digest else T.StructField("kept", T.StringType())
    result = T.StructType([*(T.StructField(x, T.LongType()) for x in ("n_bytes", "n_removed", "n_spans")), last])
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(out, result)])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            found = []
            for data, r in zip(utf8(b.column(width)), b.column(width + 1).to_pylist()):
                rest, spans = cut_out(data, [(x["start"], x["end"]) for x in r]) if r else (data, 0)
                last_value = hashlib.sha256(rest).hexdigest() if digest else rest.decode("utf-8", "ignore")
                found.append((len(data), len(data) - len(rest), spans, last_value))
            cols = [list(x) for x in zip(*found)] or [[]] * 4
            struct = pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, arrow.field(width).type)], names=result.names
            )
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:width], struct], schema=pa.schema([*list(b.schema)[:width], arrow.field(width)])
            )

    return rows.mapInArrow(run, schema)
