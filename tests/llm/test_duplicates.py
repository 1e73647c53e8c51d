import random
import re

import numpy as np
import xxhash
from cases import documents, empty, texts
from pyspark.sql import functions as F

from quire.llm import simhash, suffix_dedup

# SimHash


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_components(prints, bits=4):
    label = {p: p for p in prints}
    points = sorted(label)

    def top(p):
        while label[p] != p:
            p = label[p]
        return p

    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= bits:
                label[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in points}


def test_fingerprints_and_components_of_awkward_documents(spark):
    docs = documents(spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    rows = [(r.doc_id, plain_print(r.text)) for r in docs.select("doc_id", "text").collect()]
    tops = plain_components([p for _, p in rows])
    least = {}
    for i, p in rows:
        if i is not None:
            least[tops[p]] = min(i, least.get(tops[p], i))
    want = sorted((str(i), f"{p:016x}", str(least.get(tops[p]))) for i, p in rows)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert simhash.near_duplicates(empty(spark)).collect() == []


def test_one_row_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    rows = kept.collect()
    assert len(rows) == len(groups) and {r.doc_id for r in rows} == groups
    assert simhash.keep_one_each(empty(spark)).collect() == []


def test_links_of_random_fingerprints_with_chains_and_a_dense_group(spark):
    rng = random.Random(3)
    points = {rng.getrandbits(64) for _ in range(300)}
    for start in list(points)[:20]:  # chains of steps of exactly 4, and of 5, bits
        for step in (4, 4, 5, 4):
            for b in rng.sample(range(64), step):
                start ^= 1 << b
            points.add(start)
    hub = rng.getrandbits(64)
    for _ in range(400):  # many within few bits of one another
        points.add(hub ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in points]
    links = simhash.near_links(spark.createDataFrame(signed, "print long"))
    assert links.count() < 60 * len(points)
    tree = {r.a: r.b for r in simhash.components(links).collect()}
    want = plain_components(list(points))
    got = {p: tree.get(int(np.uint64(p).astype(np.int64)), int(np.uint64(p).astype(np.int64))) for p in points}
    assert len(set(got.values())) == len(set(want.values()))
    assert len({(got[p], want[p]) for p in points}) == len(set(want.values()))


def test_close_fingerprints_always_share_a_cell():
    rng = random.Random(4)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.randint(0, 5)):
            b ^= 1 << k
        cells, rows = simhash.cells_of(np.array([a, b], np.uint64))
        assert set(cells[rows == 0].tolist()) & set(cells[rows == 1].tolist())


# repeated strings


def plain_cut(rows, window=100):
    """(bytes, removed, runs, rest) per row of (id, text) in corpus order."""
    seen, out = set(), []
    for data in rows:
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - window + 1):
            w = data[s : s + window]
            if w in seen:
                gone[s : s + window] = True
            seen.add(w)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(data), int(gone.sum()), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(1500):
        text = [rng.randint(1, rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 40))]
        order = suffix_dedup.suffix_array(text)
        assert order == sorted(range(len(text)), key=lambda i: text[i:])
        for (a, b), n in zip(zip(order, order[1:]), suffix_dedup.common_prefixes(text, order)[1:]):
            x, y = text[a:], text[b:]
            assert x[:n] == y[:n] and (len(x) == n or len(y) == n or x[n] != y[n])


def repeating(n, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd \n") for _ in range(400)) for _ in range(4)]
    line = "the common line of some seventy bytes that very many documents do hold"
    out = []
    for _ in range(n):
        t = ""
        for _ in range(rng.randint(0, 4)):
            k, b = rng.random(), rng.choice(base)
            if k < 0.3:
                t += b[rng.randint(0, 150) : rng.randint(200, 400)]
            elif k < 0.5:
                t += line
            elif k < 0.6:
                t += "ab" * rng.randint(0, 120)
            elif k < 0.7:
                t += "é" * rng.randint(0, 120)
            else:
                t += "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 200)))
            if rng.random() < 0.3 and len(t) > 3:
                p = rng.randrange(len(t))
                t = t[:p] + rng.choice("xyé") + t[p + 1 :]
        out.append(t)
    return out


def test_repeats_equal_brute_force_with_and_without_hot_anchors(spark):
    rows = list(enumerate(repeating(150, 7)))
    want = plain_cut([t.encode() for _, t in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for hot in (2000, 1):
        cut = suffix_dedup.remove_repeats(docs, keep=["doc_id"], hot_above=hot)
        got = {r.doc_id: r[1] for r in cut.collect()}
        for i, (size, removed, runs, rest) in enumerate(want):
            g = got[i]
            assert (g.n_bytes, g.n_removed, g.n_spans) == (size, removed, runs)
            assert g.kept == rest.decode("utf-8", "ignore")


def test_thousands_of_texts_under_a_null_id(spark):
    rng = random.Random(13)
    say = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [say(170) for _ in range(40)]
    rows = []
    for k in range(3000):
        # two of three texts hold a passage shared with others, at a place of their own; every third is clean
        t = say(rng.randint(100, 160))
        rows.append(t if k % 3 == 0 else t + rng.choice(shared)[rng.randint(0, 20) : rng.randint(150, 170)] + say(rng.randint(0, 80)))
    docs = spark.createDataFrame([(None, k, t) for k, t in enumerate(rows)], "doc_id long, k int, text string").repartition(7)
    # texts of one id stand in the order of their hash
    order = [r.k for r in docs.orderBy(F.xxhash64("text")).select("k").collect()]
    want = dict(zip(order, plain_cut([rows[k].encode() for k in order])))
    for hot in (2000, 1):
        cut = suffix_dedup.remove_repeats(docs, keep=["k"], hot_above=hot)
        got = {r.k: r[1] for r in cut.collect()}
        assert len(got) == len(rows)
        assert [k for k in range(0, len(rows), 3) if got[k].n_removed] == []
        for k, (size, removed, runs, rest) in want.items():
            g = got[k]
            assert (g.n_bytes, g.n_removed, g.n_spans, g.kept) == (size, removed, runs, rest.decode())


def test_long_texts_are_scanned_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 150)
    texts_ = [t.encode() for t in repeating(30, 9)]
    windows = set()
    for data, spans in suffix_dedup.pieces(texts_):
        _, _, place, low, high = suffix_dedup.anchors_of(np.frombuffer(data, np.uint8), spans[:, 2], spans[:, 3])
        owner = np.searchsorted(spans[:, 3], place, side="right")
        for o, a, b, p in zip(owner, low, high, place):
            i, offset, start, _ = spans[o]
            assert a <= p <= a + suffix_dedup.SPAN + (b - a)
            for w in range(a, b + 1):
                assert (i, w - start + offset) not in windows
                windows.add((i, w - start + offset))
    assert windows == {(i, s) for i, t in enumerate(texts_) for s in range(len(t) - 99)}


def test_repeats_of_awkward_documents(spark):
    docs = documents(spark)
    cut = suffix_dedup.remove_repeats(docs)
    name = cut.columns[-1]
    got = cut.collect()
    assert cut.columns[:-1] == docs.columns and len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r[name])
    all_texts = texts()
    assert by_id[0][0].n_bytes == 0 and by_id[0][0].kept == ""
    # the first of equal texts stays whole, and so do identical rows of it
    assert [g.n_removed for g in by_id[6]] == [0, 0, 0]
    assert by_id[7][0].n_removed == len(all_texts[7].encode()) and by_id[7][0].kept == ""
    assert by_id[11][0].n_removed == 30_000 - 1 and by_id[11][0].n_spans == 1
    assert sum(len(v) for v in by_id.values()) == docs.count()
    assert suffix_dedup.remove_repeats(empty(spark)).collect() == []
