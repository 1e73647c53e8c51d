"""Phrase collocations, importance resampling and the vector graph against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import phrases, resample, vector_graph
from tests.llm.cases import documents, empty, texts


def brute_phrases(rows, order, least, top):
    f, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for m in range(1, order + 1):
                for i in range(len(words) - m + 1):
                    key = (lang, tuple(words[i : i + m]))
                    f[key] = f.get(key, 0) + 1
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in cands.items():
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        around = [
            b for (g, q), b in cands.items()
            if g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        ]
        if any(100 * b >= 50 * a for b in around):
            continue
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return {
        (lang, i + 1, p.decode(), -a, l, r, totals[lang], -s)
        for lang, found in out.items()
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])
    }


def phrase_rows(n=160, seed=5):
    rng = random.Random(seed)
    words = ["New", "york", "City", "of", "the", "été", "日本", "x1", "a-b", " "]
    fixed = ["new york city", "of the", "Of The New York", "x1\tx1 x1"]
    out = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 30))]
        out.append((["en", "fr", None, "und"][i % 4], "".join(p + rng.choice([" ", "  ", "\t", ", ", ".\n", " "]) for p in parts)))
    return out + [("en", None), ("fr", ""), ("en", " \t\n"), ("long", "la di da " * 20_000), (None, "la di da. " * 30)]


@pytest.mark.parametrize("order, least, top", [(3, 10, 2000), (2, 3, 5), (4, 4, 50)])
def test_collocations_equal_brute_force(spark, monkeypatch, order, least, top):
    rows = phrase_rows()
    monkeypatch.setattr(phrases, "PART_BYTES", 20_000)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5).withColumn("grp", F.lit("other"))
    got = {tuple(r) for r in phrases.collocations(df, order, least, top).collect()}
    assert got == brute_phrases(rows, order, least, top)


def test_windows_counted_in_several_lots(spark):
    rows = phrase_rows(40, 9)
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    before = phrases.WORDS_AT_ONCE
    whole = phrases.lead_windows(df, 3, 4).count()
    try:
        phrases.WORDS_AT_ONCE = 50  # read when the plan is made, shipped with it
        lots = phrases.lead_windows(df, 3, 4)
        assert lots.count() >= whole
    finally:
        phrases.WORDS_AT_ONCE = before
    assert phrases.pieces_of("A b,\x0bc\x0c. D\td".encode()) == [[b"a", b"b"], [b"c"], [" d".encode(), b"d"]]


def test_collocations_of_awkward_documents(spark):
    assert phrases.collocations(empty(spark)).count() == 0
    rows = [(r.lang, r.text) for r in documents(spark).select("lang", "text").collect()]
    assert {tuple(r) for r in phrases.collocations(documents(spark)).collect()} == brute_phrases(rows, 3, 10, 2000)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute_resample(rows, target, percent, min_words, seed, max_n, buckets):
    def feats(text):
        w = words(text)
        return [" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]

    bucket = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, feats(text)))
    for text in target:
        t.update(map(bucket, feats(text)))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        found = feats(text)
        weight = sum(gain[bucket(x)] for x in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None, len(words(text))])
    fit = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("max_n, percent, min_words", [(1, 10, 20), (2, 50, 1), (3, 100, 0)])
def test_resampling_equals_brute_force(spark, max_n, percent, min_words):
    rng = random.Random(max_n)
    vocabulary = ["alpha", "Beta", "9", "é", "日本", "##", "x_y"]
    line = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9)))
    common = [line() for _ in range(5)]
    rows = [(i, "\n".join(rng.choice(common) if rng.random() < 0.5 else line() for _ in range(rng.randint(0, 12)))) for i in range(150)]
    rows += [(1000 + i, t) for i, t in enumerate(texts())] + [(None, "no id " * 30), rows[3], rows[3], (3, rows[4][1])]
    target = ["alpha beta\ngamma 9", None, "", "the model of data " * 50]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns({c: F.lit(c) for c in ("id", "weight", "at")})
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(docs, bench, percent, min_words, 2024, max_n, buckets=500)
    assert Counter(map(tuple, got.collect())) == brute_resample(rows, target, percent, min_words, 2024, max_n, 500)


def test_resampling_of_empty_tables(spark):
    assert resample.resample(empty(spark), documents(spark)).count() == 0
    got = resample.resample(documents(spark), empty(spark))
    assert got.count() == documents(spark).count()
    assert got.where("weight <> 0").count() > 0  # all corpus counts against a target of none


def vector_rows(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for size in (1, 1, 2, 5, 40, 300):
        center = rng.normal(size=24)
        for _ in range(size):
            rows.append((center + rng.normal(size=24) * 0.15 * rng.random()).tolist())
    rows += rng.normal(size=(250, 24)).tolist()
    rows += [rows[20]] * 4 + [[2 * x for x in rows[20]]]
    rows += [rng.normal(size=7).tolist()] * 2 + [[1e300] * 24, [1e300 + 1e290] * 24, [1e-300] * 24]
    bad = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23]
    return [(i * 3, v) for i, v in enumerate(rows + bad)] + [(None, rows[0]), (9, rows[5])]


def brute_vectors(rows):
    unit = []
    for _, v in rows:
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        u = np.array(v, float) / np.abs(np.array(v, float)).max() if ok else None
        unit.append(u / np.linalg.norm(u) if ok else None)
    n = len(rows)
    near = [
        [j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
        for i in range(n)
    ]
    comp = list(range(n))
    for i in range(n):
        todo, got = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in got:
                    got.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in got if rows[j][0] is not None]
        comp[i] = min(ids) if ids else None
    return Counter((rows[i][0], len(near[i]), comp[i]) for i in range(n))


@pytest.mark.parametrize("shard, block", [(2048, 4096), (96, 40)])
def test_vector_graph_equals_brute_force(spark, shard, block):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    df = df.withColumns({c: F.lit(c) for c in ("id", "node", "h", "times", "vec", "root")})
    got = vector_graph.near_vectors(df, shard=shard, block=block, recall=1.0).collect()
    want = brute_vectors(rows)
    have = Counter((r.id, r.n_links, r.component_id) for r in got)
    assert sum(have.values()) == sum(want.values())
    assert all(0.9 <= r.recall <= 1 for r in got)
    links = lambda c: sum(k[1] * m for k, m in c.items())
    assert 0.98 * links(want) <= links(have) <= links(want)
    if block > 96:
        assert have == want


def test_vector_graph_without_directions(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    got = vector_graph.near_vectors(df).select("id", "n_links", "component_id").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 0, 2)]
    assert vector_graph.near_vectors(df.where("false")).count() == 0


def test_graph_reaches_and_prunes():
    rng = np.random.default_rng(1)
    vecs = rng.normal(size=(700, 16))
    vecs = np.concatenate([vecs, vecs[:1] + 0.01 * rng.normal(size=(300, 16))])
    vecs /= np.linalg.norm(vecs, axis=1, keepdims=True)
    graph = vector_graph.Graph(vecs)
    graph.build(32)
    assert (graph.out >= 0).sum(1).max() <= vector_graph.DEGREE + 2
    reached, front = set(graph.medoids.tolist()), graph.medoids
    while len(front):
        front = np.array([x for x in np.unique(graph.out[front]) if x >= 0 and x not in reached], int)
        reached |= set(front.tolist())
    assert len(reached) == 1000
    found = graph.in_range(vecs, 0.9, 32)
    true = vecs @ vecs.T >= 0.9
    assert not (found & ~true).any()
    assert found.sum() >= 0.99 * true.sum()
