"""Near-duplicate vectors through a robust-pruned flat graph.

Equal vectors are one node.  Spherical k-means on a bounded sample gives centroids; every
node belongs to the shards of its ``overlap`` nearest ones.  A shard of more than BLOCK
members is cut into blocks by a hash.  Each block builds a graph by inserting its members
batch by batch: a greedy search from the block's medoids finds the candidates, robust
pruning (a candidate goes when an edge already chosen leads closer to it by the factor
ALPHA) keeps at most DEGREE edges, edges back are added and pruned likewise.  The
adjacency lists that a node got in its shards are united to one flat graph.

Every node then searches the graph of its shards from their medoids: a greedy search with
a beam, and, where it meets vectors in range, an expansion over all vectors in range until
none is left open.  What is found is verified by the cosine in double precision.  A pair
that meets in several shards is counted in the least of them, so counts are sums and a
task sends counts and a spanning forest of its links, never the links.  The blocks of an
overfull shard are searched pair by pair, which keeps memory bounded and loses no pair.

Recall is audited against brute force with AUDIT nodes as queries against all nodes; below
``recall`` the search is repeated with twice the overlap and beam.

Cases: a vector that is null, empty or zero, or that holds null or non-finite components,
links with nothing; so do vectors of different lengths; equal rows are linked rows; the
least id of a component leaves out null ids unless all are null; very long vectors shrink
the sample, not the results; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored
from quire.llm.simhash import components, forest

SHARD, BLOCK = 2048, 4096
MAX_CENTROIDS = 4096
#: Bytes of the sample that the centroids are fitted on (at most 32 vectors a centroid).
SAMPLE_BYTES = 64 << 20
DEGREE, ALPHA = 24, 1.2
MEDOIDS = 8
AUDIT = 1024
#: Queries that a task searches for together, and the edges it follows at once for each of them.
TOGETHER, WIDE = 512, 4
#: The expansion also passes through vectors this much below the range.
MARGIN = 0.05


def usable(vec: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0)


def units(vecs: pa.Array) -> np.ndarray:
    """Rows of one length as unit vectors in double precision."""
    rows = vecs.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vecs), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def by_length(vecs: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each length."""
    size = np.diff(vecs.offsets.to_numpy())
    return [(at, units(vecs.take(pa.array(at)))) for d in np.unique(size) for at in [np.flatnonzero(size == d)]]


def fitted(vecs: np.ndarray, dim: int) -> np.ndarray:
    """Cut or padded with zeros to ``dim`` columns, for routing alone."""
    if vecs.shape[1] >= dim:
        return vecs[:, :dim]
    return np.pad(vecs, ((0, 0), (0, dim - vecs.shape[1])))


def spherical_kmeans(vecs: np.ndarray, k: int, steps: int = 6) -> np.ndarray:
    """``k`` unit centroids (fewer if there are fewer vectors)."""
    rng = np.random.default_rng(7)
    centers = vecs[rng.permutation(len(vecs))[:k]]
    for _ in range(steps):
        near = np.concatenate([(vecs[i : i + 8192] @ centers.T).argmax(1) for i in range(0, len(vecs), 8192)])
        sums = np.zeros_like(centers)
        np.add.at(sums, near, vecs)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centers)
    return centers


class Graph:
    """A navigable graph over some vectors; ``out`` holds each one's edges, padded with -1."""

    def __init__(self, vecs: np.ndarray, out: np.ndarray | None = None):
        self.exact, self.vecs = vecs, vecs.astype(np.float32)
        centers = spherical_kmeans(self.vecs, min(MEDOIDS, len(vecs)), 3)
        self.medoids = np.unique((centers @ self.vecs.T).argmax(1))
        self.out = np.full((len(vecs), DEGREE), -1, np.int32) if out is None else out

    def greedy(self, queries: np.ndarray, starts: np.ndarray, beam: int):
        """(beam's ids, all ids expanded, seen rows x nodes, pairs met with their similarity) of a best-first search."""
        q, n = len(queries), len(self.vecs)
        sims = queries @ self.vecs[starts].T
        ids = np.full((q, beam), -1)
        best = np.full((q, beam), -np.inf, np.float32)
        order = np.argsort(-sims, axis=1)[:, :beam]
        ids[:, : order.shape[1]] = starts[order]
        best[:, : order.shape[1]] = np.take_along_axis(sims, order, 1)
        seen = np.zeros((q, n), bool)
        seen[:, starts] = True
        done = np.zeros((q, beam), bool)
        met = [(np.repeat(np.arange(q), len(starts)), np.tile(starts, q), sims.ravel())]
        path = []
        while True:
            free = ~done & (ids >= 0)
            live = np.flatnonzero(free.any(1))
            if not len(live):
                break
            pick = free[live] & (np.cumsum(free[live], 1) <= WIDE)
            done[live] |= pick
            row, col = np.nonzero(pick)
            slot = (np.cumsum(pick, 1) - 1)[row, col]
            taken = np.full((len(live), WIDE), -1)
            taken[row, slot] = ids[live][row, col]
            path.append((live, taken))
            next_ = np.where(taken[:, :, None] >= 0, self.out[taken], -1).reshape(len(live), -1)
            fresh = self._unseen(live, next_, seen)
            r, c = np.nonzero(fresh)
            near = np.full(next_.shape, -np.inf, np.float32)
            near[r, c] = np.einsum("ij,ij->i", queries[live[r]], self.vecs[next_[r, c]])
            met.append((live[r], next_[r, c], near[r, c]))
            all_sims = np.concatenate([best[live], near], 1)
            top = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            best[live] = np.take_along_axis(all_sims, top, 1)
            all_ids = np.concatenate([ids[live], np.where(fresh, next_, -1)], 1)
            ids[live] = np.take_along_axis(all_ids, top, 1)
            flags = np.concatenate([done[live], np.zeros(next_.shape, bool)], 1)
            done[live] = np.take_along_axis(flags, top, 1)
        visited = np.full((q, WIDE * len(path)), -1)
        for i, (live, taken) in enumerate(path):
            visited[live, WIDE * i : WIDE * (i + 1)] = taken
        return ids, visited, seen, met

    def _unseen(self, rows: np.ndarray, nodes: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Which entries of ``nodes`` (a line of them for each of ``rows``) are new to their row; marks them seen."""
        n = seen.shape[1]
        keys = rows[:, None] * n + nodes
        flat = seen.reshape(-1)
        new = (nodes >= 0) & ~flat[np.where(nodes >= 0, keys, 0)]
        at = np.flatnonzero(new.ravel())
        kept, first = np.unique(keys.ravel()[at], return_index=True)
        out = np.zeros(nodes.size, bool)
        out[at[first]] = True
        flat[kept] = True
        return out.reshape(nodes.shape)

    def in_range(self, queries: np.ndarray, least: float, beam: int) -> np.ndarray:
        """Rows x nodes: the vectors found with a cosine of ``least`` or more."""
        found = np.zeros((len(queries), len(self.vecs)), bool)
        if not len(self.vecs):
            return found
        for lo in range(0, len(queries), TOGETHER):
            exact = queries[lo : lo + TOGETHER]
            part = exact.astype(np.float32)
            _, visited, seen, met = self.greedy(part, self.medoids, beam)
            rows, nodes, sims = (np.concatenate(x) for x in zip(*met))
            open_ = np.zeros(seen.shape, bool)  # in reach and not yet expanded
            near = sims >= least - MARGIN
            open_[rows[near], nodes[near]] = True
            r, c = np.nonzero(visited >= 0)
            hits = [(rows[near], nodes[near])]
            open_[r, visited[r, c]] = False
            rows, nodes = np.nonzero(open_)
            while len(rows):
                more = []
                for i in range(0, len(rows), 1 << 16):
                    r, next_ = rows[i : i + (1 << 16)], self.out[nodes[i : i + (1 << 16)]]
                    x, y = np.nonzero(self._unseen(r, next_, seen))
                    sims = np.einsum("ij,ij->i", part[r[x]], self.vecs[next_[x, y]])
                    ok = sims >= least - MARGIN
                    more.append((r[x[ok]], next_[x[ok], y[ok]]))
                rows, nodes = (np.concatenate(z) for z in zip(*more))
                hits.append((rows, nodes))
            for rows, nodes in hits:
                for i in range(0, len(rows), 1 << 16):
                    r, c = rows[i : i + (1 << 16)], nodes[i : i + (1 << 16)]
                    true = np.einsum("ij,ij->i", exact[r], self.exact[c]) >= least
                    found[lo + r[true], c[true]] = True
        return found

    def pruned(self, points: np.ndarray, cands: np.ndarray) -> np.ndarray:
        """Robust pruning of each point's candidates (-1: none) to at most DEGREE edges."""
        cands = np.where(cands == points[:, None], -1, cands)
        cands = -np.sort(-cands, axis=1)
        cands[:, 1:][cands[:, 1:] == cands[:, :-1]] = -1
        width = int((cands >= 0).sum(1).max(initial=0))
        cands = -np.sort(-cands, axis=1)[:, : max(width, 1)]
        here = self.vecs[cands]
        sims = np.einsum("qcd,qd->qc", here, self.vecs[points])
        order = np.argsort(np.where(cands >= 0, -sims, np.inf), axis=1, kind="stable")
        cands, sims = np.take_along_axis(cands, order, 1), np.take_along_axis(sims, order, 1)
        here = np.take_along_axis(here, order[:, :, None], 1)
        far = np.sqrt(np.maximum(2 - 2 * sims, 0))
        between = np.sqrt(np.maximum(2 - 2 * np.matmul(here, here.transpose(0, 2, 1)), 0))
        alive = cands >= 0
        out = np.full((len(points), DEGREE), -1, np.int32)
        for slot in range(DEGREE):
            some = np.flatnonzero(alive.any(1))
            if not len(some):
                break
            first = alive[some].argmax(1)
            out[some, slot] = cands[some, first]
            alive[some] &= ALPHA * between[some, first] > far[some]
            alive[some, first] = False
        return out

    def build(self, beam: int) -> None:
        """Inserts all vectors, the medoids first, in batches that see what came before them and each other."""
        n = len(self.vecs)
        rest = np.random.default_rng(11).permutation(n)
        order = np.concatenate([self.medoids, rest[~np.isin(rest, self.medoids)]])
        at = 0
        while at < n:
            batch = order[at : at + max(32, min(at, TOGETHER))]
            sims = self.vecs[batch] @ self.vecs[batch].T
            np.fill_diagonal(sims, -np.inf)
            own = batch[np.argsort(-sims, axis=1)[:, :16]]
            cands = [own]
            if at:
                ids, visited, _, _ = self.greedy(self.vecs[batch], self.medoids[self.medoids != -1][:at], beam)
                cands += [ids, visited]
            self.out[batch] = self.pruned(batch, np.concatenate(cands, 1))
            self._add_back(batch)
            at += len(batch)
        self._reach_all()

    def _add_back(self, batch: np.ndarray) -> None:
        row, slot = np.nonzero(self.out[batch] >= 0)
        src, dst = batch[row], self.out[batch][row, slot]
        sims = np.einsum("ij,ij->i", self.vecs[src], self.vecs[dst])
        order = np.lexsort((-sims, dst))
        src, dst = src[order], dst[order]
        points, start, count = np.unique(dst, return_index=True, return_counts=True)
        place = np.arange(len(dst)) - np.repeat(start, count)
        near = place < 2 * DEGREE  # the nearest of those that point here
        grid = np.full((len(points), 2 * DEGREE), -1)
        grid[np.repeat(np.arange(len(points)), count)[near], place[near]] = src[near]
        self.out[points] = self.pruned(points, np.concatenate([self.out[points], grid], 1))

    def _reach_all(self) -> None:
        """Gives every vector that no path from the medoids leads to an edge from one that has a path."""
        reached = np.zeros(len(self.vecs), bool)
        reached[self.medoids] = True
        front = self.medoids
        while True:
            while len(front):
                next_ = np.unique(self.out[front])
                front = next_[(next_ >= 0) & ~reached[np.maximum(next_, 0)]]
                reached[front] = True
            lost = np.flatnonzero(~reached)
            if not len(lost):
                return
            have = np.flatnonzero(reached)
            lost = lost[:TOGETHER]
            near = have[(self.vecs[lost] @ self.vecs[have].T).argmax(1)]
            if not (self.out[near, -1] < 0).all():
                self.out = np.concatenate([self.out, np.full((len(self.out), 1), -1, np.int32)], 1)
            _, first = np.unique(near, return_index=True)
            lost, near = lost[first], near[first]
            self.out[near, self.out.shape[1] - 1 - np.argmax(self.out[near, ::-1] < 0, 1)] = lost
            reached[lost] = True
            front = lost


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number that each row of ``a`` shares with that of ``b``."""
    same = a[:, :, None] == b[:, None, :]
    return np.where(same.any(2), a, np.iinfo(a.dtype).max).min(1)


def _column(met: pa.Table, name: str) -> pa.Array:
    return met.column(name).combine_chunks()


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _ordered(met: pa.Table) -> pa.Table:
    return met.sort_by("node").combine_chunks()


def build_block(beam: int):
    """node, out: the edges of one block's graph, by node."""

    def run(key: tuple[pa.Scalar, ...], met: pa.Table) -> pa.Table:
        met = _ordered(met)
        node = _column(met, "node").to_numpy()
        found = []
        for at, vecs in by_length(_column(met, "vec")):
            graph = Graph(vecs)
            graph.build(beam)
            size = (graph.out >= 0).sum(1)
            flat = node[at[graph.out[graph.out >= 0]]]
            bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            found.append(pa.table([pa.array(node[at]), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))], names=["node", "out"]))
        return pa.concat_tables(found)

    return run


def search_blocks(least: float, beam: int):
    """For one pair of a shard's blocks: (node, n) partial counts of links, (a, b) a spanning forest of them."""

    def run(key: tuple[pa.Scalar, ...], met: pa.Table) -> pa.Table:
        shard, one, two = (k.as_py() for k in key)
        met = _ordered(met)
        node, times = _column(met, "node").to_numpy(), _column(met, "times").to_numpy()
        block, shards = _column(met, "block").to_numpy(), _matrix(_column(met, "shards"))
        edges = _column(met, "out")
        counts = np.zeros(len(node), np.int64)
        linked = (node[:0], node[:0])
        for at, vecs in by_length(_column(met, "vec")):
            sides = [np.flatnonzero(block[at] == b) for b in (one, two)]
            graphs = []
            for side in sides if one != two else sides[:1]:
                lists = edges.take(pa.array(at[side]))
                size = np.diff(lists.offsets.to_numpy())
                ends = lists.flatten().to_numpy(zero_copy_only=False)
                place = np.searchsorted(node[at[side]], ends)
                here = node[at[side]][np.minimum(place, len(side) - 1)] == ends if len(side) else np.zeros(0, bool)
                row = np.repeat(np.arange(len(side)), size)[here]
                slot = np.arange(len(row)) - np.searchsorted(row, row)
                out = np.full((len(side), int(slot.max(initial=0)) + 1), -1, np.int32)
                out[row, slot] = place[here]
                graphs.append(Graph(vecs[side], out) if len(side) else None)
            if None in graphs:
                continue
            if one == two:
                found = graphs[0].in_range(vecs, least, beam)
                found |= found.T
                np.fill_diagonal(found, False)
            else:
                found = graphs[1].in_range(vecs[sides[0]], least, beam)
                found |= graphs[0].in_range(vecs[sides[1]], least, beam).T
            left, right = at[sides[0]], at[sides[1]]
            step = max(1, (1 << 20) // max(1, len(right)))
            for i in range(0, len(left), step):
                r, c = np.nonzero(found[i : i + step])
                a, b = left[r + i], right[c]
                mine = _first_common(shards[a], shards[b]) == shard
                np.add.at(counts, a[mine], times[b[mine]])
                if one != two:
                    np.add.at(counts, b[mine], times[a[mine]])
                if len(a):
                    linked = forest(np.concatenate([linked[0], node[a]]), np.concatenate([linked[1], node[b]]))
        some = np.flatnonzero(counts)
        n, m = len(some), len(linked[0])
        none = lambda size: pa.nulls(size, pa.int64())
        return pa.table(
            [
                pa.concat_arrays([pa.array(node[some]), none(m)]),
                pa.concat_arrays([pa.array(counts[some]), none(m)]),
                pa.concat_arrays([none(n), pa.array(linked[0])]),
                pa.concat_arrays([none(n), pa.array(linked[1])]),
            ],
            names=["node", "n", "a", "b"],
        )

    return run


def centroids_of(nodes: DataFrame, n: int, k: int) -> np.ndarray:
    """At most ``k`` centroids fitted on a bounded sample of the nodes, drawn by a hash."""
    dim = nodes.agg(F.max(F.size("vec")).alias("d")).first()["d"]
    want = max(1, min(32 * k, SAMPLE_BYTES // (8 * dim)))
    drawn = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(min(1.0, 1.5 * want / n) * (1 << 30)) + 1)
    sample = drawn.select("vec").limit(want).toArrow().column("vec").combine_chunks()
    rows = np.concatenate([fitted(v, dim) for _, v in by_length(sample)]) if len(sample) else np.zeros((0, dim))
    return spherical_kmeans(rows, max(1, min(k, len(rows) // 4)))


def routed(nodes: DataFrame, centers: np.ndarray, overlap: int) -> DataFrame:
    """``nodes`` once for each of the ``overlap`` nearest centroids: shard, node, times, vec, shards."""
    m = min(overlap, len(centers))
    rows = nodes.select("node", "times", "vec")
    kind = rows.schema["vec"].dataType.simpleString()

    def run(batches):
        for b in batches:
            vecs = b.column(2)
            near = np.zeros((b.num_rows, m), np.int64)
            for at, v in by_length(vecs):
                sims = fitted(v, centers.shape[1]) @ centers.T
                near[at] = np.sort(np.argpartition(-sims, m - 1, axis=1)[:, :m], axis=1)
            bounds = pa.array(np.arange(0, near.size + 1, m, dtype=np.int32))
            shards = pa.ListArray.from_arrays(bounds, pa.array(near.ravel()))
            for j in range(m):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near[:, j]), b.column(0), b.column(1), vecs, shards],
                    names=["shard", "node", "times", "vec", "shards"],
                )

    return rows.mapInArrow(run, f"shard long, node long, times long, vec {kind}, shards array<long>")


def linked_nodes(
    nodes: DataFrame, centers: np.ndarray, least: float, overlap: int, beam: int, block: int
) -> DataFrame:
    """(node, n) and (a, b) rows of all blocks' searches, stored."""
    members = stored(routed(nodes, centers, overlap), "members")
    sizes = members.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    members = members.join(stored(sizes, "sizes"), "shard").withColumn(
        "block", F.pmod(F.xxhash64("node", "shard"), F.col("blocks")).cast("int")
    )
    built = members.select("shard", "block", "node", "vec").groupBy("shard", "block")
    edges = built.applyInArrow(build_block(beam), "node long, out array<long>")
    united = stored(edges.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("out"))).alias("out")), "graph")
    pairs = members.join(united, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}).drop("blocks", "other")
    met = pairs.groupBy("shard", "one", "two")
    return stored(met.applyInArrow(search_blocks(least, beam), "node long, n long, a long, b long"), "links")


def audited_recall(nodes: DataFrame, counts: DataFrame, n: int, least: float) -> float:
    """Share of the links of AUDIT nodes (drawn by a hash) that ``counts`` has, against brute force over all nodes."""
    draw = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) < int(min(1.0, 1.2 * AUDIT / n) * (1 << 30)) + 1
    picked = nodes.where(draw).select("node", "vec").limit(AUDIT).toArrow()
    ids = picked.column("node").to_numpy()
    queries = [(ids[at], v) for at, v in by_length(picked.column("vec").combine_chunks())]

    def run(batches):
        for b in batches:
            for at, vecs in by_length(b.column(2)):
                times = b.column(1).to_numpy()[at]
                node = b.column(0).to_numpy()[at]
                for who, q in queries:
                    if q.shape[1] == vecs.shape[1]:
                        near = (q @ vecs.T >= least) & (who[:, None] != node[None, :])
                        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(near @ times)], names=["node", "n"])

    true = nodes.select("node", "times", "vec").mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("t"))
    both = true.join(counts, "node", "left").agg(
        F.sum("t").alias("t"), F.sum(F.least(F.col("t"), F.coalesce("n", F.lit(0)))).alias("n")
    ).first()
    return both["n"] / both["t"] if both["t"] else 1.0


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    least: float = 0.9,
    overlap: int = 3,
    beam: int = 32,
    recall: float = 0.95,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """id, n_links, component_id, recall for every row of ``vectors``.

    ``n_links`` counts the other rows found with a cosine of ``least`` or more; ``recall`` is what
    the audit measured.
    """
    vec = F.col(vec_col)
    rows = vectors.select(F.col(id_col).alias("id"), F.when(usable(vec), vec).alias("vec"))
    # 96 bits of hash stand for a vector's values
    rows = rows.withColumns({"h": F.when(F.col("vec").isNotNull(), F.xxhash64("vec")), "g": F.hash("vec")})
    nodes = rows.where(F.col("h").isNotNull()).groupBy("h", "g").agg(
        F.count(F.lit(1)).alias("times"), F.min("id").alias("least_id"), F.first("vec").alias("vec")
    )
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()
    if not n:
        return rows.select(
            "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(1.0).alias("recall")
        )
    centers = centroids_of(nodes, n, min(MAX_CENTROIDS, -(-overlap * n // shard)))
    while True:
        found = linked_nodes(nodes, centers, least, overlap, beam, block)
        counts = stored(found.where("node IS NOT NULL").groupBy("node").agg(F.sum("n").alias("n")), "counts")
        reached = audited_recall(nodes, counts, n, least)
        if reached >= recall or overlap >= len(centers):
            break
        overlap, beam = 2 * overlap, 2 * beam
    tree = components(found.where("a IS NOT NULL").select("a", "b").distinct(), "links")
    hung = tree.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = nodes.select("h", "g", "times", "least_id", "node").join(counts, "node", "left").join(hung, "node", "left")
    labels = stored(labels.withColumn("root", F.coalesce("root", "node")), "labels")
    names = stored(labels.groupBy("root").agg(F.min("least_id").alias("component_id")), "names")
    named = labels.join(names, "root").select(
        F.col("h").alias("h_"), F.col("g").alias("g_"),
        (F.col("times") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id",
    )
    named = stored(named, "named")
    plain = rows.select("id", "h", "g")
    met = plain.join(named, (plain["h"] == named["h_"]) & (plain["g"] == named["g_"]), "left")
    return met.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("h_").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.lit(float(reached)).alias("recall"),
    )
