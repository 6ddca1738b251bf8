"""Approximate nearest neighbours by largest inner product, on robust-pruned directed graphs.

Distinct vectors are nodes, so copies of a vector are one node however many there are. Every vector gets one more
coordinate that makes inner product order and Euclidean order agree. Nodes are dealt to parts by the nearest of as
many centres (k-means on a bounded sample of at most `SAMPLE` vectors, every row is dealt); a part above twice
`shard_size` is split by a hash into shards, so a shard's memory does not grow with the corpus. In a shard the
nearest `offered` nodes of each node, found in blocks of matrix products, are its proposed edges; relaxed distance
pruning (keep the nearest, drop what is `alpha` times nearer to a kept one than to the node) leaves at most
`degree` diverse ones, and reverse edges are pruned the same way. The index is a written table with a row per shard.

A query visits the parts with the nearest centres. How many is measured, not set: a sample of `ASKED` queries is
answered exactly over all vectors, and so many parts are visited that `ROUTED` of those answers lie in them (with up to
`FEW` parts: all). In a shard a greedy beam search starts from the nearest of the entry nodes; its beam is measured
too: it widens until a sample of the shard's queries finds `FOUND` of its exact answers there. Found nodes are scored
again in double precision on the original vectors. The first `FEW` parts answer first; later ones send only what can
still enter a query's best.

A node stands for all rows with its vector, but only the least `k` + 1 ids are kept: no answer can need more,
as ties go to the smaller id and the query itself takes one place at most.

Edge cases: vectors that are null, empty, zero or hold null or non-finite numbers take no part, nor do null
ids; rows equal in id and vector count once; vectors of another length are compared among themselves; fewer
candidates than `k` are all returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import Scratch

#: Parts that are always visited; share of a sample's exact answers that the visited parts, and the beam in a shard, must hold.
FEW, ROUTED, FOUND = 8, 0.96, 0.95
#: Vectors of the sample that centres are fitted on, and its bytes; most centres; queries of a sample that is answered exactly.
SAMPLE, SAMPLE_BYTES, CENTRES, ASKED = 65_536, 33_554_432, 4096, 128


class Graph:
    """A robust-pruned graph over the rows of x (float32); neighbours < 0 are empty places."""

    def __init__(self, x: np.ndarray, degree: int, offered: int, alpha: float, seed: int):
        norms = np.einsum("ij,ij->i", x, x, dtype=np.float64)
        self.x = np.column_stack([x, np.sqrt(np.maximum(norms.max() - norms, 0.0))]).astype(np.float32)
        self.sq = np.einsum("ij,ij->i", self.x, self.x)
        self.degree, self.alpha = degree, alpha
        n, rng = len(x), np.random.default_rng(seed)
        self.near = np.full((n, degree), -1, np.int32)
        count = min(n, max(64, n // 32))
        even = float(self.x[:, -1].max()) <= 1e-3 * float(np.sqrt(norms.max(initial=0.0)))
        longest = np.empty(0, np.int64) if even else np.argsort(self.x[:, -1], kind="stable")[:count]
        self.entries = np.union1d(rng.permutation(n)[:count], longest).astype(np.int32)
        every, half = np.arange(n), degree if even else degree // 2
        for at in range(0, n, 256):
            nodes = every[at : at + 256]
            points = self.x[nodes]
            self.near[nodes, :half] = self.pruned(nodes, points, self.exact(points, offered + 1), alpha, half)
            if not even:  # questions lie where the added coordinate is 0: half the edges lead to a node's answers as one
                points[:, -1] = 0
                self.near[nodes, half:] = self.pruned(nodes, points, self.exact(points, offered + 1), alpha, degree - half)
        self.link_back(every)

    def exact(self, q: np.ndarray, k: int) -> np.ndarray:
        """The nearest k nodes of each query row (all, if fewer), in any order, by comparing with every node."""
        if not hasattr(self, "table"):
            self.table = np.ascontiguousarray(np.column_stack([-2 * self.x, self.sq]).T)
        d = np.column_stack([q, np.ones(len(q), np.float32)]) @ self.table
        n, wide = len(self.x), 64
        k, whole = min(k, n), n // wide * wide
        if whole <= 2 * k * wide:
            return np.argpartition(d, k - 1, axis=1)[:, :k].astype(np.int32)
        # the nearest k lie in the k blocks of nodes with the least minima, or behind the last whole block
        blocks = np.argpartition(d[:, :whole].reshape(len(q), -1, wide).min(axis=2), k - 1, axis=1)[:, :k]
        at = (blocks[:, :, None] * wide + np.arange(wide)).reshape(len(q), -1)
        at = np.concatenate([at, np.broadcast_to(np.arange(whole, n), (len(q), n - whole))], 1)
        best = np.argpartition(np.take_along_axis(d, at, 1), k - 1, axis=1)[:, :k]
        return np.take_along_axis(at, best, 1).astype(np.int32)

    def distances(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each query row to its row of nodes, less the query's own norm."""
        return self.sq[nodes] - 2 * np.matmul(self.x[nodes], q[:, :, None])[:, :, 0]

    def search(self, q: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Greedy beam search of all query rows at once: (nodes, distances), nearest first, -1 where fewer."""
        m, rows = len(q), np.arange(len(q))[:, None]
        dist = self.sq[self.entries] - 2 * (q @ self.x[self.entries].T)
        by = np.argpartition(dist, min(beam, dist.shape[1]) - 1, axis=1)[:, :beam]
        by = np.take_along_axis(by, np.argsort(np.take_along_axis(dist, by, 1), axis=1, kind="stable"), 1)
        pool, dist = self.entries[by], np.take_along_axis(dist, by, 1)
        seen = np.zeros((m, len(self.x)), bool)
        seen[rows, pool] = True
        done = np.zeros(pool.shape, bool)
        while True:
            rank = np.where(done | ~np.isfinite(dist), np.inf, dist)
            pick = np.argsort(rank, axis=1, kind="stable")[:, :width]
            open_ = np.isfinite(np.take_along_axis(rank, pick, 1))
            active = np.flatnonzero(open_.any(axis=1))
            if not len(active):
                return np.where(np.isfinite(dist), pool, -1), dist
            pick, open_ = pick[active], open_[active]
            done[active[:, None], pick] |= open_
            new = np.where(open_[:, :, None], self.near[pool[active[:, None], pick]], -1).reshape(len(active), -1)
            safe = np.maximum(new, 0)
            fresh = (new >= 0) & ~seen[active[:, None], safe]
            seen[np.broadcast_to(active[:, None], new.shape)[fresh], new[fresh]] = True
            # a node proposed twice in one step counts once
            by = np.argsort(new, axis=1, kind="stable")
            ordered = np.take_along_axis(new, by, 1)
            twice = np.zeros(new.shape, bool)
            np.put_along_axis(twice, by[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
            d = np.where(fresh & ~twice, self.distances(q[active], safe), np.inf)
            all_pool, all_dist = np.concatenate([pool[active], safe], 1), np.concatenate([dist[active], d], 1)
            all_done = np.concatenate([done[active], np.zeros(new.shape, bool)], 1)
            keep = min(beam, all_dist.shape[1])
            by = np.argsort(all_dist, axis=1, kind="stable")[:, :keep]
            if keep > pool.shape[1]:
                grow = ((0, 0), (0, keep - pool.shape[1]))
                pool, dist, done = np.pad(pool, grow), np.pad(dist, grow, constant_values=np.inf), np.pad(done, grow)
            pool[active], dist[active], done[active] = (np.take_along_axis(a, by, 1) for a in (all_pool, all_dist, all_done))

    def pruned(self, nodes: np.ndarray, points: np.ndarray, offered: np.ndarray, relax: float, most: int) -> np.ndarray:
        """Each node's edges among the offered (-1: none): nearest to its point first, dropping what a kept edge covers."""
        all_out = np.full((len(nodes), most), -1, np.int32)
        for a in range(0, len(nodes), 256):
            p, c = nodes[a : a + 256], np.sort(offered[a : a + 256], axis=1)
            c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
            bad, c = (c < 0) | (c == p[:, None]), np.maximum(c, 0)
            at = points[a : a + 256]
            d = np.where(bad, np.inf, self.distances(at, c) + np.einsum("ij,ij->i", at, at)[:, None])
            v = self.x[c]
            between = self.sq[c][:, :, None] + self.sq[c][:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
            rows, out = np.arange(len(p)), all_out[a : a + 256]
            left = d.copy()
            for k in range(most):
                j = left.argmin(axis=1)
                ok = np.isfinite(left[rows, j])
                if not ok.any():
                    break
                out[ok, k] = c[rows, j][ok]
                left[(relax * relax * between[rows, j] <= d) & ok[:, None]] = np.inf
                left[rows, j] = np.inf
        return all_out

    def link_back(self, nodes: np.ndarray) -> None:
        """Offer each of the nodes to those that its edges lead to."""
        source = np.repeat(nodes, self.degree)
        target = self.near[nodes].reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        start = np.flatnonzero(np.diff(target, prepend=-1))
        size = np.diff(np.append(start, len(target)))
        nth = np.arange(len(target)) - np.repeat(start, size)
        for a in range(0, int(size.max(initial=0)), 32):
            mine = (nth >= a) & (nth < a + 32)
            who, row = np.unique(target[mine], return_inverse=True)
            offers = np.full((len(who), 32), -1, np.int32)
            offers[row, nth[mine] - a] = source[mine]
            self.near[who] = self.pruned(who, self.x[who], np.concatenate([offers, self.near[who]], 1), self.alpha, self.degree)


    def fitting_beam(self, q: np.ndarray, floor: np.ndarray, k: int, share: float) -> int:
        """The narrowest beam tried that finds that share of the k nearest nodes of the query rows, those under `floor` left out."""
        beam, true = k + 12, self.exact(q, k)
        counts = np.einsum("qrd,qd->qr", self.x[true], q) >= floor[:, None]
        mark = np.zeros((len(q), len(self.x)), bool)
        np.put_along_axis(mark, true, counts, 1)
        while beam < len(self.x):
            nodes, _ = self.search(q, beam)
            if (np.take_along_axis(mark, np.maximum(nodes, 0), 1) & (nodes >= 0)).sum() >= share * counts.sum():
                break
            beam = beam * 3 // 2
        return beam


INDEX = "dim int, part int, sub int, vectors binary, near binary, entries binary, extra binary, ids binary, id_sizes binary"


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)


def build(degree: int, offered: int, alpha: float, seed: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        x = matrix(group.column("vector").combine_chunks(), dim)
        ids = group.column("ids").combine_chunks()
        g = Graph(x, degree, offered, alpha, seed)
        row = [*(k.as_py() for k in key), x.tobytes(), g.near.tobytes(), g.entries.tobytes(), np.ascontiguousarray(g.x[:, -1]).tobytes(), ids.flatten().to_numpy().astype(np.int64).tobytes(), ids.value_lengths().to_numpy().astype(np.int32).tobytes()]
        kinds = [*[pa.int32()] * 3, *[pa.binary()] * 6]
        return pa.table({n.split()[0]: pa.array([v], k) for n, v, k in zip(INDEX.split(", "), row, kinds)})

    return run


def loaded(row: dict, degree: int) -> tuple[Graph, np.ndarray, np.ndarray]:
    g = Graph.__new__(Graph)
    x = np.frombuffer(row["vectors"], np.float32).reshape(-1, row["dim"])
    g.x = np.column_stack([x, np.frombuffer(row["extra"], np.float32)])
    g.sq = np.einsum("ij,ij->i", g.x, g.x)
    g.near = np.frombuffer(row["near"], np.int32).reshape(-1, degree)
    g.entries = np.frombuffer(row["entries"], np.int32)
    return g, np.frombuffer(row["ids"], np.int64), np.concatenate([[0], np.cumsum(np.frombuffer(row["id_sizes"], np.int32))])


HIT = "query long, query_id long, vec_id long, score double"


def answer(k: int, degree: int):
    """A shard and the queries that visit it -> their best k there, of at least the score `floor` each."""

    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        names, out = [c.split()[0] for c in HIT.split(", ")], []
        if index.num_rows and asked.num_rows:
            row = index.to_pylist()[0]
            g, ids, at = loaded(row, degree)
            q = matrix(asked.column("vector").combine_chunks(), row["dim"])
            keys, own, floor = (asked.column(c).to_numpy() for c in ("query", "query_id", "floor"))
            wide = np.column_stack([q, np.zeros(len(q), np.float32)])
            some = np.argsort(keys, kind="stable")[: ASKED // 2]
            beam = g.fitting_beam(wide[some], floor[some], k, FOUND)
            for a in range(0, len(q), 256):
                part = slice(a, min(a + 256, len(q)))
                nodes, _ = g.search(wide[part], beam)
                safe = np.maximum(nodes, 0)
                exact = np.einsum("qrd,qd->qr", g.x[safe][:, :, :-1].astype(np.float64), q[part].astype(np.float64))
                exact[nodes < 0] = -np.inf
                # nodes below the k + 1 best cannot enter, whatever their ids; equal scores stay
                least = np.partition(exact, -(k + 1), axis=1)[:, [-(k + 1)]] if exact.shape[1] > k else -np.inf
                i, j = np.nonzero((nodes >= 0) & (exact >= np.maximum(least, floor[part, None])))
                node, score = nodes[i, j], exact[i, j]
                size = at[node + 1] - at[node]
                each = np.repeat(np.arange(len(node)), size)
                vec = ids[at[node][each] + np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)]
                i, node, score = i[each], node[each], score[each]
                self_ = np.flatnonzero(vec == own[part][i])
                other = np.ones(len(vec), bool)
                other[self_] = (g.x[node[self_], :-1] != q[part][i[self_]]).any(axis=1)
                i, vec, score = i[other], vec[other], score[other]
                by = np.lexsort((vec, -score, i))
                i, vec, score = i[by], vec[by], score[by]
                first = np.searchsorted(i, np.arange(part.stop - a))
                best = np.arange(len(i)) - first[i] < k
                out.append((keys[part][i[best]], own[part][i[best]], vec[best], score[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], [], []]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, [*[pa.int64()] * 3, pa.float64()])})

    return run


def centres_of(x: np.ndarray, most_norm: float, parts: int, seed: int) -> np.ndarray:
    """k-means of the sample x with the coordinate that makes inner product order Euclidean."""
    x, rng = lengthened(x, most_norm), np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:parts]].copy()
    for _ in range(8):
        own = np.concatenate([closeness(x[a : a + 4096], c).argmax(axis=1) for a in range(0, len(x), 4096)])
        by = np.argsort(own, kind="stable")
        there, start = np.unique(own[by], return_index=True)
        c[there] = np.add.reduceat(x[by], start, axis=0) / np.diff(np.append(start, len(x)))[:, None]
    return c


def lengthened(x: np.ndarray, most_norm: float) -> np.ndarray:
    norms = np.einsum("ij,ij->i", x, x, dtype=np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(most_norm - norms, 0.0))]).astype(np.float32)


def closeness(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return x @ c.T - 0.5 * np.einsum("ij,ij->i", c, c)


def questions(q: np.ndarray) -> np.ndarray:
    return np.column_stack([q, np.zeros(len(q), np.float32)])


def vectors_by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        yield dim, rows, matrix(batch.column("vector").take(pa.array(rows)), dim)


def dealt(centres: dict):
    """Nodes with the part of their nearest centre; `centres`: dim -> (centres, greatest squared norm)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.zeros(batch.num_rows, np.int32)
            for dim, rows, x in vectors_by_dim(batch):
                if dim in centres:
                    part[rows] = closeness(lengthened(x, centres[dim][1]), centres[dim][0]).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=[*batch.schema.names, "part"])

    return run


def routed(centres: dict, visits: dict):
    """Queries once for each part they visit, `nth` from 0 for the nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 512):
                batch = whole.slice(a, 512)
                for dim, rows, q in vectors_by_dim(batch):
                    parts = np.zeros((len(q), 1), np.int64)
                    if dim in centres:
                        parts = np.argsort(-closeness(questions(q), centres[dim][0]), axis=1, kind="stable")[:, : visits[dim]]
                    again = pa.array(np.repeat(rows, parts.shape[1]))
                    nth = np.tile(np.arange(parts.shape[1], dtype=np.int32), len(q))
                    yield pa.RecordBatch.from_arrays([*(c.take(again) for c in batch.columns), pa.array(parts.reshape(-1).astype(np.int32)), pa.array(nth)], names=[*batch.schema.names, "part", "nth"])

    return run


def answered_exactly(asked: dict, k: int):
    """The nearest k nodes of each sample query among those of a task, by comparing with every node: (dim, s, score, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for batch in batches:
            for dim, rows, x in vectors_by_dim(batch):
                if dim in asked:
                    score, part = asked[dim] @ x.T, np.broadcast_to(batch.column("part").to_numpy()[rows], (len(asked[dim]), len(x)))
                    if dim in best:
                        score, part = (np.concatenate(b, 1) for b in zip(best[dim], (score, part)))
                    by = np.argpartition(-score, min(k, score.shape[1]) - 1, axis=1)[:, :k]
                    best[dim] = np.take_along_axis(score, by, 1), np.take_along_axis(part, by, 1)
        for dim, (score, part) in best.items():
            s = np.repeat(np.arange(len(score), dtype=np.int32), score.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), dim, np.int32)), pa.array(s), pa.array(score.reshape(-1).astype(np.float64)), pa.array(part.reshape(-1).astype(np.int32))], names=["dim", "s", "score", "part"])

    return run


def fit_centres(nodes: DataFrame, size: int, seed: int) -> dict:
    """dim -> (centres, greatest squared norm) for the vector lengths with more than `size` nodes."""
    norm = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v.cast("double") * v)
    large = nodes.groupBy("dim").agg(F.count("*").alias("n"), F.max(norm).alias("norm")).where(F.col("n") > size).collect()
    centres = {}
    for dim, n, most_norm in large:
        parts = min(-(-n // size), CENTRES)
        want = min(SAMPLE, 64 * parts, max(SAMPLE_BYTES // (4 * dim), 16))
        sample = nodes.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("h"), F.lit(max(n // want, 1))) == 0)).limit(2 * want).select("vector").toArrow()
        x = matrix(sample.column("vector").combine_chunks(), dim)
        centres[dim] = centres_of(x, most_norm, min(parts, len(x)), seed), most_norm
    return centres


def visits_of(placed: DataFrame, asked: DataFrame, centres: dict, k: int) -> dict:
    """dim -> number of nearest parts to visit, so that they hold the share ROUTED of a sample's exact answers."""
    visits = {dim: min(len(c), FEW) for dim, (c, _) in centres.items()}
    many = {dim: questions(matrix(t.column("vector").combine_chunks(), dim)) for dim, (c, _) in centres.items() if len(c) > FEW and (t := asked.where(F.col("dim") == dim).orderBy(F.xxhash64("query_id", "query")).limit(ASKED).select("vector").toArrow()).num_rows}
    if many:
        best = placed.mapInArrow(answered_exactly({d: q[:, :-1] for d, q in many.items()}, k + 1), "dim int, s int, score double, part int")
        order = Window.partitionBy("dim", "s").orderBy(F.desc("score"))
        # a query's own vector is its nearest or close to it, and always in a near part: it does not count
        true = best.withColumn("nth", F.row_number().over(order)).where((F.col("nth") > 1) & (F.col("nth") <= k + 1)).collect()
        for dim, q in many.items():
            place = np.argsort(np.argsort(-closeness(q, centres[dim][0]), axis=1, kind="stable"), axis=1)
            at = np.sort([place[r.s, r.part] for r in true if r.dim == dim])
            visits[dim] = max(FEW, int(at[int(np.ceil(ROUTED * len(at))) - 1]) + 1) if len(at) else len(centres[dim][0])
    return visits


def nearest(vectors: DataFrame, queries: str = "vec_id % 20 = 0", k: int = 20, shard_size: int = 32_768, block: int = 32_768, degree: int = 64, offered: int = 64, alpha: float = 1.2, seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score; `queries` is a condition on vec_id."""
    scratch = Scratch(vectors.sparkSession, "ann")
    raw = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("vector"))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    rows = raw.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & F.coalesce(fine, F.lit(False)))
    rows = rows.withColumns({"dim": F.size("vector"), "h": F.xxhash64("vector")})
    least = Window.partitionBy("h", "vector").orderBy("vec_id")
    ids = rows.groupBy("h", "vector", "dim", "vec_id").agg(F.lit(1).alias("one")).withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= k + 1)
    nodes = scratch.write(ids.groupBy("h", "vector", "dim").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    size = min(shard_size, max(8192, nodes.count() // 16))  # small tables keep enough shards for their tasks
    centres = fit_centres(nodes, size, seed)
    placed = nodes.mapInArrow(dealt(centres), "h long, vector array<float>, dim int, ids array<long>, part int")
    sizes = scratch.write(placed.groupBy("dim", "part").agg(F.ceil(F.count("*") / F.lit(2 * size)).cast("int").alias("subs")), "sizes")
    sharded = placed.join(sizes, ["dim", "part"]).withColumn("sub", F.pmod(F.xxhash64("h"), F.col("subs")).cast("int")).select("dim", "part", "sub", "vector", "ids")
    index = scratch.write(sharded.groupBy("dim", "part", "sub").applyInArrow(build(degree, offered, alpha, seed), INDEX), "index")
    asked = rows.where(queries).groupBy("h", "vector", "dim", "vec_id").agg(F.lit(1).alias("one")).select(F.col("vec_id").alias("query_id"), "vector", "dim", F.monotonically_increasing_id().alias("query"))
    asked = scratch.write(asked, "asked")
    visits = visits_of(placed, asked, centres, k)
    sent = asked.mapInArrow(routed(centres, visits), "query_id long, vector array<float>, dim int, query long, part int, nth int")
    keys, best = ["dim", "part", "sub", "block"], Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")

    def found(these: DataFrame, name: str) -> DataFrame:
        loads = sizes.join(these.groupBy("dim", "part").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")), ["dim", "part"])
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        there = index.join(loads.select("dim", "part", "blocks"), ["dim", "part"]).withColumn("block", upto("blocks"))
        come = these.join(loads, ["dim", "part"]).withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int")).withColumn("sub", upto("subs"))
        come = come.select(*keys, "query", "query_id", "vector", "floor")
        hits = scratch.write(there.groupBy(*keys).cogroup(come.groupBy(*keys)).applyInArrow(answer(k, degree), HIT), name)
        return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    hits = found(sent.where(F.col("nth") < FEW).withColumn("floor", F.lit(float("-inf"))), "found")
    if max(visits.values(), default=0) > FEW:
        floors = hits.where(F.col("rank") == k).select("query", F.col("score").alias("floor"))
        later = sent.where(F.col("nth") >= FEW).join(scratch.write(floors, "floors"), "query", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        both = scratch.write(hits.drop("rank"), "first").unionByName(found(later, "later").drop("rank"))
        hits = both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return hits.select("query_id", "rank", "vec_id", "score")
