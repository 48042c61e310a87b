"""Approximate nearest neighbours by a robust-pruned directed graph.

Equal vectors are one point of a graph, which keeps their smallest ids.  Points
are dealt to shards by hash.  A shard's graph is built in growing
batches: a greedy beam search over the graph so far proposes neighbours, and
robust pruning keeps an edge only if no kept neighbour is clearly closer to
its end (by the factor ``alpha``).  Queries search every shard by beam and the
best of all shards stand.  All steps work on a batch of points at a time.

A shard holds vectors whose lengths lie within a factor of two, so a few long
vectors do not blur the distances between the others.  Inside a shard inner
products become distances by one more coordinate, which lifts all vectors to
the same length, in units of the longest.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.cover_tree import usable
from tickwell.llm.frames import written

SHARD_BYTES = 16 << 20  # of the vectors of one graph, and of the queries of one task, in doubles
DEGREE = 32
SLACK = 1.5  # edges a point may gather, over its degree, before it is pruned again
BUILD_BEAM = 56
SEARCH_BEAM = 192
EXPAND = 4  # points of a beam that are expanded together
ALPHA = 1.2
BATCH = 512  # points searched together
K = 20


def lifted(x: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate, all of the same length, at most 1 each; nearest then means largest inner product."""
    x = x / np.abs(x).max(initial=np.finfo(float).tiny)  # squares neither overflow nor vanish
    length = (x * x).sum(axis=1)
    longest = length.max(initial=0.0) or 1.0
    extra = np.sqrt(np.maximum(0.0, longest - length))
    return (np.hstack([x, extra[:, None]]) / np.sqrt(longest)).astype(np.float32)


def beam_search(graph: np.ndarray, x: np.ndarray, queries: np.ndarray, start: int, beam: int, expand: int = EXPAND) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of the ``beam`` nearest points met, nearest first; -1 where fewer were met."""
    m, n, width = len(queries), len(x), graph.shape[1]
    expand = min(expand, beam)
    norms, own = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", queries, queries)
    ids = np.full((m, beam), -1, np.int64)
    far = np.full((m, beam), np.inf, np.float32)
    todo = np.zeros((m, beam), bool)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True  # where missing neighbours point
    ids[:, 0], todo[:, 0], seen[:, start] = start, True, True
    far[:, 0] = norms[start] + own - 2 * (queries @ x[start])
    rows = np.arange(m)
    while True:
        waiting = np.where(todo[rows], far[rows], np.inf)
        at = np.argpartition(waiting, expand - 1, axis=1)[:, :expand]
        going = np.take_along_axis(waiting, at, 1) < np.inf
        some = going.any(axis=1)
        rows, at, going = rows[some], at[some], going[some]
        if not len(rows):
            break
        todo[rows[:, None], at] = False
        source = np.where(going, ids[rows[:, None], at], -1)
        near = np.full((len(rows), expand, width), n, np.int64)
        for e in range(expand):
            have = np.flatnonzero(source[:, e] >= 0)
            to = graph[source[have, e]]
            to = np.where(to < 0, n, to)
            row = rows[have][:, None]
            near[have, e] = np.where(seen[row, to], n, to)
            seen[row, to] = True
        near = near.reshape(len(rows), expand * width)
        r, c = np.nonzero(near < n)
        met = near[r, c]
        d = np.full(near.shape, np.inf, np.float32)
        d[r, c] = norms[met] + own[rows[r]] - 2 * np.einsum("ij,ij->i", x[met], queries[rows[r]])
        all_d = np.concatenate([far[rows], d], axis=1)
        order = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        far[rows] = np.take_along_axis(all_d, order, 1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], near], axis=1), order, 1)
        todo[rows] = np.take_along_axis(np.concatenate([todo[rows], near < n], axis=1), order, 1)
    order = far.argsort(axis=1, kind="stable")
    far = np.take_along_axis(far, order, 1)
    return np.where(np.isinf(far), -1, np.take_along_axis(ids, order, 1)), far


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each point among its candidates (-1: none)."""
    fit = (candidates >= 0) & (candidates != points[:, None])
    order = np.sort(np.where(fit, candidates, -1), axis=1)
    order[:, 1:][order[:, 1:] == order[:, :-1]] = -1  # repeated candidates
    p = x[points]
    v = x[np.maximum(order, 0)]
    own = np.einsum("rci,rci->rc", v, v) + np.einsum("ij,ij->i", p, p)[:, None] - 2 * np.matmul(v, p[:, :, None])[:, :, 0]
    own = np.where(order >= 0, np.maximum(own, 0), np.inf)
    by = own.argsort(axis=1, kind="stable")  # nearest first
    order, own, v = np.take_along_axis(order, by, 1), np.take_along_axis(own, by, 1), np.take_along_axis(v, by[:, :, None], 1)
    lengths = np.einsum("rci,rci->rc", v, v)
    cross = lengths[:, :, None] + lengths[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    covered = alpha * alpha * cross <= own[:, None, :]  # by [row, kept one, candidate]
    kept = order >= 0
    many = np.zeros(len(points), np.int64)
    for j in range(order.shape[1]):
        kept[:, j] &= many < degree
        many += kept[:, j]
        kept[:, j + 1:] &= ~(covered[:, j, j + 1:] & kept[:, j, None])
    out = np.full((len(points), degree), -1, np.int64)
    r, c = np.nonzero(kept)
    out[r, (np.cumsum(kept, axis=1) - 1)[r, c]] = order[r, c]
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 1) -> tuple[np.ndarray, int]:
    """(neighbours per point, starting point) of the graph over the rows of ``x``."""
    n = len(x)
    graph = np.full((n, int(degree * SLACK)), -1, np.int64)
    if n == 0:
        return graph, 0
    start = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != start]
    done = 0
    while done < len(order):
        batch = order[done:done + max(1, min(BATCH, done + 1))]
        found, _ = beam_search(graph, x, x[batch], start, min(beam, max(done + 1, 1)))
        kept = robust_prune(x, batch, found, degree, alpha)
        graph[batch, :degree] = kept
        _link_back(graph, x, batch, kept, degree, alpha)
        done += len(batch)
    return graph, start


def _link_back(graph: np.ndarray, x: np.ndarray, batch: np.ndarray, kept: np.ndarray, degree: int, alpha: float) -> None:
    """Edges in the other direction; points with too many are pruned again."""
    to = kept.ravel()
    source = np.repeat(batch, kept.shape[1])[to >= 0]
    to = to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    points, first, counts = np.unique(to, return_index=True, return_counts=True)
    room = graph.shape[1]
    for lo in range(0, len(points), BATCH):
        hi = min(lo + BATCH, len(points))
        # Points by batches of similar gain; the widest row of a batch sets its size.
        width = int(counts[lo:hi].max())
        at = first[lo:hi, None] + np.arange(width)
        more = np.where(np.arange(width) < counts[lo:hi, None], source[np.minimum(at, len(source) - 1)], -1)
        both = np.concatenate([graph[points[lo:hi]], more], axis=1)
        used = (both >= 0).sum(axis=1)
        fits = used <= room
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
        new = packed[:, :room].copy()
        if not fits.all():
            new[~fits] = -1
            new[~fits, :degree] = robust_prune(x, points[lo:hi][~fits], packed[~fits][:, :used.max()], degree, alpha)
        graph[points[lo:hi]] = new


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rid", kind="stable")
    x = np.array(rows["embedding"].tolist(), dtype=np.float64)
    graph, start = build(lifted(x))
    ids, times = (np.concatenate(rows[c].tolist()).astype(np.int64).tobytes() for c in ("ids", "times"))
    sizes = np.array([len(i) for i in rows["ids"]], np.int64).tobytes()
    return pd.DataFrame({"dim": [x.shape[1]], "octave": [int(rows["octave"].iloc[0])], "shard": [int(rows["shard"].iloc[0])], "held": [int(rows["held"].iloc[0])], "ids": [ids], "times": [times], "sizes": [sizes],
                         "vectors": [x.tobytes()], "graph": [graph.astype(np.int32).tobytes()], "start": [start]})


def _padded(shard: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(ids, times each) of the rows of every point, smallest id first; times are 0 where there are fewer."""
    sizes = np.frombuffer(shard["sizes"], np.int64)
    there = np.arange(max(2, sizes.max())) < sizes[:, None]
    ids, times = np.full(there.shape, np.iinfo(np.int64).max), np.zeros(there.shape, np.int64)
    ids[there], times[there] = np.frombuffer(shard["ids"], np.int64), np.frombuffer(shard["times"], np.int64)
    return ids, times


NO_HIT = {"query_id": "int64", "vec_id": "int64", "score": "float64"}


def _search_shard(k: int, beam: int, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    if not len(index) or not len(queries):
        return pd.DataFrame({c: [] for c in NO_HIT}).astype(NO_HIT)
    shard = index.iloc[0]
    ids, times = _padded(shard)
    x = np.frombuffer(shard["vectors"], np.float64).reshape(len(ids), -1)
    graph = np.frombuffer(shard["graph"], np.int32).reshape(len(ids), -1)
    high = lifted(x)
    names = np.frombuffer(queries["names"].iloc[0], np.int64)
    q = np.frombuffer(queries["vectors"].iloc[0], np.float64).reshape(len(names), -1)
    out = []
    for lo in range(0, len(q), BATCH):
        own, part = names[lo:lo + BATCH, None], q[lo:lo + BATCH]
        ahead = part / np.abs(part).max(axis=1, keepdims=True)  # length does not change an order
        ahead /= np.sqrt((ahead ** 2).sum(axis=1, keepdims=True))
        asked = np.hstack([ahead, np.zeros((len(part), 1))]).astype(np.float32)
        found, _ = beam_search(graph, high, asked, int(shard["start"]), max(beam, k + 1))
        at = np.maximum(found, 0)
        with np.errstate(over="ignore", invalid="ignore"):
            score = np.einsum("qbd,qd->qb", x[at], part)
        # The best points by score and smallest id other than the query's own, then their rows.
        mine = ids[at, 0] == own
        there = (found >= 0) & ~(mine & (times[at, 1] == 0)) & ~np.isnan(score)
        best = np.lexsort((np.where(mine, ids[at, 1], ids[at, 0]), -np.where(there, score, -np.inf), ~there), axis=1)[:, :k]
        at, score, there = (np.take_along_axis(a, best, 1) for a in (at, score, there))
        row_ids, row_times = ids[at], np.where((ids[at] == own[:, :, None]) | ~there[:, :, None], 0, times[at])
        q_at, p_at, c_at = np.nonzero(row_times)
        row_ids, row_score, row_times = row_ids[q_at, p_at, c_at], score[q_at, p_at], np.minimum(row_times[q_at, p_at, c_at], k)
        by = np.lexsort((row_ids, -row_score, q_at))
        by = np.repeat(by, row_times[by])
        q_at, row_ids, row_score = q_at[by], row_ids[by], row_score[by]
        first = np.arange(len(by)) - np.searchsorted(q_at, q_at) < k
        out.append(pd.DataFrame({"query_id": own[q_at[first], 0], "vec_id": row_ids[first], "score": row_score[first]}))
    return pd.concat(out)


def _pack_queries(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("query_id", kind="stable")
    return pd.DataFrame({"dim": [int(rows["dim"].iloc[0])], "chunk": [int(rows["chunk"].iloc[0])], "names": [rows["query_id"].to_numpy(np.int64).tobytes()],
                         "vectors": [np.array(rows["embedding"].tolist(), np.float64).tobytes()]})


def octaves(embeddings: pd.Series) -> pd.Series:
    """The power of two below a vector's length, without squaring large or small numbers."""
    out = []
    for lo in range(0, len(embeddings), BATCH):
        part = embeddings.iloc[lo:lo + BATCH].tolist()
        sizes = np.array([len(v) for v in part])
        flat, starts = np.abs(np.concatenate(part)), np.cumsum(sizes) - sizes
        largest = np.maximum.reduceat(flat, starts)
        squares = np.add.reduceat((flat / np.repeat(largest, sizes)) ** 2, starts)
        out.append(np.floor(np.log2(largest) + np.log2(squares) / 2).astype(np.int32))
    return pd.Series(np.concatenate(out) if out else np.zeros(0, np.int32))


def points(vectors: DataFrame, k: int = K) -> DataFrame:
    """Distinct vectors (rid, embedding, dim) with the ids of their copies: the k + 1 smallest, so that k are left without a query's own."""
    fit = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = fit.groupBy("embedding", "vec_id").agg(F.count("*").alias("times"))
    # Spark limits each group before the exchange as well, so a large group of copies sends few rows.
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("_place", place).where(F.col("_place") <= k + 1)
    listed = few.groupBy("embedding").agg(F.array_sort(F.collect_list(F.struct(F.col("vec_id").cast("long").alias("id"), "times"))).alias("_rows"))
    return listed.select(F.col("_rows")[0]["id"].alias("rid"), F.col("_rows.id").alias("ids"), F.col("_rows.times").alias("times"), "embedding",
                         F.size("embedding").alias("dim"), F.pandas_udf(octaves, "int")("embedding").alias("octave"), F.lit(k).alias("held"))


def _dealt(rows: DataFrame, keys: list[str], by: str, into: str, size: int) -> DataFrame:
    """Rows with a part of their key's group, as many parts as its vectors fill ``size`` bytes; copies of one ``by`` meet."""
    counts = rows.groupBy(*keys).agg(F.ceil(F.sum(F.col("dim") * 8.0) / size).alias("_parts"))
    return rows.join(counts, keys).withColumn(into, F.pmod(F.xxhash64(by, F.lit(3)), F.col("_parts")).cast("int")).drop("_parts")


INDEX = "dim int, octave int, shard int, held int, ids binary, times binary, sizes binary, vectors binary, graph binary, start long"


def build_index(vectors: DataFrame, shard_bytes: int = SHARD_BYTES, k: int = K) -> DataFrame:
    """One row per shard with its distinct vectors and graph, for searches of up to ``k``, written to the shared folder.

    Vectors of one number of components and one octave of length are dealt to shards by hash.
    """
    fit = written(points(vectors, k), "points")
    # Points of one first id always meet in one shard; more than a shard's worth of one id is not expected of an id.
    dealt = _dealt(fit, ["dim", "octave"], "rid", "shard", shard_bytes)
    return written(dealt.groupBy("dim", "octave", "shard").applyInPandas(_build_shard, INDEX), "index")


def search(index: DataFrame, queries: DataFrame, k: int = K, beam: int = SEARCH_BEAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The ``k`` nearest vectors of every query row: (query_id, rank, vec_id, score), ties to the smaller id.

    A query never finds its own id.  Unusable vectors (null, zero, with null
    or non-finite components) take no part on either side; a product that
    overflows counts as infinite, and one that is no number is not found.
    Queries of another length than all vectors find nothing.  Repeated rows of
    a vector are each found; repeated rows of a query are one query.

    Every shard is searched for every query, so packed queries meet packed
    shards pairwise: the work grows with the number of queries times shards.
    """
    held = index.agg(F.min("held")).first()[0]
    if held is not None and k > held:
        raise ValueError(f"the index holds the copies for {held} neighbours, not {k}")
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("query_id").isNotNull() & usable(F.col("embedding"))).dropDuplicates(["query_id"]).withColumn("dim", F.size("embedding"))
    packed = written(_dealt(asked, ["dim"], "query_id", "chunk", shard_bytes).groupBy("dim", "chunk").applyInPandas(
        _pack_queries, "dim int, chunk int, names binary, vectors binary"), "queries")
    pairs = index.select("dim", "octave", "shard").join(packed.select("dim", "chunk"), "dim")
    key = ["dim", "octave", "shard", "chunk"]
    left = index.join(pairs, ["dim", "octave", "shard"])
    right = packed.join(pairs, ["dim", "chunk"]).withColumnsRenamed({c: f"of_{c}" for c in key})
    found = left.groupBy(*key).cogroup(right.groupBy(*[f"of_{c}" for c in key])).applyInPandas(
        partial(_search_shard, k, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    return search(build_index(vectors, k=k), queries, k)
