"""Exact pairs of close vectors by dual traversal of cover trees.

Vectors are compared only inside their label.  A sample of pivots cuts a large
label into cells; a vector lives in the cell of its nearest pivot and visits
every cell that its ball of the threshold radius can reach, so both ends of
every link meet in each other's cell.  Cells too large for a task are cut into
blocks and compared block by block.  A task builds one cover tree per side and
walks both together: a pair of nodes farther apart than their radii and the
threshold is dropped, a pair that lies wholly within the threshold is counted
without looking inside.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell.llm.components import Forest, components
from tickwell.llm.frames import written

COSINE = 0.98
BLOCK = 2_048  # vectors of one side of a task
PIVOTS = 8_192  # pivots sent to all executors, at most about; cells grow beyond
LEAF = 128
DIRECT = 1 << 20  # pairs of two nodes that are compared at once
CENTERS = 64  # possible centers whose distances are taken together
ROUTED = 1 << 22  # products with pivots that are held at a time
WALK = 256  # pairs that are compared in the time of one step of the walk
SLACK = 1e-9  # distances this close to a bound are compared exactly
ROUNDING = 1e-12  # products of unit vectors differ by less in their last bits


class CoverTree:
    """Nested levels of halving radii over unit vectors; node i covers ``members[i]`` within ``radius[i]``."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.center: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.members: list[np.ndarray] = []
        if len(x):
            everything = np.arange(len(x))
            self._add(0, everything, self._distances(0, everything))

    def _distances(self, center: int, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.x[points] @ self.x[center])))

    def _add(self, center: int, points: np.ndarray, distance: np.ndarray) -> int:
        number = len(self.center)
        radius = float(distance.max())
        self.center.append(center)
        self.radius.append(radius)
        self.members.append(points)
        self.children.append(None)
        if len(points) > LEAF and radius > 1e-7:
            reach = 2.0 ** (math.ceil(math.log2(radius)) - 1)
            children = []
            near = distance <= reach
            children.append((center, points[near], distance[near]))
            points = points[~near]
            while len(points):  # the first point left is the next center, many of them from one product
                some = points[:CENTERS]
                apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.x[some] @ self.x[points].T)))
                left = np.ones(len(points), bool)
                for k in range(len(some)):
                    if left[k]:
                        near = np.flatnonzero(left & (apart[k] <= reach))
                        near = near if k in near else np.r_[k, near]  # rounding must not leave a center out
                        children.append((int(some[k]), points[near], apart[k, near]))
                        left[near] = False
                points = points[left]
            self.children[number] = np.array([self._add(*child) for child in children])
        return number


def close_pairs(x: CoverTree, y: CoverTree, cosine: float, whole, single) -> None:
    """Walk both trees; ``whole(xs, ys)`` gets index sets that link completely, ``single(xs, ys)`` linked pairs."""
    if not x.center or not y.center:
        return
    reach = math.sqrt(2.0 - 2.0 * cosine)
    cx, cy = x.x[x.center], y.x[y.center]
    rx, ry = np.array(x.radius), np.array(y.radius)

    def compare(xs, ys):
        step = max(1, DIRECT // len(ys))
        for lo in range(0, len(xs), step):
            some = xs[lo:lo + step]
            dots = x.x[some] @ y.x[ys].T
            i, j = np.nonzero(dots >= cosine - SLACK)
            sure = dots[i, j] >= cosine + SLACK
            for k in np.flatnonzero(~sure):
                sure[k] = exact_cosine(x.x[some[i[k]]], y.x[ys[j[k]]]) >= cosine
            if sure.any():
                single(some[i[sure]], ys[j[sure]])

    stack = [(0, 0)]
    while stack:
        a, b = stack.pop()
        down_a, down_b = x.children[a], y.children[b]
        pairs = len(x.members[a]) * len(y.members[b])
        if (down_a is None and down_b is None) or pairs <= DIRECT:
            compare(x.members[a], y.members[b])
            continue
        na = down_a if down_a is not None else np.array([a])
        nb = down_b if down_b is not None else np.array([b])
        apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (cx[na] @ cy[nb].T)))
        both = rx[na][:, None] + ry[nb][None, :]
        inside = apart + both <= reach - SLACK
        near = ~inside & (apart - both <= reach + 1e-7)
        if (inside.sum() + near.sum()) * WALK >= pairs:  # the children are so many that they are hardly smaller sets
            compare(x.members[a], y.members[b])
            continue
        for i, j in zip(*np.nonzero(inside), strict=True):
            whole(x.members[na[i]], y.members[nb[j]])
        for i, j in zip(*np.nonzero(near), strict=True):
            stack.append((int(na[i]), int(nb[j])))


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    if not len(x):
        return x.reshape(0, 1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def cells_of(x: np.ndarray, centers: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, whether it is the row's own) for unit vectors ``x`` and unit pivots."""
    reach = math.sqrt(2.0 - 2.0 * cosine) + 1e-7
    dots = x @ centers.T
    nearest = dots.argmax(axis=1)
    gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (centers[nearest] @ centers.T)))
    # Distance to the plane between two pivots; a link can cross it only from within its reach.
    toward = (dots[np.arange(len(x)), nearest][:, None] - dots) <= reach * gap + ROUNDING
    row, cell = np.nonzero(toward)
    return row, cell, cell == nearest[row]


def _route(pivots: dict, cosine: float, batches):
    """Rows of (label, cell) that each vector lives in or visits, a slice of the vectors at a time."""
    columns = ["label", "dim", "cell", "home", "rid", "copies", "embedding"]
    for batch in batches:
        for (label, dim), rows in batch.groupby(["label", "dim"]):
            centers = pivots.get((label, dim))
            if centers is None:
                yield rows.assign(cell=0, home=True)[columns]
                continue
            step = max(1, ROUTED // len(centers))
            for lo in range(0, len(rows), step):
                some = rows.iloc[lo:lo + step]
                row, cell, home = cells_of(unit(some["embedding"]), centers, cosine)
                yield some.iloc[row].assign(cell=cell, home=home)[columns]


def _compare(cosine: float, rows: pd.DataFrame) -> pd.DataFrame:
    """Link counts of the home side (``n_links`` above 0), and stars of linked vectors (``n_links`` 0)."""
    left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
    x_ids, y_ids, copies = left["rid"].to_numpy(), right["rid"].to_numpy(), right["copies"].to_numpy()
    links = np.zeros(len(left), np.int64)
    forest = Forest()
    ids, at_ids = np.unique(np.concatenate([x_ids, y_ids]), return_inverse=True)
    part = np.arange(len(ids))  # per id one that it is known to be joined with
    x_at, y_at = at_ids[:len(x_ids)], at_ids[len(x_ids):]

    def whole(xs, ys):
        own = np.isin(x_ids[xs], y_ids[ys])
        links[xs] += copies[ys].sum()
        if own.any():
            at = dict(zip(y_ids[ys].tolist(), copies[ys].tolist(), strict=True))
            for i in xs[own]:
                links[i] -= at[x_ids[i]]
        for other in (*x_ids[xs], *y_ids[ys]):
            forest.union(int(x_ids[xs[0]]), int(other))

    def single(xs, ys):
        other = x_ids[xs] != y_ids[ys]
        xs, ys = xs[other], ys[other]
        np.add.at(links, xs, copies[ys])
        # Of many links between the same two known parts one is enough.
        a, b = x_at[xs], y_at[ys]
        new = part[a] != part[b]
        for key in np.unique(part[a[new]] * len(ids) + part[b[new]]).tolist():
            forest.union(int(ids[key // len(ids)]), int(ids[key % len(ids)]))
        if new.any():
            touched = np.unique(np.concatenate([a, b]))
            part[touched] = np.searchsorted(ids, [forest.find(i) for i in ids[touched].tolist()])

    close_pairs(CoverTree(unit(left["embedding"])), CoverTree(unit(right["embedding"])), cosine, whole, single)
    counted = pd.DataFrame({"a": x_ids, "b": x_ids, "n_links": links})
    stars = pd.DataFrame(forest.stars(), columns=["a", "b"]).assign(n_links=0)
    return pd.concat([counted[counted["n_links"] > 0], stars])


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept).

    Equal vectors of a label are one representative with a number of copies,
    which link with each other.  Null labels and unusable vectors link with
    nothing, vectors of different length neither.  Rows that repeat an id are
    vectors of their own.  An empty table gives an empty result.
    """
    # Single precision stays as it is in the exchanges, at half the bytes; tasks compute in double.
    kind = "array<float>" if vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType()) else "array<double>"
    plain = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast(kind).alias("embedding"))
    fit = plain.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    reps = written(fit.groupBy("label", "embedding").agg(F.min("vec_id").alias("rid"), F.count("*").alias("copies"))
                   .withColumn("dim", F.size("embedding")), "vectors")
    every = max(block, math.ceil(reps.count() / pivots))
    chosen = reps.where(F.pmod(F.xxhash64("rid"), F.lit(every)) == 0).limit(2 * pivots).select("label", "dim", "embedding")
    table = {key: unit(rows["embedding"]) for key, rows in chosen.toPandas().groupby(["label", "dim"]) if len(rows) > 1}
    routed = written(reps.mapInPandas(partial(_route, table, cosine),
                     f"label string, dim int, cell int, home boolean, rid long, copies long, embedding {kind}"), "cells")
    cell = ["label", "dim", "cell"]
    sizes = routed.groupBy(*cell).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rid", F.lit(5)), F.col("blocks")).cast("int")
    placed = routed.join(sizes, cell).withColumn("own", own)
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = placed.where("home").withColumn("other", every_block).select(*cell, F.col("own").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"), "rid", "copies", "embedding")
    right = placed.withColumn("other", every_block).select(*cell, F.col("other").alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "rid", "copies", "embedding")
    found = written(left.unionByName(right).groupBy(*cell, "i", "j").applyInPandas(partial(_compare, cosine), "a long, b long, n_links long"), "links")
    counts = found.where("n_links > 0").groupBy(F.col("a").alias("rid")).agg(F.sum("n_links").alias("others"))
    joined = components(found.where("n_links = 0").select("a", "b"))
    classes = (
        reps.select("label", "embedding", "rid", "copies").join(counts, "rid", "left")
        .join(joined.select(F.col("node").alias("rid"), "component"), "rid", "left")
        .select("label", "embedding", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rid").alias("component_id"))
    )
    out = fit.select("vec_id", "label", "embedding").join(classes, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = plain.where(~(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable(F.col("embedding")))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
