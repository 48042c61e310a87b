"""Connected components of an edge table, by stars that shrink."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.frames import written
from tickwell.session import clear_scratch, scratch_mark, scratch_path


class Forest:
    """Union-find over numbers; the smallest member is the root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def stars(self) -> list[tuple[int, int]]:
        """(member, root) of every member that is not its own root."""
        return [(x, root) for x in list(self.parent) if (root := self.find(x)) != x]


def _contract(batches):
    """Edges of one partition as stars around its local roots."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            forest.union(a, b)
    yield pd.DataFrame(forest.stars(), columns=["a", "b"])


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


BROADCAST = 1_000_000  # edges up to which a node's smallest neighbour is sent to all executors, two numbers a row, 32 MB at most


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable, for every node that an edge (a, b) names.

    Edges are contracted inside each partition first.  Then large stars and
    small stars alternate until nothing moves: every node points to the
    smallest neighbour it knows.  Each round is written to the shared folder.
    Loops and repeated edges do no harm; no edges give no rows.
    """
    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if mark[0] <= BROADCAST else df

    local = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInPandas(_contract, "a long, b long")
    current = written(local, "edges")  # every a > b
    mark = _fingerprint(current)
    spark, made = edges.sparkSession, scratch_mark(edges.sparkSession)
    while mark[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(side(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(side(lowest), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = hung.unionByName(lowest.select("a", F.col("m").alias("b")))
        path = scratch_path(spark, "edges")
        small.where("a <> b").distinct().write.parquet(path)
        current = spark.read.schema("a long, b long").parquet(path)
        clear_scratch(spark, made, keep=(path,))  # the rounds before
        before, mark = mark, _fingerprint(current)
        if before == mark:
            break
    return current.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
