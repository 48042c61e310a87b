"""Mergeable summaries of columns: small tables by partition that answer for any set of partitions.

A summary row holds sketches of one partition.  Questions over months merge
these rows and read no ticks; a new or reloaded partition replaces its row.
The answers are estimates; the exact operators are in ``profiling`` and
``quantiles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_BITS = 14  # relative standard error about 0.8 %
KLL_K = 400  # rank error of a quantile below 1 %


def distinct_sketches(df: DataFrame, keys: list[str], columns: list[str], bits: int = HLL_BITS) -> DataFrame:
    """Rows, non-null cells and a sketch of distinct values per key and column; a third of the rows in one key combine on the map side."""
    wide = df.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        *[x for i, c in enumerate(columns) for x in (
            F.count(f"`{c}`").alias(f"_n{i}"), F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), F.lit(bits)).alias(f"_s{i}"))])
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("non_null_count"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)]))
    return wide.select(*keys, "row_count", cells.alias("c")).select(*keys, "row_count", "c.*")


def merged_distinct(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, non-null cells and the estimated number of distinct values per key, over all summary rows of it."""
    return sketches.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.sum("non_null_count").alias("non_null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_values"))


def quantile_sketches(df: DataFrame, keys: list[str], columns: list[str], k: int = KLL_K) -> DataFrame:
    """Non-null cells, extremes and a sketch of the distribution per key and numeric column."""
    wide = df.groupBy(*keys).agg(*[x for i, c in enumerate(columns) for x in (
        F.count(f"`{c}`").alias(f"_n{i}"), F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), F.lit(k)).alias(f"_s{i}"))])
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("non_null_count"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)]))
    return wide.select(*keys, cells.alias("c")).select(*keys, "c.*")


def _merge_all(sketches: Column) -> Column:
    return F.aggregate(sketches, F.lit(None).cast("binary"), lambda done, s: F.when(done.isNull(), s).otherwise(F.kll_sketch_merge_double(done, s)))


def merged_quantiles(sketches: DataFrame, keys: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Estimated quantiles per key, named by ``probabilities``; summary rows without values do not count.

    Sketches of a key are merged a few hundred at a time, so years of
    partitions do not meet in one row.
    """
    filled = sketches.where("non_null_count > 0")
    spread = F.pmod(F.xxhash64(*[c for c in sketches.columns if c != "sketch"]), F.lit(64))
    some = filled.groupBy(*keys, spread.alias("_part")).agg(
        F.sum("non_null_count").alias("non_null_count"), _merge_all(F.collect_list("sketch")).alias("sketch"))
    whole = some.groupBy(*keys).agg(F.sum("non_null_count").alias("non_null_count"), _merge_all(F.collect_list("sketch")).alias("sketch"))
    return whole.select(*keys, "non_null_count", *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(n) for n, p in probabilities.items()])
