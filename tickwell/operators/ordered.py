"""Order-dependent work on raw ticks when one key may hold most of the rows.

A window partitioned by symbol sorts a whole symbol in one task.  That is fine
for bars, whose number is bounded by the calendar, but not for ticks: one
symbol can be a third of the lake.  The helpers here check the largest group
first.  Small groups use the plain window.  Otherwise the rows are written
once, range-partitioned by (keys, order), so that every file is a bounded,
contiguous slice of the order; a small per-slice summary then carries what a
row needs to know about earlier slices.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.functions.scalar import null_safe_join
from tickwell.session import scratch_path

MAX_GROUP_ROWS = 5_000_000
SLICE_ROWS = 2_000_000
SLICE = "_slice"


def group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the biggest key and of all keys; reads only the key columns."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    row = counts.agg(F.max("n"), F.sum("n")).first()
    return row[0] or 0, row[1] or 0


def slices(df: DataFrame, keys: list[str], order: list[str], total: int, rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` with a slice number that rises with (keys, order).

    The slice comes from the file name of a written table, so it stays the
    same when a task is retried or an executor is lost.
    """
    spark = df.sparkSession
    parts = max(1, math.ceil(total / rows))
    path = scratch_path(spark, "slices")
    df.repartitionByRange(parts, *keys, *order).write.parquet(path)
    name = F.col("_metadata.file_name")
    number = (
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("bigint") * 100_000
        + F.regexp_extract(name, r"c(\d+)\.", 1).cast("bigint")
    )
    return spark.read.parquet(path).withColumn(SLICE, number)


def lookback_window(df: DataFrame, keys: list[str], order: list[str], lookback: int,
                    add: Callable[[DataFrame, list[str]], DataFrame],
                    max_group_rows: int = MAX_GROUP_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Apply ``add(df, partition_columns)``, whose frames reach back ``lookback`` rows.

    For large groups, rows get their exact position in the key, positions are
    cut into blocks, and the last ``lookback`` rows of a block are copied to
    the next one.  Every window partition then has a fixed size.
    """
    largest, total = group_sizes(df, keys)
    if largest <= max_group_rows:
        return add(df, keys)
    sliced = slices(df, keys, order, total, slice_rows)
    sizes = sliced.groupBy(*keys, SLICE).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, SLICE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    in_slice = Window.partitionBy(*keys, SLICE).orderBy(*order)
    placed = null_safe_join(sliced, starts, [*keys, SLICE], "inner").withColumn(
        "_at", F.col("_start") + F.row_number().over(in_slice) - 1
    )
    size = max(slice_rows, 4 * lookback, 1)
    block = F.floor(F.col("_at") / size).cast("bigint")
    copied = F.col("_at") % size >= size - lookback
    blocks = F.array_compact(F.array(block, F.when(copied, block + 1)))
    spread = placed.withColumn("_home", block).withColumn("_block", F.explode(blocks))
    helper = [SLICE, "_start", "_at", "_home", "_block"]
    return add(spread, [*keys, "_block"]).where(F.col("_home") == F.col("_block")).drop(*helper)


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], ts: str, payload: list[str],
              left_tie: str, right_tie: str, prefix: str = "quote_",
              max_group_rows: int = MAX_GROUP_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Each left row with the newest right row at or before its time.

    Right rows sort before left rows of the same time.  Unmatched left rows
    keep nulls; a null key matches nothing, as in any join.
    """
    tagged = left.select("*", F.lit(1).alias("_side"), F.col(left_tie).alias("_tie"))
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    found = F.when(named, F.struct(F.col(ts), *[F.col(c) for c in payload]))
    lookup = right.select(
        *keys, ts, F.lit(0).alias("_side"), F.col(right_tie).alias("_tie"), found.alias("_found")
    )
    both = tagged.unionByName(lookup, allowMissingColumns=True)
    order = [ts, "_side", "_tie"]
    largest, total = group_sizes(both, keys)
    if largest <= max_group_rows:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        matched = both.withColumn("_match", F.last("_found", ignorenulls=True).over(w))
    else:
        sliced = slices(both, keys, order, total, slice_rows)
        newest = F.max_by("_found", F.when((F.col("_side") == 0) & F.col("_found").isNotNull(), F.struct(ts, "_tie")))
        tails = sliced.groupBy(*keys, SLICE).agg(newest.alias("_tail"))
        earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carried = tails.select(*keys, SLICE, F.last("_tail", ignorenulls=True).over(earlier).alias("_carry"))
        w = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        matched = null_safe_join(sliced, carried, [*keys, SLICE], "inner").withColumn(
            "_match", F.coalesce(F.last("_found", ignorenulls=True).over(w), F.col("_carry"))
        )
    return matched.where(F.col("_side") == 1).select(
        *left.columns,
        F.col("_match")[ts].alias(f"{prefix}{ts}"),
        *[F.col("_match")[c].alias(f"{prefix}{c}") for c in payload],
    )
