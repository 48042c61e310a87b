"""Column profiles in long form: one row per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell.functions.scalar import count_where, percent, ratio
from tickwell.operators.sets import duplicate_count


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _long(df: DataFrame, columns: list[str], metrics: dict, shared: dict | None = None) -> DataFrame:
    """One aggregate over ``df`` turned into a row per column."""
    shared = shared or {}
    wide = df.agg(*[
        *[expr.alias(f"_{name}") for name, expr in shared.items()],
        *[fn(c).alias(f"m{i}_{name}") for i, c in enumerate(columns) for name, fn in metrics.items()],
    ])
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(f"_{name}").alias(name) for name in shared],
            *[F.col(f"m{i}_{name}").alias(name) for name in metrics],
        )
        for i, c in enumerate(columns)
    ])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def null_profile(df: DataFrame, all_columns: bool = False) -> DataFrame:
    """Null count and percent per column that has nulls, with the overall total."""
    long = _long(
        df, df.columns, {"null_count": lambda c: count_where(_c(c).isNull())},
        {"row_count": F.count("*")},
    )
    out = long.select(
        "column_name", "null_count", percent("null_count", "row_count").alias("null_pct"),
        F.sum("null_count").over(Window.partitionBy()).alias("total_nulls"),
    )
    return out if all_columns else out.where(F.col("null_count") > 0)


def duplicate_profile(df: DataFrame) -> DataFrame:
    return duplicate_count(df).select(
        F.col("duplicate_count").alias("total_duplicates"),
        percent("duplicate_count", "total_rows").alias("duplicate_percentage"),
        "unique_rows",
    )


def digest(c: Column) -> Column:
    """32 bytes that stand for a text, so counting distinct texts does not shuffle them."""
    return F.unhex(F.sha2(c, 256))


def _distinct(df: DataFrame, approximate: bool = False):
    count = F.approx_count_distinct if approximate else F.count_distinct
    texts = set(string_columns(df))
    return lambda c: count(digest(_c(c)) if c in texts else _c(c))


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    return _long(df, df.columns, {"unique_values": _distinct(df, approximate)})


def type_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, non-null and distinct count per column; ``approximate`` opts into sketches."""
    long = _long(df, df.columns, {
        "non_null_count": lambda c: F.count(_c(c)), "unique_values": _distinct(df, approximate)})
    kinds = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    return long.withColumn("data_type", kinds[F.col("column_name")])


def type_summary(df: DataFrame) -> DataFrame:
    """Columns and filled cells per data type."""
    kinds = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    filled = _long(df, df.columns, {"non_null_count": lambda c: F.count(_c(c))})
    return filled.groupBy(kinds[F.col("column_name")].alias("data_type")).agg(
        F.count("*").alias("column_count"), F.sum("non_null_count").alias("non_null_count")
    )


NUMERIC_METRICS = {
    "min_value": lambda c: F.min(_c(c).cast("double")),
    "max_value": lambda c: F.max(_c(c).cast("double")),
    "mean_value": lambda c: F.avg(_c(c).cast("double")),
    "std_value": lambda c: F.stddev(_c(c).cast("double")),
    "negative_values": lambda c: count_where(_c(c) < 0),
    "zero_values": lambda c: count_where(_c(c) == 0),
}


def numeric_profile(df: DataFrame) -> DataFrame:
    return _long(df, numeric_columns(df), NUMERIC_METRICS)


def string_stats(df: DataFrame) -> DataFrame:
    """Distinct values, lengths and empties per text column.

    Equal texts are combined before the shuffle, which carries digests and
    lengths but no text.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), digest(_c(c)).alias("key"), F.length(_c(c)).alias("size"))
        for c in string_columns(df)
    ])).alias("p")
    values = (
        df.select(cells).select("p.*").where(F.col("key").isNotNull())
        .groupBy("column_name", "key", "size").agg(F.count("*").alias("n"))
    )
    return values.groupBy("column_name").agg(
        F.count("*").alias("unique_values"),
        ratio(F.sum(F.col("size") * F.col("n")), F.sum("n")).alias("avg_length"),
        F.max("size").alias("max_length"),
        F.coalesce(F.sum(F.when(F.col("size") == 0, F.col("n"))), F.lit(0)).alias("empty_strings"),
    )


def smallest_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """The ``k`` smallest distinct texts per column as a sorted array.

    Every task keeps ``k`` texts per column, so only those are shuffled.
    """
    def keep(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        best: dict[str, list[str]] = {c: [] for c in columns}
        for batch in batches:
            for i, c in enumerate(columns):
                found = pc.unique(batch.column(i).drop_null())
                if len(found):
                    low = found.take(pc.bottom_k_unstable(found, k=min(k, len(found)))).to_pylist()
                    best[c] = sorted({*best[c], *low})[:k]
        rows = [(c, v) for c, values in best.items() for v in values]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in rows], pa.string()), pa.array([v for _, v in rows], pa.string())], ["column_name", "value"])

    candidates = df.select(*[_c(c) for c in columns]).mapInArrow(keep, "column_name string, value string").distinct()
    first = Window.partitionBy("column_name").orderBy("value")
    return (
        candidates.withColumn("pos", F.row_number().over(first)).where(F.col("pos") <= k)
        .groupBy("column_name").agg(F.sort_array(F.collect_list("value")).alias("sample_values"))
    )


def string_profile(df: DataFrame, samples: int = 5) -> DataFrame:
    """Text statistics per column with its smallest values as samples."""
    return string_stats(df).join(smallest_values(df, string_columns(df), samples), "column_name", "left")


def quality_report(df: DataFrame, size_bytes: int | None = None) -> DataFrame:
    """All checks as (check_name, column_name, metric, value) rows.

    Four reads of ``df``: duplicates, all simple metrics, distinct counts and
    text statistics; the last three shuffle no text.

    ``size_bytes`` is the size of the files behind ``df`` (see
    ``sources.files.total_size``); without it the size row is NULL.
    """
    def unpivot(frame: DataFrame, check: str, metrics: list[str]) -> DataFrame:
        column = F.col("column_name") if "column_name" in frame.columns else F.lit(None).cast("string")
        cells = F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
        ])).alias("m")
        return frame.select(F.lit(check).alias("check_name"), column.alias("column_name"), cells).select(
            "check_name", "column_name", "m.*")

    size_mb = F.lit(None if size_bytes is None else size_bytes / 1024 / 1024).cast("double")
    table = duplicate_count(df).select(
        F.col("total_rows"), F.lit(len(df.columns)).alias("total_columns"), size_mb.alias("size_mb"),
        F.col("duplicate_count").alias("total_duplicates"), "unique_rows",
    )
    cells = []
    for c in df.columns:
        nulls = count_where(_c(c).isNull())
        cells += [("null_values", c, "null_count", nulls), ("null_values", c, "null_pct", percent(nulls, F.count("*"))),
                  ("data_types", c, "non_null_count", F.count(_c(c)))]
    for c in numeric_columns(df):
        cells += [("numeric_ranges", c, name, fn(c)) for name, fn in NUMERIC_METRICS.items()]
    wide = df.agg(*[expr.cast("double").alias(f"x{i}") for i, (*_, expr) in enumerate(cells)])
    simple = wide.select(F.explode(F.array(*[
        F.struct(F.lit(check).alias("check_name"), F.lit(c).alias("column_name"), F.lit(metric).alias("metric"), F.col(f"x{i}").alias("value"))
        for i, (check, c, metric, _) in enumerate(cells)
    ])).alias("r")).select("r.*")
    parts = [
        unpivot(table, "table", ["total_rows", "total_columns", "size_mb", "total_duplicates", "unique_rows"]),
        simple,
        unpivot(distinct_counts(df), "data_types", ["unique_values"]),
    ]
    if string_columns(df):
        parts.append(unpivot(string_stats(df), "string_patterns", [
            "unique_values", "avg_length", "max_length", "empty_strings"]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
