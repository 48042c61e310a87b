"""Outlier removal and volume anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.functions.scalar import percent, ratio
from tickwell.operators.quantiles import quantiles_of


def _keep(df: DataFrame, outlier: list[Column]) -> DataFrame:
    """Rows that break no rule; an undecided (null) rule does not remove a row."""
    for cond in outlier:
        df = df.where(~F.coalesce(cond, F.lit(False)))
    return df


def remove_outliers_iqr(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Rows inside the quartile fences of every known column."""
    known = [c for c in columns if c in df.columns]
    rules = []
    for c, (q1, q3) in quantiles_of(df, known, [0.25, 0.75]).items() if known else ():
        if q1 is None:
            continue
        reach = k * (q3 - q1)
        rules.append((F.col(c) < q1 - reach) | (F.col(c) > q3 + reach))
    return _keep(df, rules)


def remove_outliers_zscore(df: DataFrame, columns: list[str], threshold: float = 3.0) -> DataFrame:
    """Rows whose z-score stays within the threshold in every known column."""
    known = [c for c in columns if c in df.columns]
    if not known:
        return df
    stats = df.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev(c).alias("std")).alias(c) for c in known
    ])
    rules = []
    for c in known:
        one = stats.select(c).scalar()
        rules.append(F.abs(F.try_divide(F.col(c) - one["mean"], one["std"])) > threshold)
    return _keep(df, rules)


def detect_outliers(df: DataFrame, columns: list[str], method: str = "iqr") -> DataFrame:
    if method == "iqr":
        return remove_outliers_iqr(df, columns)
    if method == "zscore":
        return remove_outliers_zscore(df, columns)
    raise ValueError(f"method must be 'iqr' or 'zscore', not {method!r}")


def volume_anomalies(ticks: DataFrame, exchange: str | None = None, day: str | None = None,
                     threshold: float = 3.0) -> DataFrame:
    """Symbols whose volume is far from the day's mean, ranked by distance.

    Mean and deviation come from an aggregate per (exchange, day) joined back,
    so the full symbol list is never gathered in one window task.
    """
    df = ticks
    if exchange:
        df = df.where(F.col("exchange") == exchange)
    if day:
        df = df.where(F.col("data_date") == F.lit(day).cast("date"))
    per_symbol = df.groupBy("exchange", "data_date", "symbol").agg(
        F.sum("volume").alias("total_volume"),
        F.count("*").alias("trade_count"),
        F.stddev("price").alias("price_volatility"),
    )
    base = per_symbol.groupBy("exchange", "data_date").agg(
        F.avg("total_volume").alias("mean_volume"), F.stddev("total_volume").alias("std_volume")
    )
    scored = per_symbol.join(base, ["exchange", "data_date"]).withColumn(
        "z_score", ratio(F.col("total_volume") - F.col("mean_volume"), "std_volume")
    )
    outside = scored.where(F.abs("z_score") >= threshold)
    by_distance = Window.partitionBy("exchange", "data_date").orderBy(F.abs("z_score").desc(), F.col("symbol"))
    return outside.withColumn("anomaly_rank", F.row_number().over(by_distance))


def volume_trend(ticks: DataFrame, start: str, end: str, exchange: str | None = None,
                 symbols: list[str] | None = None) -> DataFrame:
    """Daily volume per symbol, change to its previous day, rank in the day."""
    df = ticks.where(F.col("data_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if exchange:
        df = df.where(F.col("exchange") == exchange)
    if symbols:
        df = df.where(F.col("symbol").isin(symbols))
    daily = df.groupBy("exchange", "symbol", "data_date").agg(
        F.sum("volume").alias("total_volume"), F.count("*").alias("trade_count")
    )
    series = Window.partitionBy("exchange", "symbol").orderBy("data_date")
    in_day = Window.partitionBy("exchange", "data_date").orderBy(F.col("total_volume").desc_nulls_last())
    before = F.lag("total_volume").over(series)
    return daily.select(
        "*",
        (F.col("total_volume") - before).alias("volume_change"),
        percent(F.col("total_volume") - before, before).alias("volume_change_pct"),
        F.rank().over(in_day).alias("day_rank"),
    )
