"""Bronze, silver and gold steps; each takes and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.functions.scalar import as_of_date, count_where, percent
from tickwell.operators.filters import completeness_flag, dated_since, safe_double


def bronze_checks(bronze: DataFrame) -> DataFrame:
    """Rows, files, date range and undated rows in one pass."""
    return bronze.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("source_file").alias("unique_files"),
        F.min("data_date").alias("min_date"),
        F.max("data_date").alias("max_date"),
        count_where(F.col("data_date").isNull()).alias("null_dates"),
    )


def to_silver(bronze: DataFrame, price: str = "price", yield_value: str = "yield_value",
              floor: str = "2020-01-01") -> DataFrame:
    """Typed prices and yields with a completeness flag taken from the raw values."""
    keep = [c for c in ("source_file", "ingestion_timestamp") if c in bronze.columns]
    return dated_since(bronze, floor).select(
        F.col("data_date").cast("date").alias("trade_date"),
        *keep,
        safe_double(price).alias("price"),
        safe_double(yield_value).alias("yield_value"),
        completeness_flag(price, yield_value).alias("data_quality_flag"),
    )


def silver_checks(silver: DataFrame) -> DataFrame:
    flag = F.col("data_quality_flag")
    return silver.agg(
        F.count("*").alias("total_records"),
        count_where(flag == "VALID").alias("valid_records"),
        count_where(flag == "INCOMPLETE").alias("incomplete_records"),
        count_where(flag == "INVALID").alias("invalid_records"),
        F.min("trade_date").alias("min_date"),
        F.max("trade_date").alias("max_date"),
    )


def flag_distribution(df: DataFrame, flag: str = "data_quality_flag") -> DataFrame:
    """Rows and share per flag; the window runs over one row per flag value."""
    counts = df.groupBy(flag).agg(F.count("*").alias("record_count"))
    total = F.sum("record_count").over(Window.partitionBy())
    return counts.withColumn("percentage", percent("record_count", total))


def daily_metrics(silver: DataFrame) -> DataFrame:
    flag = F.col("data_quality_flag")
    valid = count_where(flag == "VALID")
    return (
        silver.where(flag.isin("VALID", "INCOMPLETE")).groupBy("trade_date").agg(
            F.count("*").alias("total_trades"),
            F.avg("price").alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.stddev("price").alias("price_volatility"),
            F.avg("yield_value").alias("avg_yield"),
            F.min("yield_value").alias("min_yield"),
            F.max("yield_value").alias("max_yield"),
            F.stddev("yield_value").alias("yield_volatility"),
            valid.alias("valid_trades"),
            count_where(flag == "INCOMPLETE").alias("incomplete_trades"),
            percent(valid, F.count("*")).alias("data_quality_pct"),
        )
    )


def monthly_summary(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.trunc("trade_date", "MM").alias("trade_month")).agg(
        F.sum("total_trades").alias("monthly_total_trades"),
        F.avg("avg_price").alias("monthly_avg_price"),
        F.avg("avg_yield").alias("monthly_avg_yield"),
        F.avg("data_quality_pct").alias("monthly_avg_quality_pct"),
        F.count("*").alias("trading_days_in_month"),
    )


def quality_dashboard(daily: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    return daily.where(F.col("trade_date") >= F.date_sub(as_of_date(as_of), days)).agg(
        F.lit(f"Last {days} Days").alias("period"),
        F.count("*").alias("trading_days"),
        F.sum("total_trades").alias("total_trades"),
        F.sum("valid_trades").alias("valid_trades"),
        F.sum("incomplete_trades").alias("incomplete_trades"),
        F.avg("data_quality_pct").alias("avg_quality_pct"),
        F.min("trade_date").alias("period_start"),
        F.max("trade_date").alias("period_end"),
    )


def layer_counts(layers: dict[str, DataFrame | None], spark) -> DataFrame:
    """Row count per layer object; a missing one gives NULL."""
    parts = []
    for name, df in layers.items():
        if df is None:
            one = spark.range(1).select(F.lit(name).alias("layer"), F.lit(None).cast("bigint").alias("record_count"))
        else:
            one = df.agg(F.count("*").alias("record_count")).select(F.lit(name).alias("layer"), "record_count")
        parts.append(one)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
