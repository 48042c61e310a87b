"""Unions, dedupe, total orders and the unified silver table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.operators.filters import last_days, with_spread
from tickwell.operators.quality import with_row_quality


def union_exchanges(parts: dict[str, DataFrame]) -> DataFrame:
    """Stack one frame per exchange and name the exchange in a column."""
    tagged = [df.withColumn("exchange", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


# Target of the unified silver table: name -> type.
UNIFIED = {
    "trade_id": "string", "exchange": "string", "symbol": "string", "exchange_time": "timestamp_ntz",
    "price": "double", "quantity": "bigint", "side": "string", "bid_price": "double", "ask_price": "double",
    "bid_size": "bigint", "ask_size": "bigint", "spread": "double", "settlement_price": "double",
    "open_interest": "bigint", "volume": "bigint", "turnover": "double", "vwap": "double",
    "is_valid_trade": "boolean", "quality_score": "double", "anomaly_flags": "array<string>", "data_date": "date",
}


def unify(parts: dict[str, DataFrame]) -> DataFrame:
    """Exchange frames with different columns to one typed, quality-scored table."""
    stacked = union_exchanges(parts)
    for name in ("bid_price", "ask_price"):
        if name not in stacked.columns:
            stacked = stacked.withColumn(name, F.lit(None).cast("double"))
    if "quantity" not in stacked.columns:
        stacked = stacked.withColumn("quantity", F.col("volume"))
    scored = with_row_quality(with_spread(stacked))
    return scored.select(*[
        (F.col(c) if c in scored.columns else F.lit(None)).cast(t).alias(c) for c, t in UNIFIED.items()
    ])


def export_order(df: DataFrame) -> DataFrame:
    """Total order by day, symbol, time (a range-partitioned sort)."""
    return df.orderBy("data_date", "symbol", "ts")


def data_summary(ticks: DataFrame) -> DataFrame:
    """Records and date range per exchange plus a TOTAL row, in one scan."""
    rolled = ticks.rollup("exchange").agg(
        F.grouping("exchange").alias("_g"),
        F.count("*").alias("records"),
        F.min("data_date").alias("min_date"),
        F.max("data_date").alias("max_date"),
    )
    label = F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("exchange"))
    return rolled.select(label.alias("exchange"), "records", "min_date", "max_date")


def records_per_day(ticks: DataFrame, as_of=None, days: int = 30, limit: int = 100) -> DataFrame:
    return (
        last_days(ticks, days, as_of).groupBy("exchange", "data_date").agg(F.count("*").alias("record_count"))
        .orderBy(F.col("data_date").desc(), "exchange").limit(limit)
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """Copies beyond the first of each row; null equals null.

    Grouping by the row combines copies on the map side, so a group of copies
    that is a third of the table still reaches the reducer as one row per task.
    """
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("unique_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_count"),
    )


def dedupe_by_key(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """Newest row per key; null keys are one key.

    Every task keeps its own newest row of a key before the exchange (window
    group limit), so a hot key sends one row a task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in newest_by])
    rest = [c for c in df.columns if c not in keys]
    return df.withColumn("_place", F.row_number().over(newest)).where("_place = 1").select(*keys, *rest)
