"""Reports that combine several operators over one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.operators.activity import activity_extremes
from tickwell import dimensions
from tickwell.operators.bars import market_summary


def daily_digest(ticks: DataFrame, day: str, exchange: str, top_n: int = 10) -> DataFrame:
    """Most and least active symbols of a day and one summary row."""
    extremes = activity_extremes(ticks, day, exchange, "volume", 2 * top_n)
    one = ticks.where((F.col("data_date") == F.lit(day).cast("date")) & (F.col("exchange") == exchange))
    summary = market_summary(one, "exchange").select(
        F.lit(None).cast("string").alias("symbol"), "avg_price", "min_price", "max_price",
        F.col("count").alias("trade_count"), "total_volume", F.lit("summary").alias("side"),
    )
    return extremes.unionByName(summary)


def symbol_across_exchanges(ticks: DataFrame, symbol: str, day: str | None = None,
                            exchanges: list[str] | None = None) -> DataFrame:
    """One row per requested exchange; exchanges without data stay with zero trades."""
    wanted = exchanges or dimensions.LOADED_EXCHANGES
    picked = ticks.where((F.col("symbol") == symbol) & F.col("exchange").isin(wanted))
    if day:
        picked = picked.where(F.col("data_date") == F.lit(day).cast("date"))
    stats = picked.groupBy("exchange").agg(
        F.count("*").alias("trade_count"),
        F.sum("volume").alias("total_volume"),
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )
    request = ticks.sparkSession.createDataFrame([(e,) for e in wanted], "exchange string")
    return request.join(stats, "exchange", "left").withColumns({
        "trade_count": F.coalesce("trade_count", F.lit(0).cast("bigint")),
        "has_data": F.col("trade_count").isNotNull(),
    })
