"""Symbol activity: directories, most and least active lists, calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.functions.scalar import ratio
from tickwell.operators.filters import is_numeric, positive_trades, symbols_in
from tickwell.operators.sets import dedupe_by_key
from tickwell import dimensions


def dataset_exchanges(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("exchange").agg(
        F.count("*").alias("record_count"),
        F.min("data_date").alias("earliest_date"),
        F.max("data_date").alias("latest_date"),
        F.count_distinct("symbol").alias("unique_symbols"),
    )


def symbol_directory(
    ticks: DataFrame, exchange: str | None = None, start: str | None = None, end: str | None = None,
    keys: tuple[str, ...] = ("symbol",),
) -> DataFrame:
    """Count, first and last day, mean price and volume per symbol."""
    df = ticks
    if exchange:
        df = df.where(F.col("exchange") == exchange)
    if start:
        df = df.where(F.col("data_date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("data_date") <= F.lit(end).cast("date"))
    volume = (
        F.avg("volume").alias("avg_volume")
        if is_numeric(ticks, "volume")
        else F.count("*").alias("volume_records")
    )
    return df.groupBy(*keys).agg(
        F.count("*").alias("trade_count"),
        F.min("data_date").alias("first_seen"),
        F.max("data_date").alias("last_seen"),
        F.avg("price").alias("avg_price"),
        volume,
    )


def symbol_activity(ticks: DataFrame, day: str, exchange: str | None = None) -> DataFrame:
    """One row per symbol of a day; ``total_volume`` only when volume is a number."""
    df = ticks.where(F.col("data_date") == F.lit(day).cast("date"))
    if exchange:
        df = df.where(F.col("exchange") == exchange)
    aggs = [
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count("*").alias("trade_count"),
    ]
    if is_numeric(ticks, "volume"):
        aggs.append(F.sum("volume").alias("total_volume"))
    return df.groupBy("symbol").agg(*aggs)


def activity_metric(ticks: DataFrame, metric: str) -> str:
    """Column to rank by: volume falls back to trades when it is text."""
    if metric == "volume" and is_numeric(ticks, "volume"):
        return "total_volume"
    if metric in ("volume", "trade_count"):
        return "trade_count"
    raise ValueError(f"metric must be 'volume' or 'trade_count', not {metric!r}")


def most_active(ticks: DataFrame, day: str, exchange: str | None = None,
                metric: str = "trade_count", limit: int = 10) -> DataFrame:
    rank_by = activity_metric(ticks, metric)
    return (
        symbol_activity(ticks, day, exchange)
        .orderBy(F.col(rank_by).desc_nulls_last(), "symbol").limit(limit)
    )


def least_active(ticks: DataFrame, day: str, exchange: str | None = None,
                 metric: str = "trade_count", limit: int = 10) -> DataFrame:
    rank_by = activity_metric(ticks, metric)
    return (
        symbol_activity(ticks, day, exchange)
        .orderBy(F.col(rank_by).asc_nulls_last(), "symbol").limit(limit)
    )


def activity_extremes(ticks: DataFrame, day: str, exchange: str | None = None,
                      metric: str = "trade_count", limit: int = 10) -> DataFrame:
    """Half of the limit from each end of the list, tagged by side.

    Two top-k reads of one aggregate: the planner reuses its exchange, and no
    global window pulls all symbols into one task.
    """
    half = max(limit // 2, 1)
    most = most_active(ticks, day, exchange, metric, half).withColumn("side", F.lit("most"))
    least = least_active(ticks, day, exchange, metric, half).withColumn("side", F.lit("least"))
    return most.unionByName(least)


def leaders_per_day(ticks: DataFrame, n: int = 1, exchange: str | None = None) -> DataFrame:
    """Top ``n`` symbols by volume for each day."""
    df = ticks if exchange is None else ticks.where(F.col("exchange") == exchange)
    daily = df.groupBy("data_date", "symbol").agg(F.sum("volume").alias("total_volume"))
    w = Window.partitionBy("data_date").orderBy(F.col("total_volume").desc_nulls_last(), F.col("symbol"))
    return daily.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def trading_calendar(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("exchange", "data_date").agg(
        F.count("*").alias("trade_count"), F.count_distinct("symbol").alias("symbol_count")
    )


def symbol_mapping(ticks: DataFrame, exchange: str | None = None, limit: int = 1000) -> DataFrame:
    """Symbol directory, busiest by volume first."""
    df = ticks if exchange is None else ticks.where(F.col("exchange") == exchange)
    return (
        df.groupBy("exchange", "symbol").agg(
            F.count("*").alias("trade_count"),
            F.min("data_date").alias("first_seen"),
            F.max("data_date").alias("last_seen"),
            F.avg("price").alias("avg_price"),
            F.sum("volume").alias("total_volume"),
        )
        .orderBy(F.col("total_volume").desc_nulls_last(), "exchange", "symbol")
        .limit(limit)
    )


def most_traded(ticks: DataFrame, limit: int = 5) -> DataFrame:
    return (
        positive_trades(ticks).groupBy("symbol").agg(
            F.count("*").alias("trade_count"),
            F.avg("price").alias("avg_price"),
            F.sum("volume").alias("total_volume"),
        )
        .orderBy(F.col("trade_count").desc(), "symbol").limit(limit)
    )


def exchange_counts(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("exchange").agg(
        F.count_distinct("symbol").alias("unique_symbols"), F.count("*").alias("record_count")
    )


def average_prices(ticks: DataFrame, start: str, end: str) -> DataFrame:
    day = F.col("data_date")
    return (
        ticks.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .groupBy("exchange", "symbol").agg(F.avg("price").alias("avg_price"))
    )


def latest_per_symbol(ticks: DataFrame, order: tuple[str, ...] = ("exchange_time", "event_id")) -> DataFrame:
    """Newest row per exchange and symbol; a hot symbol sends one row a task."""
    return dedupe_by_key(ticks, ["exchange", "symbol"], list(order))


def cross_exchange_prices(latest: DataFrame, as_of: str) -> DataFrame:
    """One row per symbol with the latest price of each exchange."""
    names = dimensions.LOADED_EXCHANGES
    return latest.groupBy("symbol").agg(
        *[F.max(F.when(F.col("exchange") == e, F.col("price"))).alias(f"{e.lower()}_price") for e in names],
        F.max("exchange_time").alias("latest_time"),
    ).withColumn("data_date", F.lit(as_of).cast("date"))


def volume_leaders(daily: DataFrame) -> DataFrame:
    """Volume rank inside each exchange and day over daily summary rows."""
    w = Window.partitionBy("exchange", "data_date").orderBy(F.col("volume").desc_nulls_last())
    return daily.select(
        "exchange", "symbol", "volume", "turnover", "data_date", F.rank().over(w).alias("volume_rank")
    )


def category_volume(ticks: DataFrame, category: str, exchange: str, day: str | None = None) -> DataFrame:
    """Per-symbol trades, volume and volume-weighted price plus a TOTAL row."""
    symbols = dimensions.category_symbols(category, exchange)
    df = symbols_in(ticks.where(F.col("exchange") == exchange), symbols)
    if day:
        df = df.where(F.col("data_date") == F.lit(day).cast("date"))
    weighted = F.col("price") * F.col("volume")
    per_symbol = df.groupBy("symbol").agg(
        F.count("*").alias("trade_count"),
        F.sum("volume").alias("total_volume"),
        F.sum(weighted).alias("value"),
        F.sum(F.when(F.col("price").isNotNull(), F.col("volume"))).alias("weight"),
    )
    rolled = per_symbol.rollup("symbol").agg(
        F.grouping("symbol").alias("is_total"),
        F.count("*").alias("symbols_active"),
        F.sum("trade_count").alias("trade_count"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("value").alias("value"),
        F.sum("weight").alias("weight"),
    )
    return rolled.select(
        F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("symbol")).alias("symbol"),
        F.lit(len(symbols)).cast("bigint").alias("symbols_in_category"),
        "symbols_active",
        F.coalesce("trade_count", F.lit(0)).alias("trade_count"),
        "total_volume",
        ratio("value", "weight").alias("weighted_avg_price"),
    )


def category_members(ticks: DataFrame, day: str | None = None) -> DataFrame:
    """Every category member with its activity; members without ticks stay."""
    df = ticks if day is None else ticks.where(F.col("data_date") == F.lit(day).cast("date"))
    dim = dimensions.category_dim(ticks.sparkSession).select("category", "exchange", "symbol")
    wanted = sorted({s for c in dimensions.CATEGORIES.values() for s in c["symbols"]})
    stats = symbol_directory(symbols_in(df, wanted), keys=("exchange", "symbol"))
    return dim.join(stats, ["exchange", "symbol"], "left").withColumn(
        "trade_count", F.coalesce("trade_count", F.lit(0).cast("bigint"))
    )


def category_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks that belong to any category: a broadcast semi join on the fixed dimension."""
    dim = dimensions.category_dim(ticks.sparkSession).select("exchange", "symbol").distinct()
    return ticks.join(F.broadcast(dim), ["exchange", "symbol"], "left_semi")
