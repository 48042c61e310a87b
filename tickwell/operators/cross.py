"""Cross-exchange comparison: arbitrage rows, durations, volume correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell import dimensions
from tickwell.functions.scalar import percent, seconds_between
from tickwell.operators.bars import order_key
from tickwell.operators.filters import priced_trades
from tickwell.operators.ordered import MAX_GROUP_ROWS, SLICE_ROWS, asof_join


def bucket_prices(ticks: DataFrame, width: str, order: tuple[str, ...] = ("ts", "event_id"),
                  exchanges: list[str] | None = None) -> DataFrame:
    """One row per symbol and bucket with the last price and volume of each exchange.

    The exchanges become columns of one aggregate, so finding pairs needs
    neither a self join nor a second shuffle.
    """
    names = sorted(exchanges or dimensions.exchanges_of(ticks))
    kind = ticks.schema["ts"].dataType
    newest = order_key(ticks, order)
    aggs = []
    for e in names:
        here = F.col("exchange") == e
        aggs += [
            F.max_by("price", F.when(here, newest)).alias(f"{e}_price"),
            F.sum(F.when(here, F.col("volume"))).alias(f"{e}_volume"),
        ]
    return (
        priced_trades(ticks).groupBy("symbol", F.window("ts", width)["start"].cast(kind).alias("bucket")).agg(*aggs)
    )


def arbitrage(ticks: DataFrame, width: str = "1 minute", min_spread: float = 0.0,
              order: tuple[str, ...] = ("ts", "event_id"), exchanges: list[str] | None = None) -> DataFrame:
    """Price gaps between exchanges in the same bucket, one row per exchange pair.

    Without ``exchanges`` all that occur are compared.
    """
    names = sorted(exchanges or dimensions.exchanges_of(ticks))
    wide = bucket_prices(ticks, width, order, names)
    pairs = F.array(*[
        F.struct(
            F.lit(a).alias("exchange_1"), F.lit(b).alias("exchange_2"),
            F.col(f"{a}_price").alias("price_1"), F.col(f"{b}_price").alias("price_2"),
            F.col(f"{a}_volume").alias("volume_1"), F.col(f"{b}_volume").alias("volume_2"),
        )
        for i, a in enumerate(names) for b in names[i + 1:]
    ])
    rows = wide.select("symbol", F.col("bucket").alias("timestamp"), F.explode(pairs).alias("p")).select(
        "symbol", "timestamp", "p.*")
    spread = F.abs(F.col("price_1") - F.col("price_2"))
    return rows.select(
        "*", spread.alias("price_spread"),
        percent(spread, F.least("price_1", "price_2")).alias("spread_percentage"),
        (spread * F.least("volume_1", "volume_2")).alias("potential_profit"),
        F.to_date("timestamp").alias("data_date"),
    ).where(F.col("price_spread") > min_spread)


def best_arbitrage(rows: DataFrame, min_percent: float = 1.0) -> DataFrame:
    return rows.where(F.col("spread_percentage") > min_percent).orderBy(
        F.col("potential_profit").desc_nulls_last(), "symbol", "timestamp", "exchange_1", "exchange_2")


def arbitrage_durations(rows: DataFrame, width_seconds: int, min_percent: float = 0.0) -> DataFrame:
    """Runs of consecutive buckets over the threshold, with their length in seconds."""
    keys = ["symbol", "exchange_1", "exchange_2"]
    w = Window.partitionBy(*keys).orderBy("timestamp")
    over = rows.where(F.col("spread_percentage") > min_percent)
    gap = seconds_between(F.lag("timestamp").over(w), "timestamp")
    starts = over.withColumn("_new", F.when(gap == width_seconds, 0).otherwise(1))
    islands = starts.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*keys, "_run").agg(
        F.min("timestamp").alias("opened_at"),
        F.count("*").alias("buckets"),
        (F.count("*") * width_seconds).alias("opportunity_duration_seconds"),
        F.max("spread_percentage").alias("max_spread_percentage"),
    ).drop("_run")


def trades_with_quotes(ticks: DataFrame, max_group_rows: int = MAX_GROUP_ROWS,
                       slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Trades with the prevailing quote of the same exchange and symbol."""
    trades = ticks.where(F.col("type") == "Trade").select("exchange", "symbol", "ts", "event_id", "price", "volume")
    quotes = ticks.where(F.col("type") == "Quote").select("exchange", "symbol", "ts", "event_id", "bid_price", "ask_price")
    return asof_join(
        trades, quotes, ["exchange", "symbol"], "ts", ["bid_price", "ask_price"], "event_id", "event_id",
        prefix="quote_", max_group_rows=max_group_rows, slice_rows=slice_rows,
    )


def root_daily_volumes(ticks: DataFrame, exchange: str | None = None, start: str | None = None,
                       end: str | None = None) -> DataFrame:
    """Daily volume of the two crypto groups, days with both only.

    Both sides come from one conditional aggregate, so the date join of two
    scans disappears.
    """
    df = ticks
    if exchange:
        df = df.where(F.col("exchange") == exchange)
    if start:
        df = df.where(F.col("data_date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("data_date") <= F.lit(end).cast("date"))
    root = F.substring("symbol", 1, 3)
    btc, eth = root.isin(dimensions.BITCOIN_ROOTS), root.isin(dimensions.ETHEREUM_ROOTS)
    return (
        df.where(btc | eth).groupBy("data_date").agg(
            F.sum(F.when(btc, F.col("volume"))).alias("btc_volume"),
            F.sum(F.when(eth, F.col("volume"))).alias("eth_volume"),
        )
        .where(F.col("btc_volume").isNotNull() & F.col("eth_volume").isNotNull())
    )


def volume_correlation(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.corr(F.col("btc_volume").cast("double"), F.col("eth_volume").cast("double")).alias("correlation"),
        F.count("*").alias("days"),
        F.min("data_date").alias("first_day"),
        F.max("data_date").alias("last_day"),
    )
