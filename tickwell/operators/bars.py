"""OHLCV bars, daily summaries and resampling."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell.functions.scalar import micros_since_epoch, null_safe_join, ratio
from tickwell.operators.filters import in_session, priced_trades


def order_key(df: DataFrame, order: tuple[str, ...]) -> Column:
    """One comparable value for an order by several columns.

    A struct works for any columns but forces sort-based aggregation, because
    it cannot be updated in place.  Time plus an integer tie-break, the usual
    case, fits one decimal and keeps the hash aggregate.
    """
    if len(order) == 1:
        return F.col(order[0])
    first = df.schema[order[0]].dataType
    instant = isinstance(first, (T.TimestampType, T.TimestampNTZType))
    if len(order) == 2 and instant and isinstance(df.schema[order[1]].dataType, T.IntegralType):
        micros = F.unix_micros(order[0]) if isinstance(first, T.TimestampType) else micros_since_epoch(order[0])
        room = F.lit(Decimal(2 * 10**19))  # more than the span of a 64-bit tie-break
        return micros.cast("decimal(19,0)") * room + F.col(order[1]).cast("decimal(19,0)")
    return F.struct(*order)


def last_by(df: DataFrame, value: str, order: tuple[str, ...]) -> Column:
    return F.max_by(value, order_key(df, order))


def ohlcv(df: DataFrame, keys: list, order: tuple[str, ...] = ("ts", "event_id"),
          price: str = "price", volume: str = "volume", extra: tuple[Column, ...] = ()) -> DataFrame:
    """Open, high, low, close, volume per key; null prices never set a price."""
    priced = F.col(price).isNotNull()
    key = F.when(priced, order_key(df, order))
    return df.groupBy(*keys).agg(
        F.min_by(price, key).alias("open_price"),
        F.max(price).alias("high_price"),
        F.min(price).alias("low_price"),
        F.max_by(price, key).alias("close_price"),
        F.sum(volume).alias("volume"),
        *extra,
    )


def daily_summary(ticks: DataFrame, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Daily row per exchange and symbol with cross-exchange comparison.

    One shuffle for the bars (map-side combined) and one on the much smaller
    daily rows for the two comparisons, which share the partitioning.
    """
    trades = priced_trades(ticks)
    daily = ohlcv(
        trades, ["exchange", "symbol", "data_date"], order,
        extra=(
            F.sum(F.col("price") * F.col("volume")).alias("turnover"),
            F.count("*").alias("trade_count"),
            F.stddev("price").alias("price_volatility"),
        ),
    )
    daily = daily.withColumns({
        "vwap": ratio("turnover", "volume"),
        "avg_trade_size": ratio("volume", "trade_count"),
    })
    return with_exchange_comparison(daily)


def with_exchange_comparison(daily: DataFrame) -> DataFrame:
    """Close minus the mean close of the other exchanges, and the volume rank."""
    peers = Window.partitionBy("symbol", "data_date")
    others_sum = F.sum("close_price").over(peers) - F.col("close_price")
    others_n = F.count("close_price").over(peers) - 1
    return daily.select(
        "*",
        (F.col("close_price") - ratio(others_sum, others_n)).alias("price_difference_vs_other_exchanges"),
        F.rank().over(peers.orderBy(F.col("volume").desc_nulls_last())).alias("volume_rank"),
    )


def daily_closes(ticks: DataFrame, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Daily close and volume only: the input of indicators and returns."""
    trades = priced_trades(ticks)
    return trades.groupBy("exchange", "symbol", "data_date").agg(
        last_by(trades, "price", order).alias("close_price"), F.sum("volume").alias("volume")
    )


def minute_bars(ticks: DataFrame, symbols: list[str] | None = None, start: str | None = None,
                end: str | None = None, exchange: str | None = None,
                session_start: str = "08:00:00", session_end: str = "17:00:00",
                order: tuple[str, ...] = ("ts", "event_id"), width: str = "1 minute") -> DataFrame:
    """Trade bars inside the session; minutes without trades do not appear."""
    df = priced_trades(ticks)
    if symbols:
        df = df.where(F.col("symbol").isin(symbols))
    if start:
        df = df.where(F.col("data_date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("data_date") <= F.lit(end).cast("date"))
    if exchange:
        df = df.where(F.col("exchange") == exchange)
    df = df.where(in_session(session_start, session_end))
    bars = ohlcv(
        df.withColumn("bar_time", F.window("ts", width)["start"]),
        ["exchange", "symbol", "data_date", "bar_time"], order,
        extra=(F.count("*").alias("trade_count"), F.sum(F.col("price") * F.col("volume")).alias("_value")),
    )
    return bars.withColumn("vwap", ratio("_value", "volume")).drop("_value")


def bar_statistics(bars: DataFrame) -> DataFrame:
    """Bars, first and last time, price range, volume and volatility per symbol."""
    return bars.groupBy("exchange", "symbol").agg(
        F.count("*").alias("bar_count"),
        F.min("bar_time").alias("first_bar"),
        F.max("bar_time").alias("last_bar"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        (F.max("high_price") - F.min("low_price")).alias("price_range"),
        F.sum("volume").alias("total_volume"),
        F.avg("volume").alias("avg_bar_volume"),
        F.stddev("close_price").alias("close_volatility"),
    )


# Frame names of the resampling interface.
TIMEFRAMES = {"D": "1 day", "H": "1 hour", "h": "1 hour", "min": "1 minute", "T": "1 minute", "S": "1 second", "s": "1 second"}


def resample(df: DataFrame, timeframe: str = "D", price: str = "price", volume: str = "volume",
             ts: str = "ts", keys: tuple[str, ...] = (), tie: tuple[str, ...] = ()) -> DataFrame:
    """Bars of a time frame over the whole span, empty buckets included.

    Empty buckets have null prices and means and volume 0.  The calendar comes
    from the overall first and last bucket (a one-row subquery) and is
    exploded per key, so nothing is cross joined.
    """
    width = TIMEFRAMES.get(timeframe, timeframe)
    step = F.expr(f"INTERVAL {width}")
    means = [
        f.name for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in (price, volume, *keys)
    ]
    bucketed = df.where(F.col(ts).isNotNull()).withColumn("bucket", F.window(ts, width)["start"])
    order = F.when(F.col(price).isNotNull(), order_key(df, (ts, *tie)))
    bars = bucketed.groupBy(*keys, "bucket").agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum(volume).alias("volume"),
        *[F.avg(c).alias(f"{c}_mean") for c in means],
    )
    span = bars.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).where(F.col("lo").isNotNull())
    if keys:
        spine = bars.select(*keys).distinct().withColumns({
            "lo": span.select("lo").scalar(), "hi": span.select("hi").scalar(),
        })
    else:
        spine = span
    spine = spine.select(*keys, F.explode(F.sequence("lo", "hi", step)).alias("bucket"))
    return (
        null_safe_join(spine, bars, [*keys, "bucket"])
        .withColumn("volume", F.coalesce("volume", F.lit(0).cast(df.schema[volume].dataType)))
        .withColumnRenamed("bucket", ts)
    )


def market_summary(df: DataFrame, group_by: str | list[str] = "symbol") -> DataFrame:
    """Count, mean, min and max price, volume and sample volatility per key."""
    keys = [group_by] if isinstance(group_by, str) else group_by
    def have(name, col):
        return col if name in df.columns else F.lit(None).cast("double")
    return df.groupBy(*keys).agg(
        F.count("*").alias("count"),
        have("price", F.avg("price")).alias("avg_price"),
        have("price", F.min("price")).alias("min_price"),
        have("price", F.max("price")).alias("max_price"),
        have("volume", F.sum("volume")).alias("total_volume"),
        have("price", F.stddev("price")).alias("volatility"),
    )
