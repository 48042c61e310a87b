"""Analyst questions over ticks: patterns, returns, risk, flow, calendar effects.

Everything that needs an order works on daily rows (bounded by the calendar),
except order flow, which runs on ticks through ``ordered.lookback_window``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.functions.scalar import finite, percent, ratio
from tickwell.operators.bars import order_key
from tickwell.operators.filters import priced_trades, quotes, with_spread
from tickwell.operators.futures import with_contract
from tickwell.operators.ordered import MAX_GROUP_ROWS, SLICE_ROWS, lookback_window
from tickwell.operators.quantiles import exact_quantiles

SERIES = ["exchange", "symbol"]
COLUMNS_PER_JOB = 60


def hourly_pattern(ticks: DataFrame, symbol: str | None = None) -> DataFrame:
    df = ticks if symbol is None else ticks.where(F.col("symbol") == symbol)
    return df.groupBy("symbol", F.hour("ts").alias("hour")).agg(
        F.sum("volume").alias("total_volume"), F.count("*").alias("tick_count"), F.avg("price").alias("avg_price"))


def volatility_and_range(ticks: DataFrame) -> DataFrame:
    return priced_trades(ticks).groupBy("symbol").agg(
        F.stddev("price").alias("price_volatility"),
        (F.max("price") - F.min("price")).alias("price_range"),
        percent(F.max("price") - F.min("price"), F.avg("price")).alias("range_pct"),
        F.count("*").alias("trade_count"),
    )


def weighted_average_price(ticks: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    trades = priced_trades(ticks)
    return trades.groupBy(*keys).agg(
        ratio(F.sum(F.col("price") * F.col("volume")), F.sum("volume")).alias("vwap"),
        F.sum("volume").alias("total_volume"), F.count("*").alias("trade_count"))


def daily_returns(closes: DataFrame) -> DataFrame:
    """Close over previous close minus one; the first day of a series has none."""
    w = Window.partitionBy(*SERIES).orderBy("data_date")
    back = F.lag("close_price").over(w)
    return closes.select(*SERIES, "data_date", "close_price", (F.try_divide("close_price", back) - 1.0).alias("daily_return"))


def risk_metrics(returns: DataFrame) -> DataFrame:
    """Volatility with its rank per exchange, mean return and Sharpe ratio."""
    stats = returns.where(F.col("daily_return").isNotNull()).groupBy(*SERIES).agg(
        F.count("*").alias("days"),
        F.avg("daily_return").alias("mean_return"),
        F.stddev("daily_return").alias("return_volatility"),
        F.min("daily_return").alias("worst_return"),
        F.max("daily_return").alias("best_return"),
    ).withColumn("sharpe_ratio", ratio("mean_return", "return_volatility"))
    by = Window.partitionBy("exchange").orderBy(F.col("return_volatility").desc_nulls_last())
    return stats.withColumn("volatility_rank", F.rank().over(by))


def beta(returns: DataFrame, reference: str) -> DataFrame:
    """Slope against a reference contract on the same exchange and days."""
    base = returns.where(F.col("symbol") == reference).select(
        "exchange", "data_date", F.col("daily_return").alias("_base"))
    both = returns.join(base, ["exchange", "data_date"]).where(F.col("daily_return").isNotNull() & F.col("_base").isNotNull())
    return both.groupBy(*SERIES).agg(
        F.try_divide(F.covar_samp("daily_return", "_base"), F.var_samp("_base")).alias("beta"), F.count("*").alias("days"))


CONTRACTS = 2_000  # two million pairs an exchange


def contracts_of(ticks: DataFrame, roots: list[str]) -> list[str]:
    """Contract names of product roots: a chain lists one symbol per delivery month."""
    names = with_contract(ticks.select("symbol").distinct()).where(F.col("contract_root").isin(roots)).select("symbol").orderBy("symbol")
    return [r["symbol"] for r in names.toLocalIterator()]


def correlation_matrix(returns: DataFrame, symbols: list[str]) -> DataFrame:
    """Correlation of every two of the given contracts, per exchange.

    Each day gets one column per contract; a series is correlated with all
    columns in one aggregate.  No pair rows are built or shuffled, and long
    lists are split over several aggregates.  The result has a row for each
    pair, so at most ``CONTRACTS`` contracts are taken.
    """
    if len(symbols) < 2:
        raise ValueError("a correlation needs at least two contracts")
    if len(symbols) > CONTRACTS:
        raise ValueError(f"at most {CONTRACTS} contracts, not {len(symbols)}: pick product roots")
    series = returns.where(F.col("symbol").isin(symbols) & F.col("daily_return").isNotNull()).select(
        *SERIES, "data_date", "daily_return")
    parts = []
    for at in range(0, len(symbols), COLUMNS_PER_JOB):
        names = symbols[at:at + COLUMNS_PER_JOB]
        wide = series.groupBy("exchange", "data_date").agg(*[
            F.max(F.when(F.col("symbol") == s, F.col("daily_return"))).alias(f"r{i}") for i, s in enumerate(names)
        ])
        stats = series.join(wide, ["exchange", "data_date"]).groupBy(*SERIES).agg(*[
            F.struct(F.lit(s).alias("symbol_2"), F.corr("daily_return", f"r{i}").alias("correlation"),
                     F.count(f"r{i}").alias("days")).alias(f"s{i}")
            for i, s in enumerate(names)
        ])
        rows = F.explode(F.array(*[F.col(f"s{i}") for i in range(len(names))])).alias("p")
        parts.append(stats.select("exchange", F.col("symbol").alias("symbol_1"), rows).select("exchange", "symbol_1", "p.*"))
    both = reduce(lambda x, y: x.unionByName(y), parts)
    return both.where((F.col("symbol_1") < F.col("symbol_2")) & (F.col("days") >= 2)).withColumn(
        "correlation", finite("correlation"))


def drawdowns(closes: DataFrame) -> DataFrame:
    """Deepest fall from a running peak per series, and the day it was reached."""
    w = Window.partitionBy(*SERIES).orderBy("data_date").rowsBetween(Window.unboundedPreceding, 0)
    fall = F.try_divide("close_price", F.max("close_price").over(w)) - 1.0
    return closes.withColumn("drawdown", fall).groupBy(*SERIES).agg(
        F.min("drawdown").alias("max_drawdown"),
        F.min_by("data_date", F.struct("drawdown", "data_date")).alias("trough_date"),
    )


def hour_heatmap(ticks: DataFrame) -> DataFrame:
    """Volume per symbol with one column per hour."""
    return ticks.groupBy("symbol").agg(*[
        F.coalesce(F.sum(F.when(F.hour("ts") == h, F.col("volume"))), F.lit(0)).alias(f"h{h:02d}") for h in range(24)
    ])


def spread_analysis(ticks: DataFrame, keys: tuple[str, ...] = ("exchange", "symbol")) -> DataFrame:
    middle = (F.col("bid_price") + F.col("ask_price")) / 2.0
    return with_spread(quotes(ticks)).groupBy(*keys).agg(
        F.count("*").alias("quote_count"),
        F.avg("spread").alias("avg_spread"),
        F.min("spread").alias("min_spread"),
        F.max("spread").alias("max_spread"),
        (F.avg(F.try_divide(F.col("spread"), middle)) * 10000.0).alias("avg_spread_bps"),
    )


def trade_sizes(ticks: DataFrame, low: float = 0, high: float = 100, buckets: int = 10) -> DataFrame:
    """Trades and volume per size bucket and symbol."""
    trades = priced_trades(ticks).where(F.col("volume").isNotNull())
    bucket = F.width_bucket(F.col("volume").cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets))
    return trades.groupBy("symbol", bucket.alias("size_bucket")).agg(
        F.count("*").alias("trade_count"), F.sum("volume").alias("total_volume"),
        F.min("volume").alias("min_size"), F.max("volume").alias("max_size"))


def trade_size_percentiles(ticks: DataFrame, probabilities: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    values = exact_quantiles(priced_trades(ticks), "volume", list(probabilities))
    rows = list(zip([float(p) for p in probabilities], values))
    return ticks.sparkSession.createDataFrame(rows, "probability double, trade_size double")


def order_flow(ticks: DataFrame, max_group_rows: int = MAX_GROUP_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Signed volume by the tick rule, summed per series and day."""
    trades = priced_trades(ticks).select(*SERIES, "ts", "event_id", "data_date", "price", "volume")
    order = ["ts", "event_id"]

    def sign(part: DataFrame, by: list[str]) -> DataFrame:
        back = F.lag("price").over(Window.partitionBy(*by).orderBy(*order))
        return part.withColumn("_sign", F.signum(F.col("price") - back))

    signed = lookback_window(trades, SERIES, order, 1, sign, max_group_rows, slice_rows)
    buy = F.coalesce(F.sum(F.when(F.col("_sign") > 0, F.col("volume"))), F.lit(0))
    sell = F.coalesce(F.sum(F.when(F.col("_sign") < 0, F.col("volume"))), F.lit(0))
    return signed.groupBy(*SERIES, "data_date").agg(
        buy.alias("buy_volume"), sell.alias("sell_volume"), ratio(buy - sell, buy + sell).alias("imbalance"))


def signal_returns(returns: DataFrame) -> DataFrame:
    """Daily and cumulative return of following or fading yesterday's move."""
    w = Window.partitionBy(*SERIES).orderBy("data_date")
    follow = F.signum(F.lag("daily_return").over(w)) * F.col("daily_return")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    out = returns.where(F.col("daily_return").isNotNull()).select(
        *SERIES, "data_date", "daily_return", F.coalesce(follow, F.lit(0.0)).alias("momentum_return"))
    return out.select(
        "*", (-F.col("momentum_return")).alias("reversion_return"),
        F.sum("momentum_return").over(run).alias("momentum_cumulative"),
        (-F.sum("momentum_return").over(run)).alias("reversion_cumulative"))


def calendar_spreads(closes: DataFrame) -> DataFrame:
    """Close difference of a contract to the next listed one of its chain, per day."""
    chain = Window.partitionBy("exchange", "contract_root", "data_date").orderBy("contract_year", "contract_month")
    parsed = with_contract(closes).where(F.col("contract_root").isNotNull())
    out = parsed.select(
        "exchange", "contract_root", "data_date", F.col("symbol").alias("near_symbol"),
        F.lead("symbol").over(chain).alias("far_symbol"), F.col("close_price").alias("near_price"),
        F.lead("close_price").over(chain).alias("far_price"))
    return out.where(F.col("far_symbol").isNotNull()).withColumn("calendar_spread", F.col("far_price") - F.col("near_price"))


def value_at_risk(returns: DataFrame, level: float = 0.05) -> DataFrame:
    """Quantile of the equally weighted portfolio's daily return, per exchange.

    The quantile runs over one number per day.
    """
    portfolio = returns.where(F.col("daily_return").isNotNull()).groupBy("exchange", "data_date").agg(
        F.avg("daily_return").alias("portfolio_return"))
    return portfolio.groupBy("exchange").agg(
        F.percentile("portfolio_return", level).alias("value_at_risk"),
        F.avg("portfolio_return").alias("mean_return"), F.count("*").alias("days"))


def calendar_effects(returns: DataFrame) -> DataFrame:
    """Mean return by weekday, month and quarter end (last 5 days of a quarter)."""
    day = F.col("data_date")
    quarter_end = F.date_sub(F.add_months(F.trunc(day, "quarter"), 3), 1)
    kinds = F.explode(F.array(
        F.struct(F.lit("weekday").alias("effect"), F.weekday(day).cast("string").alias("bucket")),
        F.struct(F.lit("month").alias("effect"), F.month(day).cast("string").alias("bucket")),
        F.struct(F.lit("quarter_end").alias("effect"), (F.datediff(quarter_end, day) < 5).cast("string").alias("bucket")),
    )).alias("k")
    flat = returns.where(F.col("daily_return").isNotNull()).select("daily_return", kinds).select("daily_return", "k.*")
    return flat.groupBy("effect", "bucket").agg(
        F.count("*").alias("days"), F.avg("daily_return").alias("mean_return"), F.stddev("daily_return").alias("return_volatility"))


def time_of_day_volume(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy(F.hour("ts").alias("hour")).agg(
        F.sum("volume").alias("total_volume"), F.count("*").alias("tick_count"),
        F.count_distinct("data_date").alias("days"))


def last_settlement(ticks: DataFrame, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Last settlement price and open interest per contract and day."""
    key = order_key(ticks, order)
    return ticks.groupBy(*SERIES, "data_date").agg(
        F.max_by("settlement_price", F.when(F.col("settlement_price").isNotNull(), key)).alias("settlement_price"),
        F.max_by("open_interest", F.when(F.col("open_interest").isNotNull(), key)).alias("open_interest"))
