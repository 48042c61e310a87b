"""Bars, summaries, indicators and price series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwell.operators import activity, bars, filters, indicators
from tickwell.registry import register

TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
TRADE_KEY = "(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"

SUMMARY = """d AS (SELECT exchange, symbol, data_date, arg_min(price, ts) AS open_price, max(price) AS high_price, min(price) AS low_price,
  arg_max(price, ts) AS close_price, CAST(sum(volume) AS BIGINT) AS volume, sum(price * volume) AS turnover, count(*) AS trade_count,
  stddev(price) AS price_volatility FROM ticks WHERE type = 'Trade' AND price IS NOT NULL GROUP BY 1, 2, 3),
 s AS (SELECT *, turnover / nullif(volume, 0) AS vwap, volume / CAST(trade_count AS DOUBLE) AS avg_trade_size,
  close_price - (sum(close_price) OVER p - close_price) / nullif(count(close_price) OVER p - 1, 0) AS price_difference_vs_other_exchanges,
  CAST(rank() OVER (PARTITION BY symbol, data_date ORDER BY volume DESC NULLS LAST) AS INT) AS volume_rank
  FROM d WINDOW p AS (PARTITION BY symbol, data_date))"""


@register("agg_46_daily_summary", f"WITH {SUMMARY} SELECT * FROM s")
def _(t):
    return bars.daily_summary(t.ticks)


@register("jn_02_win_05_peer_comparison", """
WITH d AS (SELECT exchange, symbol, data_date, first(price ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS close_price,
  CAST(sum(volume) AS BIGINT) AS volume FROM trades GROUP BY 1, 2, 3)
SELECT *, close_price - (sum(close_price) OVER p - close_price) / nullif(count(close_price) OVER p - 1, 0) AS price_difference_vs_other_exchanges,
 CAST(rank() OVER (PARTITION BY symbol, data_date ORDER BY volume DESC NULLS LAST) AS INT) AS volume_rank
FROM d WINDOW p AS (PARTITION BY symbol, data_date)""")
def _(t):
    daily = bars.ohlcv(t.trades, ["exchange", "symbol", "data_date"], TRADE_ORDER)
    return bars.with_exchange_comparison(daily.select("exchange", "symbol", "data_date", "close_price", "volume"))


@register("win_02_volume_leaders", f"""WITH {SUMMARY}
SELECT exchange, symbol, volume, turnover, data_date,
 CAST(rank() OVER (PARTITION BY exchange, data_date ORDER BY volume DESC NULLS LAST) AS INT) AS volume_rank
FROM s WHERE data_date >= DATE '2024-01-31' - 30""")
def _(t):
    return activity.volume_leaders(filters.last_days(bars.daily_summary(t.ticks), 30, "2024-01-31"))


@register("agg_32_market_summary", """
SELECT symbol, count(*) AS count, avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price,
 CAST(sum(volume) AS BIGINT) AS total_volume, stddev(price) AS volatility FROM trades GROUP BY 1""")
def _(t):
    return bars.market_summary(t.trades)


@register("agg_33_resample_daily", """
WITH x AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS b, ts, price, volume, yield_value FROM ticks),
 a AS (SELECT b, arg_min(price, ts) FILTER (price IS NOT NULL) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, ts) FILTER (price IS NOT NULL) AS close, CAST(sum(volume) AS BIGINT) AS volume, avg(yield_value) AS yield_value_mean FROM x GROUP BY 1)
SELECT s.ts, open, high, low, close, coalesce(volume, 0) AS volume, yield_value_mean
FROM (SELECT unnest(generate_series(min(b), max(b), INTERVAL 1 DAY)) AS ts FROM x) s LEFT JOIN a ON a.b = s.ts""")
def _(t):
    return bars.resample(t.ticks.select("ts", "price", "volume", "yield_value"), "D")


@register("agg_33_resample_hourly_by_symbol", """
WITH x AS (SELECT *, date_trunc('hour', ts) AS b FROM ticks),
 a AS (SELECT symbol, b, arg_min(price, ts) FILTER (price IS NOT NULL) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, ts) FILTER (price IS NOT NULL) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM x GROUP BY 1, 2),
 s AS (SELECT symbol, unnest(generate_series((SELECT min(b) FROM x), (SELECT max(b) FROM x), INTERVAL 1 HOUR)) AS ts FROM (SELECT DISTINCT symbol FROM x))
SELECT s.symbol, s.ts, open, high, low, close, coalesce(volume, 0) AS volume FROM s LEFT JOIN a ON a.symbol = s.symbol AND a.b = s.ts""")
def _(t):
    return bars.resample(t.ticks.select("symbol", "ts", "price", "volume"), "H", keys=("symbol",))


MINUTES = """m AS (SELECT exchange, symbol, data_date, date_trunc('minute', ts) AS bar_time, arg_min(price, ts) AS open_price, max(price) AS high_price,
  min(price) AS low_price, arg_max(price, ts) AS close_price, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS trade_count,
  sum(price * volume) / nullif(sum(volume), 0) AS vwap FROM ticks
  WHERE type = 'Trade' AND price IS NOT NULL AND strftime(ts, '%H:%M:%S') >= '08:00:00' AND strftime(ts, '%H:%M:%S') < '17:00:00' GROUP BY 1, 2, 3, 4)"""


@register("agg_37_minute_bars", f"WITH {MINUTES} SELECT * FROM m")
def _(t):
    return bars.minute_bars(t.ticks)


@register("agg_39_bar_statistics", f"""WITH {MINUTES}
SELECT exchange, symbol, count(*) AS bar_count, min(bar_time) AS first_bar, max(bar_time) AS last_bar, max(high_price) AS high_price,
 min(low_price) AS low_price, max(high_price) - min(low_price) AS price_range, CAST(sum(volume) AS BIGINT) AS total_volume,
 avg(volume) AS avg_bar_volume, stddev(close_price) AS close_volatility FROM m GROUP BY 1, 2""")
def _(t):
    return bars.bar_statistics(bars.minute_bars(t.ticks))


# --- indicators -------------------------------------------------------------------

CLOSES = """c AS (SELECT exchange, symbol, data_date, arg_max(price, ts) AS close_price FROM ticks
  WHERE type = 'Trade' AND price IS NOT NULL GROUP BY 1, 2, 3)"""
TRADE_CLOSES = f"""c AS (SELECT exchange, symbol, data_date, first(price ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC,
  l_suppkey DESC, l_extendedprice DESC) AS close_price FROM trades GROUP BY 1, 2, 3)"""


def _ema(xs: str, span: int) -> str:
    keep = f"(1 - CAST(2 AS DOUBLE) / {span + 1})"
    return (f"list_sum(list_transform({xs}, lambda x, i: x * pow({keep}, len({xs}) - i))) / "
            f"list_sum(list_transform({xs}, lambda x, i: pow({keep}, len({xs}) - i)))")


def _bundle(closes: str) -> str:
    p = "PARTITION BY exchange, symbol ORDER BY data_date"
    def last(n):
        return f"({p} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"""WITH {closes},
 w AS (SELECT *, list(close_price) OVER ({p} ROWS UNBOUNDED PRECEDING) AS xs, row_number() OVER ({p}) AS rn,
   lag(close_price) OVER ({p}) AS prev FROM c),
 e AS (SELECT * EXCLUDE (xs), {_ema('xs', 12)} AS ema_12, {_ema('xs', 26)} AS ema_26 FROM w),
 g AS (SELECT *, ema_12 - ema_26 AS macd, avg(greatest(coalesce(close_price - prev, 0), 0)) OVER {last(14)} AS gain,
   avg(greatest(coalesce(prev - close_price, 0), 0)) OVER {last(14)} AS loss FROM e),
 m AS (SELECT *, list(macd) OVER ({p} ROWS UNBOUNDED PRECEDING) AS ms FROM g)
SELECT exchange, symbol, data_date, close_price,
 avg(close_price) OVER {last(5)} AS sma_5, avg(close_price) OVER {last(10)} AS sma_10, avg(close_price) OVER {last(20)} AS sma_20,
 avg(close_price) OVER {last(50)} AS sma_50, ema_12, ema_26, macd, {_ema('ms', 9)} AS macd_signal, macd - ({_ema('ms', 9)}) AS macd_histogram,
 CASE WHEN rn >= 14 THEN CASE WHEN loss > 0 THEN 100 - 100 / (1 + gain / loss) WHEN gain > 0 THEN 100 END END AS rsi,
 CASE WHEN rn >= 20 THEN avg(close_price) OVER {last(20)} + 2 * stddev(close_price) OVER {last(20)} END AS bb_upper,
 CASE WHEN rn >= 20 THEN avg(close_price) OVER {last(20)} - 2 * stddev(close_price) OVER {last(20)} END AS bb_lower,
 CASE WHEN rn >= 20 THEN avg(close_price) OVER {last(20)} END AS bb_middle,
 (close_price / nullif(prev, 0) - 1) * 100 AS price_change_pct FROM m"""


def _closes(t):
    return bars.daily_closes(t.ticks).drop("volume")


def _trade_closes(t):
    # Symbol first: the order key of many columns makes this a sort, and exchanges are too few to tell rows apart.
    return bars.ohlcv(t.trades, ["symbol", "exchange", "data_date"], TRADE_ORDER).select(
        "exchange", "symbol", "data_date", "close_price")


@register("win_17_indicators", _bundle(CLOSES))
def _(t):
    return indicators.add_indicators(_closes(t))


@register("win_17_indicators_trades", _bundle(TRADE_CLOSES))
def _(t):
    return indicators.add_indicators(_trade_closes(t))


@register("win_06_sma", f"""WITH {TRADE_CLOSES}
SELECT *, avg(close_price) OVER (PARTITION BY exchange, symbol ORDER BY data_date ROWS 4 PRECEDING) AS sma_5,
 avg(close_price) OVER (PARTITION BY exchange, symbol ORDER BY data_date ROWS 49 PRECEDING) AS sma_50 FROM c""")
def _(t):
    w = indicators.series_window(indicators.SERIES, ["data_date"])
    return _trade_closes(t).withColumns({
        "sma_5": indicators.sma("close_price", 5, w), "sma_50": indicators.sma("close_price", 50, w)})


@register("win_07_08_ema_macd", f"""
SELECT exchange, symbol, data_date, ema_12, ema_26, macd, macd_signal, macd_histogram FROM ({_bundle(TRADE_CLOSES)})""")
def _(t):
    keys = indicators.SERIES
    out = indicators.with_position(_trade_closes(t), keys, ["data_date"])
    out = indicators.add_ema(out, keys, {"ema_12": ("close_price", 12), "ema_26": ("close_price", 26)})
    out = indicators.add_ema(out.withColumn("macd", F.col("ema_12") - F.col("ema_26")), keys, {"macd_signal": ("macd", 9)})
    return out.select("exchange", "symbol", "data_date", "ema_12", "ema_26", "macd", "macd_signal",
                      (F.col("macd") - F.col("macd_signal")).alias("macd_histogram"))


@register("win_09_rsi", f"SELECT exchange, symbol, data_date, close_price, rsi FROM ({_bundle(TRADE_CLOSES)})")
def _(t):
    return indicators.add_rsi(_trade_closes(t), "close_price", indicators.SERIES, ["data_date"])


@register("win_10_bollinger", f"SELECT exchange, symbol, data_date, bb_upper, bb_lower, bb_middle FROM ({_bundle(TRADE_CLOSES)})")
def _(t):
    return indicators.add_bollinger(_trade_closes(t), "close_price", indicators.SERIES, ["data_date"]).drop("close_price")


@register("win_11_12_changes", f"""WITH {CLOSES}
SELECT *, (close_price / nullif(lag(close_price) OVER w, 0) - 1) * 100 AS price_change_pct, close_price - lag(close_price) OVER w AS price_diff
FROM c WINDOW w AS (PARTITION BY exchange, symbol ORDER BY data_date)""")
def _(t):
    w = indicators.series_window(indicators.SERIES, ["data_date"])
    return _closes(t).withColumns({
        "price_change_pct": indicators.percent_change("close_price", w),
        "price_diff": indicators.difference("close_price", w)})


@register("win_19_price_timeseries", """
WITH p AS (SELECT exchange, symbol, ts, event_id, price, volume, data_date, row_number() OVER w AS rn, price - lag(price) OVER w AS delta
   FROM ticks WHERE price IS NOT NULL WINDOW w AS (PARTITION BY exchange, symbol ORDER BY ts, event_id)),
 g AS (SELECT *, avg(greatest(coalesce(delta, 0), 0)) OVER r AS gain, avg(greatest(coalesce(-delta, 0), 0)) OVER r AS loss
   FROM p WINDOW r AS (PARTITION BY exchange, symbol ORDER BY ts, event_id ROWS 13 PRECEDING))
SELECT exchange, symbol, ts, event_id, price, volume, data_date,
 avg(price) OVER (PARTITION BY exchange, symbol ORDER BY ts, event_id ROWS 9 PRECEDING) AS sma_10,
 avg(price) OVER (PARTITION BY exchange, symbol ORDER BY ts, event_id ROWS 49 PRECEDING) AS sma_50,
 CASE WHEN rn >= 14 THEN CASE WHEN loss > 0 THEN 100 - 100 / (1 + gain / loss) WHEN gain > 0 THEN 100 END END AS rsi FROM g""")
def _(t):
    return indicators.price_timeseries(t.ticks)


@register("udf_06_ema_by_series", f"""WITH {CLOSES}, w AS (SELECT *, list(close_price) OVER (PARTITION BY exchange, symbol
  ORDER BY data_date ROWS UNBOUNDED PRECEDING) AS xs FROM c)
SELECT exchange, symbol, data_date, close_price, {_ema('xs', 12)} AS ema_12, {_ema('xs', 26)} AS ema_26 FROM w""")
def _(t):
    return indicators.ema_by_series(_closes(t), {"ema_12": 12, "ema_26": 26})
