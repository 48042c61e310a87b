"""Analyst questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwell.dimensions import BITCOIN_ROOTS
from tickwell.operators import analyst, bars
from tickwell.operators.ordered import SLICE_ROWS
from tickwell.registry import register

TRADE = "type = 'Trade' AND price IS NOT NULL"
C = f"c AS (SELECT exchange, symbol, data_date, arg_max(price, ts) AS close_price FROM ticks WHERE {TRADE} GROUP BY 1, 2, 3)"
R = f"""{C}, r AS (SELECT *, close_price / nullif(lag(close_price) OVER (PARTITION BY exchange, symbol ORDER BY data_date), 0) - 1 AS daily_return FROM c)"""


def _closes(t):
    return bars.daily_closes(t.ticks).drop("volume")


def _returns(t):
    return analyst.daily_returns(_closes(t))


@register("anl_01_hourly_pattern", """
SELECT symbol, CAST(hour(ts) AS INT) AS hour, CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS tick_count, avg(price) AS avg_price
FROM ticks WHERE symbol = 'BTCF25' GROUP BY 1, 2""")
def _(t):
    return analyst.hourly_pattern(t.ticks, "BTCF25")


@register("anl_02_volatility_range", f"""
SELECT symbol, stddev(price) AS price_volatility, max(price) - min(price) AS price_range, (max(price) - min(price)) * 100 / avg(price) AS range_pct,
 count(*) AS trade_count FROM ticks WHERE {TRADE} GROUP BY 1""")
def _(t):
    return analyst.volatility_and_range(t.ticks)


@register("anl_03_vwap", f"""
SELECT symbol, sum(price * volume) / nullif(sum(volume), 0) AS vwap, CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS trade_count
FROM ticks WHERE {TRADE} GROUP BY 1""")
def _(t):
    return analyst.weighted_average_price(t.ticks)


@register("anl_04_daily_returns", f"WITH {R} SELECT * FROM r")
def _(t):
    return _returns(t)


@register("anl_05_09_risk_metrics", f"""WITH {R},
 s AS (SELECT exchange, symbol, count(*) AS days, avg(daily_return) AS mean_return, stddev(daily_return) AS return_volatility,
  min(daily_return) AS worst_return, max(daily_return) AS best_return FROM r WHERE daily_return IS NOT NULL GROUP BY 1, 2)
SELECT *, mean_return / nullif(return_volatility, 0) AS sharpe_ratio,
 CAST(rank() OVER (PARTITION BY exchange ORDER BY return_volatility DESC NULLS LAST) AS INT) AS volatility_rank FROM s""")
def _(t):
    return analyst.risk_metrics(_returns(t))


@register("anl_06_beta", f"""WITH {R}
SELECT r.exchange, r.symbol, covar_samp(r.daily_return, b.daily_return) / nullif(var_samp(b.daily_return), 0) AS beta, count(*) AS days
FROM r JOIN (SELECT * FROM r WHERE symbol = 'BTCF25') b ON b.exchange = r.exchange AND b.data_date = r.data_date
WHERE r.daily_return IS NOT NULL AND b.daily_return IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return analyst.beta(_returns(t), "BTCF25")


@register("anl_07_correlation_matrix", f"""WITH {R}, x AS (SELECT * FROM r WHERE left(symbol, 3) IN ('BTC', 'MBT') AND daily_return IS NOT NULL)
SELECT a.exchange, a.symbol AS symbol_1, b.symbol AS symbol_2, corr(a.daily_return, b.daily_return) AS correlation, count(*) AS days
FROM x a JOIN x b ON a.exchange = b.exchange AND a.data_date = b.data_date AND a.symbol < b.symbol GROUP BY 1, 2, 3 HAVING count(*) >= 2""")
def _(t):
    return analyst.correlation_matrix(_returns(t), analyst.contracts_of(t.ticks, BITCOIN_ROOTS))


@register("anl_08_drawdowns", f"""WITH {C}, d AS (SELECT *, close_price / nullif(max(close_price) OVER (PARTITION BY exchange, symbol ORDER BY data_date
  ROWS UNBOUNDED PRECEDING), 0) - 1 AS drawdown FROM c)
SELECT exchange, symbol, min(drawdown) AS max_drawdown, first(data_date ORDER BY drawdown, data_date) AS trough_date FROM d GROUP BY 1, 2""")
def _(t):
    return analyst.drawdowns(_closes(t))


@register("anl_10_hour_heatmap", "SELECT symbol, " + ", ".join(
    f"coalesce(CAST(sum(CASE WHEN hour(ts) = {h} THEN volume END) AS BIGINT), 0) AS h{h:02d}" for h in range(24)) + " FROM ticks GROUP BY 1")
def _(t):
    return analyst.hour_heatmap(t.ticks)


@register("anl_11_spread_analysis", """
SELECT exchange, symbol, count(*) AS quote_count, avg(ask_price - bid_price) AS avg_spread, min(ask_price - bid_price) AS min_spread,
 max(ask_price - bid_price) AS max_spread, avg((ask_price - bid_price) / nullif((bid_price + ask_price) / 2, 0)) * 10000 AS avg_spread_bps
FROM ticks WHERE type = 'Quote' GROUP BY 1, 2""")
def _(t):
    return analyst.spread_analysis(t.ticks)


@register("anl_12_trade_sizes", f"""
SELECT symbol, CASE WHEN volume >= 100 THEN 11 WHEN volume < 0 THEN 0 ELSE volume // 10 + 1 END AS size_bucket, count(*) AS trade_count,
 CAST(sum(volume) AS BIGINT) AS total_volume, min(volume) AS min_size, max(volume) AS max_size FROM ticks WHERE {TRADE} AND volume IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return analyst.trade_sizes(t.ticks)


@register("anl_12_trade_size_percentiles", f"""
SELECT unnest([CAST(0.5 AS DOUBLE), 0.9, 0.99]) AS probability, unnest([quantile_cont(CAST(volume AS DOUBLE), 0.5), quantile_cont(CAST(volume AS DOUBLE), 0.9),
 quantile_cont(CAST(volume AS DOUBLE), 0.99)]) AS trade_size FROM ticks WHERE {TRADE}""")
def _(t):
    return analyst.trade_size_percentiles(t.ticks)


FLOW = f"""
WITH s AS (SELECT exchange, symbol, data_date, volume, sign(price - lag(price) OVER (PARTITION BY exchange, symbol ORDER BY ts, event_id)) AS g
  FROM ticks WHERE {TRADE}),
 f AS (SELECT exchange, symbol, data_date, coalesce(CAST(sum(CASE WHEN g > 0 THEN volume END) AS BIGINT), 0) AS buy_volume,
  coalesce(CAST(sum(CASE WHEN g < 0 THEN volume END) AS BIGINT), 0) AS sell_volume FROM s GROUP BY 1, 2, 3)
SELECT *, (buy_volume - sell_volume) / CAST(nullif(buy_volume + sell_volume, 0) AS DOUBLE) AS imbalance FROM f"""


@register("anl_13_order_flow", FLOW)
def _(t):
    return analyst.order_flow(t.ticks)


@register("anl_13_order_flow_sliced", FLOW)
def _(t):
    """The path for a hot symbol, forced, with at least eight blocks."""
    rows = min(SLICE_ROWS, t.ticks.count() // 8 + 1)
    return analyst.order_flow(t.ticks, max_group_rows=0, slice_rows=rows)


@register("anl_14_signal_returns", f"""WITH {R}, x AS (SELECT * FROM r WHERE daily_return IS NOT NULL),
 m AS (SELECT exchange, symbol, data_date, daily_return,
  coalesce(sign(lag(daily_return) OVER (PARTITION BY exchange, symbol ORDER BY data_date)) * daily_return, 0) AS momentum_return FROM x)
SELECT *, -momentum_return AS reversion_return, sum(momentum_return) OVER w AS momentum_cumulative, -sum(momentum_return) OVER w AS reversion_cumulative
FROM m WINDOW w AS (PARTITION BY exchange, symbol ORDER BY data_date ROWS UNBOUNDED PRECEDING)""")
def _(t):
    return analyst.signal_returns(_returns(t))


@register("anl_15_calendar_spreads", f"""WITH {C},
 p AS (SELECT exchange, left(symbol, 3) AS contract_root, data_date, symbol AS near_symbol, close_price AS near_price,
  lead(symbol) OVER w AS far_symbol, lead(close_price) OVER w AS far_price FROM c
  WINDOW w AS (PARTITION BY exchange, left(symbol, 3), data_date ORDER BY right(symbol, 2), strpos('FGHJKMNQUVXZ', substring(symbol, 4, 1))))
SELECT *, far_price - near_price AS calendar_spread FROM p WHERE far_symbol IS NOT NULL""")
def _(t):
    return analyst.calendar_spreads(_closes(t))


@register("anl_16_value_at_risk", f"""WITH {R}, p AS (SELECT exchange, data_date, avg(daily_return) AS x FROM r WHERE daily_return IS NOT NULL GROUP BY 1, 2)
SELECT exchange, quantile_cont(x, 0.05) AS value_at_risk, avg(x) AS mean_return, count(*) AS days FROM p GROUP BY 1""")
def _(t):
    return analyst.value_at_risk(_returns(t))


@register("anl_17_calendar_effects", f"""WITH {R}, x AS (SELECT daily_return, data_date FROM r WHERE daily_return IS NOT NULL),
 k AS (SELECT daily_return, 'weekday' AS effect, CAST(isodow(data_date) - 1 AS VARCHAR) AS bucket FROM x UNION ALL
  SELECT daily_return, 'month', CAST(month(data_date) AS VARCHAR) FROM x UNION ALL
  SELECT daily_return, 'quarter_end', CASE WHEN date_diff('day', data_date, CAST(date_trunc('quarter', data_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)) < 5 THEN 'true' ELSE 'false' END FROM x)
SELECT effect, bucket, count(*) AS days, avg(daily_return) AS mean_return, stddev(daily_return) AS return_volatility FROM k GROUP BY 1, 2""")
def _(t):
    return analyst.calendar_effects(_returns(t))


@register("anl_17_time_of_day", """
SELECT CAST(hour(ts) AS INT) AS hour, CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS tick_count, count(DISTINCT data_date) AS days FROM ticks GROUP BY 1""")
def _(t):
    return analyst.time_of_day_volume(t.ticks)


@register("anl_18_settlement", """
SELECT exchange, symbol, data_date, arg_max(price, ts) FILTER (price IS NOT NULL) AS settlement_price, arg_max(volume * 10, ts) AS open_interest FROM ticks GROUP BY 1, 2, 3""")
def _(t):
    return analyst.last_settlement(t.ticks.withColumns({
        "settlement_price": F.col("price"), "open_interest": F.col("volume") * 10}))
