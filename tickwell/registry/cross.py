"""Cross-exchange comparison, as-of joins and futures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwell.operators import cross, futures
from tickwell.operators.ordered import SLICE_ROWS
from tickwell.plans import digest
from tickwell.registry import register

ARB = """b AS (SELECT symbol, exchange, {bucket} AS timestamp, arg_max(price, ts) AS price, CAST(sum(volume) AS BIGINT) AS volume
  FROM ticks WHERE type = 'Trade' AND price IS NOT NULL GROUP BY 1, 2, 3),
 arb AS (SELECT x.symbol, x.timestamp, x.exchange AS exchange_1, y.exchange AS exchange_2, x.price AS price_1, y.price AS price_2,
  x.volume AS volume_1, y.volume AS volume_2, abs(x.price - y.price) AS price_spread,
  abs(x.price - y.price) * 100 / nullif(least(x.price, y.price), 0) AS spread_percentage,
  abs(x.price - y.price) * least(x.volume, y.volume) AS potential_profit, CAST(x.timestamp AS DATE) AS data_date
  FROM b x JOIN b y ON x.symbol = y.symbol AND x.timestamp = y.timestamp AND x.exchange < y.exchange
  WHERE abs(x.price - y.price) > 0)"""
HOUR = ARB.format(bucket="date_trunc('hour', ts)")
DAY = ARB.format(bucket="CAST(CAST(ts AS DATE) AS TIMESTAMP)")
MINUTE = ARB.format(bucket="date_trunc('minute', ts)")


@register("jn_01_arbitrage_hourly", f"WITH {HOUR} SELECT * FROM arb")
def _(t):
    return cross.arbitrage(t.ticks, "1 hour")


@register("jn_01_arbitrage_minute", f"WITH {MINUTE} SELECT * FROM arb")
def _(t):
    return cross.arbitrage(t.ticks)


@register("prj_22_best_arbitrage", f"WITH {DAY} SELECT * FROM arb WHERE spread_percentage > 1")
def _(t):
    return cross.best_arbitrage(cross.arbitrage(t.ticks, "1 day"), 1.0)


@register("win_16_arbitrage_durations", f"""WITH {DAY},
 o AS (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w = INTERVAL 1 DAY THEN 0 ELSE 1 END AS n FROM arb WHERE spread_percentage > 5
   WINDOW w AS (PARTITION BY symbol, exchange_1, exchange_2 ORDER BY timestamp)),
 r AS (SELECT *, sum(n) OVER (PARTITION BY symbol, exchange_1, exchange_2 ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT symbol, exchange_1, exchange_2, min(timestamp) AS opened_at, count(*) AS buckets, count(*) * 86400 AS opportunity_duration_seconds,
 max(spread_percentage) AS max_spread_percentage FROM r GROUP BY symbol, exchange_1, exchange_2, run""")
def _(t):
    return cross.arbitrage_durations(cross.arbitrage(t.ticks, "1 day"), 86400, 5.0)


VOLUMES = """v AS (SELECT data_date, CAST(sum(CASE WHEN left(symbol, 3) IN ('BTC','MBT') THEN volume END) AS BIGINT) AS btc_volume,
 CAST(sum(CASE WHEN left(symbol, 3) IN ('ETE','HTE','MTE') THEN volume END) AS BIGINT) AS eth_volume FROM ticks GROUP BY 1)"""


@register("jn_03_btc_eth_volumes", f"WITH {VOLUMES} SELECT * FROM v WHERE btc_volume IS NOT NULL AND eth_volume IS NOT NULL")
def _(t):
    return cross.root_daily_volumes(t.ticks)


@register("agg_36_volume_correlation", f"""WITH {VOLUMES}
SELECT corr(CAST(btc_volume AS DOUBLE), CAST(eth_volume AS DOUBLE)) AS correlation, count(*) AS days, min(data_date) AS first_day,
 max(data_date) AS last_day FROM v WHERE btc_volume IS NOT NULL AND eth_volume IS NOT NULL""")
def _(t):
    return cross.volume_correlation(cross.root_daily_volumes(t.ticks))


ASOF = """
SELECT x.exchange, x.symbol, x.ts, x.event_id, x.price, x.volume, q.ts AS quote_ts, q.bid_price AS quote_bid_price, q.ask_price AS quote_ask_price
FROM (SELECT * FROM ticks WHERE type = 'Trade') x ASOF LEFT JOIN (SELECT * FROM ticks WHERE type = 'Quote') q
 ON x.exchange = q.exchange AND x.symbol = q.symbol AND x.ts >= q.ts"""


@register("jn_08_trades_with_quotes", ASOF)
def _(t):
    return cross.trades_with_quotes(t.ticks)


@register("jn_08_trades_with_quotes_sliced", ASOF)
def _(t):
    """The path for a hot symbol, forced, with at least eight slices."""
    rows = min(SLICE_ROWS, t.ticks.count() // 8 + 1)
    return cross.trades_with_quotes(t.ticks, max_group_rows=0, slice_rows=rows)


@register("jn_12_agg_50_symbol_across_exchanges", """
SELECT e.exchange, count(x.event_id) AS trade_count, CAST(sum(x.volume) AS BIGINT) AS total_volume, avg(x.price) AS avg_price,
 min(x.price) AS min_price, max(x.price) AS max_price, count(x.event_id) > 0 AS has_data
FROM (VALUES ('LSE'), ('CME'), ('NYQ'), ('NSQ')) AS e(exchange) LEFT JOIN ticks x ON x.exchange = e.exchange AND x.symbol = 'BTCF25' GROUP BY 1""")
def _(t):
    return digest.symbol_across_exchanges(t.ticks, "BTCF25", exchanges=["LSE", "CME", "NYQ", "NSQ"])


# --- futures ------------------------------------------------------------------------

REQUESTS = """req AS (SELECT lower(left(symbol, 3)) AS product_type, 'November' AS start_month_name, CAST(min(year(data_date)) AS INT) AS start_year,
 CAST(least(count(DISTINCT symbol), 24) AS INT) AS num_futures FROM ticks GROUP BY 1)"""
CALENDAR = f"""{REQUESTS}, cal AS (SELECT req.*, 'ok' AS status, upper(product_type) AS symbol_prefix,
  CASE product_type WHEN 'btc' THEN 'standard' ELSE 'micro' END AS product_category, CAST(i + 1 AS INT) AS position,
  upper(product_type) || substring('FGHJKMNQUVXZ', CAST((10 + i) % 12 + 1 AS INT), 1) || CAST((start_year + (10 + i) // 12) % 10 AS VARCHAR) AS symbol,
  substring('FGHJKMNQUVXZ', CAST((10 + i) % 12 + 1 AS INT), 1) AS month_code, CAST((10 + i) % 12 + 1 AS INT) AS contract_month,
  CAST(start_year + (10 + i) // 12 AS INT) AS contract_year
  FROM req, range(24) AS r(i) WHERE i < num_futures AND product_type IN ('btc', 'mbt'))"""


def _calendar(t):
    requests = t.ticks.groupBy(F.lower(F.left("symbol", F.lit(3))).alias("product_type")).agg(
        F.lit("November").alias("start_month_name"), F.min(F.year("data_date")).alias("start_year"),
        F.least(F.count_distinct("symbol"), F.lit(24)).cast("int").alias("num_futures"))
    return futures.contract_calendar(requests)


@register("fut_01_contract_calendar", f"""WITH {CALENDAR} SELECT * FROM cal
UNION ALL SELECT req.*, 'work_in_progress', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM req WHERE product_type NOT IN ('btc', 'mbt')""")
def _(t):
    return _calendar(t)


@register("fut_02_quarterly_contracts", f"""WITH {CALENDAR}
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY product_type ORDER BY position) AS INT) AS quarter_rank FROM cal
 WHERE month_code IN ('H','M','U','Z')) WHERE quarter_rank <= 2""")
def _(t):
    return futures.quarterly_contracts(_calendar(t))


@register("fut_03_quarterly_activity", f"""WITH {CALENDAR},
 q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_type ORDER BY position) AS r FROM cal WHERE month_code IN ('H','M','U','Z')) WHERE r <= 4)
SELECT q.symbol_prefix AS contract_root, q.contract_month, q.contract_year, q.symbol, x.exchange, x.symbol AS stored_symbol,
 count(*) FILTER (type = 'Trade') AS trade_count, count(*) FILTER (type = 'Quote') AS quote_count,
 CAST(sum(CASE WHEN type = 'Trade' THEN volume END) AS BIGINT) AS trade_volume, avg(CASE WHEN type = 'Trade' THEN price END) AS avg_trade_price,
 avg(ask_price - bid_price) AS avg_spread
FROM q JOIN ticks x ON left(x.symbol, 4) = q.symbol_prefix || q.month_code AND CAST(right(x.symbol, 2) AS INT) + 2000 = q.contract_year
WHERE strftime(ts, '%H:%M:%S') >= '08:00:00' AND strftime(ts, '%H:%M:%S') < '17:00:00' GROUP BY 1, 2, 3, 4, 5, 6""")
def _(t):
    return futures.quarterly_activity(_calendar(t), t.ticks, 4)


@register("fut_04_category_dimension", """
WITH dim AS (SELECT category, description, unnest(syms) AS symbol FROM (VALUES
 ('bitcoin_futures', 'Bitcoin futures contracts', ['MBTF25','BTCF25','MBTG25','BTCG25']),
 ('ethereum_futures', 'Ethereum futures contracts', ['HTEF25','ETEF25','MTEF25','ETEG25']),
 ('crypto_futures', 'All cryptocurrency futures contracts', ['MBTF25','BTCF25','MBTG25','BTCG25','HTEF25','ETEF25','MTEF25','ETEG25']),
 ('micro_bitcoin', 'Micro Bitcoin futures (smaller contract sizes)', ['MBTF25','MBTG25']),
 ('standard_bitcoin', 'Standard Bitcoin futures (full contract sizes)', ['BTCF25','BTCG25']),
 ('micro_ethereum', 'Micro Ethereum futures (smaller contract sizes)', ['HTEF25','MTEF25']),
 ('standard_ethereum', 'Standard Ethereum futures (full contract sizes)', ['ETEF25','ETEG25'])) AS c(category, description, syms)),
 have AS (SELECT DISTINCT symbol FROM ticks WHERE exchange = 'CME')
SELECT category, description, count(*) AS symbol_count, count(have.symbol) AS traded_symbols FROM dim LEFT JOIN have ON have.symbol = dim.symbol GROUP BY 1, 2""")
def _(t):
    from tickwell import dimensions
    dim = dimensions.category_dim(t.spark)
    wanted = sorted({s for c in dimensions.CATEGORIES.values() for s in c["symbols"]})
    have = t.ticks.where(F.col("symbol").isin(wanted)).select("exchange", "symbol").distinct().withColumn("traded", F.lit(1))
    return dim.join(have, ["exchange", "symbol"], "left").groupBy("category", "description").agg(
        F.count("*").alias("symbol_count"), F.count("traded").alias("traded_symbols"))


@register("fut_05_contract_directory", """
SELECT exchange, symbol, count(*) AS record_count, min(data_date) AS first_seen, max(data_date) AS last_seen, left(symbol, 3) AS contract_root,
 CAST(strpos('FGHJKMNQUVXZ', substring(symbol, 4, 1)) AS INT) AS contract_month, CAST(2000 + CAST(right(symbol, 2) AS INT) AS INT) AS contract_year,
 substring(symbol, 4, 1) IN ('H','M','U','Z') AS is_quarterly FROM ticks GROUP BY 1, 2""")
def _(t):
    return futures.contract_directory(t.ticks)


@register("agg_35_unique_futures", "SELECT count(DISTINCT symbol) AS unique_futures FROM ticks WHERE exchange = 'CME' AND data_date >= DATE '2024-01-10'")
def _(t):
    return futures.unique_futures(t.ticks, "CME", "2024-01-10")


@register("agg_35_unique_futures_detail", """
SELECT symbol, count(*) AS record_count, min(data_date) AS first_seen, max(data_date) AS last_seen FROM ticks GROUP BY 1""")
def _(t):
    return futures.unique_futures(t.ticks, detail=True)
