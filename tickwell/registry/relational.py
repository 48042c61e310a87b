"""Scans, projections, plain aggregates, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwell import dimensions
from tickwell.binding import TICKS_AS_OF, TRADES_AS_OF
from tickwell.operators import activity, bars, filters, sets
from tickwell.plans import medallion
from tickwell.registry import register

DAY = "2024-01-15"

# --- projections and filters -------------------------------------------------


@register("prj_01_time_range", """
SELECT event_id, exchange, symbol, ts, data_date, type, price, volume FROM ticks
WHERE data_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND exchange = 'CME'
ORDER BY data_date, ts, event_id LIMIT 1000""")
def _(t):
    return filters.time_range(t.ticks, "2024-01-05", "2024-01-20", "CME").select(
        "event_id", "exchange", "symbol", "ts", "data_date", "type", "price", "volume")


@register("prj_02_time_range_symbol", """
SELECT event_id, exchange, symbol, ts, price FROM ticks
WHERE data_date BETWEEN DATE '2024-01-02' AND DATE '2024-01-29' AND symbol = 'BTCF25'
ORDER BY data_date, ts, event_id LIMIT 1000""")
def _(t):
    return filters.time_range(t.ticks, "2024-01-02", "2024-01-29", symbol="BTCF25").select(
        "event_id", "exchange", "symbol", "ts", "price")


@register("prj_03_vendor_columns", """
SELECT symbol AS symbol, ts, type, price, volume, ts AS exchange_time, 'q' || type AS qualifiers FROM ticks""")
def _(t):
    vendor = t.ticks.select(
        F.col("symbol").alias("#RIC"), F.col("ts").alias("Date-Time"), F.col("type").alias("Type"),
        F.col("price").alias("Price"), F.col("volume").alias("Volume"),
        F.col("exchange_time").alias("Exch Time"), F.concat(F.lit("q"), "type").alias("Qualifiers"))
    return filters.rename_vendor_columns(vendor)


@register("prj_04_symbol_in_list", """
SELECT exchange, symbol, count(*) AS n FROM ticks
WHERE symbol IN ('MBTF25','BTCF25','MBTG25','BTCG25') GROUP BY 1, 2""")
def _(t):
    picked = filters.symbols_in(t.ticks, dimensions.category_symbols("bitcoin_futures"))
    return picked.groupBy("exchange", "symbol").agg(F.count("*").alias("n"))


@register("prj_12_last_days", """
SELECT exchange, count(*) AS n, min(data_date) AS first_day FROM ticks
WHERE data_date >= DATE '2024-01-31' - 7 GROUP BY 1""")
def _(t):
    return filters.last_days(t.ticks, 7, TICKS_AS_OF).groupBy("exchange").agg(
        F.count("*").alias("n"), F.min("data_date").alias("first_day"))


@register("prj_13_positive_trades", """
SELECT event_id, symbol, price, volume FROM ticks WHERE price > 0 AND volume > 0""")
def _(t):
    return filters.positive_trades(t.ticks).select("event_id", "symbol", "price", "volume")


@register("prj_14_spread", """
SELECT event_id, symbol, ask_price - bid_price AS spread FROM ticks WHERE type = 'Quote'""")
def _(t):
    return filters.with_spread(filters.quotes(t.ticks)).select("event_id", "symbol", "spread")


@register("prj_18_session", """
SELECT 'day' AS session_name, exchange, count(*) AS n FROM ticks
WHERE strftime(ts, '%H:%M:%S') >= '08:00:00' AND strftime(ts, '%H:%M:%S') < '17:00:00' GROUP BY 2
UNION ALL
SELECT 'overnight', exchange, count(*) FROM ticks
WHERE strftime(ts, '%H:%M:%S') >= '17:00:00' OR strftime(ts, '%H:%M:%S') < '16:15:00' GROUP BY 2""")
def _(t):
    def count(name, cond):
        return t.ticks.where(cond).groupBy("exchange").agg(F.count("*").alias("n")).withColumn("session_name", F.lit(name))
    return count("day", filters.in_session()).unionByName(count("overnight", filters.in_session("17:00", "16:15")))


@register("prj_18_exchange_hours", """
SELECT exchange, symbol, count(*) AS n FROM (SELECT *, strftime(ts, '%H:%M') AS hm FROM ticks)
WHERE (exchange = 'LSE' AND hm >= '08:00' AND hm < '16:30')
   OR (exchange = 'CME' AND (hm >= '17:00' OR hm < '16:15'))
   OR (exchange = 'NYQ' AND hm >= '09:30' AND hm < '16:00')
GROUP BY 1, 2""")
def _(t):
    return filters.in_exchange_hours(t.ticks).groupBy("exchange", "symbol").agg(F.count("*").alias("n"))


@register("prj_19_to_utc", """
SELECT event_id, exchange, ts,
       ts + to_hours(CASE exchange WHEN 'CME' THEN 6 WHEN 'NYQ' THEN 5 ELSE 0 END) AS ts_utc FROM ticks""")
def _(t):
    return filters.to_utc(t.ticks).select("event_id", "exchange", "ts", "ts_utc")


@register("jn_04_exchange_metadata", """
SELECT exchange, full_name, timezone, currency, country, region, market_code, trading_hours, count(*) AS n
FROM ticks JOIN (VALUES
  ('LSE','London Stock Exchange','Europe/London','GBP','08:00-16:30','XLON','GB','Europe'),
  ('CME','Chicago Mercantile Exchange','America/Chicago','USD','17:00-16:15','XCME','US','Americas'),
  ('NYQ','New York Stock Exchange','America/New_York','USD','09:30-16:00','XNYS','US','Americas'))
  AS d(exchange, full_name, timezone, currency, trading_hours, market_code, country, region) USING (exchange)
GROUP BY ALL""")
def _(t):
    cols = ["exchange", "full_name", "timezone", "currency", "country", "region", "market_code", "trading_hours"]
    return filters.with_exchange_metadata(t.ticks).groupBy(*cols).agg(F.count("*").alias("n"))


@register("jn_09_category_ticks", """
SELECT event_id, exchange, symbol, ts FROM ticks WHERE exchange = 'CME' AND symbol IN
('MBTF25','BTCF25','MBTG25','BTCG25','HTEF25','ETEF25','MTEF25','ETEG25')""")
def _(t):
    return activity.category_ticks(t.ticks).select("event_id", "exchange", "symbol", "ts")


# --- medallion ---------------------------------------------------------------

SILVER = """silver AS (SELECT data_date AS trade_date, price, yield_value,
  CASE WHEN price IS NOT NULL AND yield_value IS NOT NULL THEN 'VALID' ELSE 'INCOMPLETE' END AS data_quality_flag
  FROM ticks WHERE data_date IS NOT NULL AND data_date >= DATE '2020-01-01')"""
DAILY = """daily AS (SELECT trade_date, count(*) AS total_trades, avg(price) AS avg_price, min(price) AS min_price,
  max(price) AS max_price, stddev(price) AS price_volatility, avg(yield_value) AS avg_yield,
  min(yield_value) AS min_yield, max(yield_value) AS max_yield, stddev(yield_value) AS yield_volatility,
  count(*) FILTER (data_quality_flag = 'VALID') AS valid_trades,
  count(*) FILTER (data_quality_flag = 'INCOMPLETE') AS incomplete_trades,
  count(*) FILTER (data_quality_flag = 'VALID') * CAST(100 AS DOUBLE) / count(*) AS data_quality_pct
  FROM silver GROUP BY trade_date)"""


@register("agg_03_bronze_checks", """
SELECT count(*) AS total_records, count(DISTINCT exchange || '-' || CAST(data_date AS VARCHAR)) AS unique_files,
 min(data_date) AS min_date, max(data_date) AS max_date, count(*) FILTER (data_date IS NULL) AS null_dates FROM ticks""")
def _(t):
    return medallion.bronze_checks(t.ticks.withColumn("source_file", F.concat_ws("-", "exchange", "data_date")))


@register("prj_05_07_silver", f"WITH {SILVER} SELECT * FROM silver")
def _(t):
    text = t.ticks.withColumn("price", F.col("price").cast("string"))
    return medallion.to_silver(text)


@register("prj_06_raw_flag", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE price END AS price,
       CASE WHEN event_id % 5 = 0 OR price IS NOT NULL THEN 'VALID' ELSE 'INCOMPLETE' END AS flag FROM ticks""")
def _(t):
    dirty = t.ticks.withColumn(
        "price", F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("price").cast("string")))
    return dirty.select("event_id", filters.safe_double("price").alias("price"),
                        filters.completeness_flag("price").alias("flag"))


@register("agg_04_silver_checks", f"""WITH {SILVER}
SELECT count(*) AS total_records, count(*) FILTER (data_quality_flag='VALID') AS valid_records,
 count(*) FILTER (data_quality_flag='INCOMPLETE') AS incomplete_records,
 count(*) FILTER (data_quality_flag='INVALID') AS invalid_records,
 min(trade_date) AS min_date, max(trade_date) AS max_date FROM silver""")
def _(t):
    return medallion.silver_checks(medallion.to_silver(t.ticks))


@register("agg_05_win_03_flag_distribution", f"""WITH {SILVER}
SELECT data_quality_flag, count(*) AS record_count,
 count(*) * CAST(100 AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS percentage FROM silver GROUP BY 1""")
def _(t):
    return medallion.flag_distribution(medallion.to_silver(t.ticks))


@register("agg_06_daily_metrics", f"WITH {SILVER}, {DAILY} SELECT * FROM daily")
def _(t):
    return medallion.daily_metrics(medallion.to_silver(t.ticks))


@register("agg_06_daily_metrics_trades", """
SELECT data_date AS trade_date, count(*) AS total_trades, avg(price) AS avg_price, min(price) AS min_price,
 max(price) AS max_price, stddev(price) AS price_volatility FROM trades GROUP BY 1""")
def _(t):
    silver = medallion.to_silver(t.trades, "price", "turnover", floor="1995-01-01")
    return medallion.daily_metrics(silver).select(
        "trade_date", "total_trades", "avg_price", "min_price", "max_price", "price_volatility")


@register("agg_07_monthly_summary", f"""WITH {SILVER}, {DAILY}
SELECT CAST(date_trunc('month', trade_date) AS DATE) AS trade_month,
 CAST(sum(total_trades) AS BIGINT) AS monthly_total_trades, avg(avg_price) AS monthly_avg_price,
 avg(avg_yield) AS monthly_avg_yield, avg(data_quality_pct) AS monthly_avg_quality_pct,
 count(*) AS trading_days_in_month FROM daily GROUP BY 1""")
def _(t):
    return medallion.monthly_summary(medallion.daily_metrics(medallion.to_silver(t.ticks)))


@register("agg_08_quality_dashboard", f"""WITH {SILVER}, {DAILY}
SELECT 'Last 30 Days' AS period, count(*) AS trading_days, CAST(sum(total_trades) AS BIGINT) AS total_trades,
 CAST(sum(valid_trades) AS BIGINT) AS valid_trades, CAST(sum(incomplete_trades) AS BIGINT) AS incomplete_trades,
 avg(data_quality_pct) AS avg_quality_pct, min(trade_date) AS period_start, max(trade_date) AS period_end
FROM daily WHERE trade_date >= DATE '2024-01-31' - 30""")
def _(t):
    return medallion.quality_dashboard(medallion.daily_metrics(medallion.to_silver(t.ticks)), TICKS_AS_OF)


@register("agg_09_layer_counts", f"""WITH {SILVER}, {DAILY}
SELECT 'bronze' AS layer, count(*) AS record_count FROM ticks UNION ALL
SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold_daily', count(*) FROM daily UNION ALL
SELECT 'gold_monthly', count(DISTINCT date_trunc('month', trade_date)) FROM daily UNION ALL
SELECT 'gold_missing', NULL""")
def _(t):
    silver = medallion.to_silver(t.ticks)
    daily = medallion.daily_metrics(silver)
    return medallion.layer_counts({
        "bronze": t.ticks, "silver": silver, "gold_daily": daily,
        "gold_monthly": medallion.monthly_summary(daily), "gold_missing": None}, t.spark)


# --- activity ----------------------------------------------------------------


@register("agg_11_dataset_exchanges", """
SELECT exchange, count(*) AS record_count, min(data_date) AS earliest_date, max(data_date) AS latest_date,
 count(DISTINCT symbol) AS unique_symbols FROM ticks GROUP BY 1""")
def _(t):
    return activity.dataset_exchanges(t.ticks)


@register("agg_12_symbol_directory", """
SELECT symbol, count(*) AS trade_count, min(data_date) AS first_seen, max(data_date) AS last_seen,
 avg(price) AS avg_price, avg(volume) AS avg_volume FROM ticks
WHERE exchange = 'CME' AND data_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25' GROUP BY 1""")
def _(t):
    return activity.symbol_directory(t.ticks, "CME", "2024-01-03", "2024-01-25")


@register("agg_12_text_volume", """
SELECT symbol, count(*) AS trade_count, min(data_date) AS first_seen, max(data_date) AS last_seen,
 avg(price) AS avg_price, count(*) AS volume_records FROM ticks WHERE exchange = 'LSE' GROUP BY 1""")
def _(t):
    text = t.ticks.withColumn("volume", F.col("volume").cast("string"))
    return activity.symbol_directory(text, "LSE")


@register("agg_42_trading_calendar", """
SELECT exchange, data_date, count(*) AS trade_count, count(DISTINCT symbol) AS symbol_count FROM ticks GROUP BY 1, 2""")
def _(t):
    return activity.trading_calendar(t.ticks)


@register("agg_43_symbol_mapping", """
SELECT exchange, symbol, count(*) AS trade_count, min(data_date) AS first_seen, max(data_date) AS last_seen,
 avg(price) AS avg_price, CAST(sum(volume) AS BIGINT) AS total_volume FROM ticks GROUP BY 1, 2
ORDER BY total_volume DESC NULLS LAST, exchange, symbol LIMIT 1000""")
def _(t):
    return activity.symbol_mapping(t.ticks)


@register("agg_59_most_traded", """
SELECT symbol, count(*) AS trade_count, avg(price) AS avg_price, CAST(sum(volume) AS BIGINT) AS total_volume
FROM ticks WHERE price > 0 AND volume > 0 GROUP BY 1 ORDER BY trade_count DESC, symbol LIMIT 5""")
def _(t):
    return activity.most_traded(t.ticks)


@register("agg_60_exchange_counts", """
SELECT exchange, count(DISTINCT symbol) AS unique_symbols, count(*) AS record_count FROM ticks GROUP BY 1""")
def _(t):
    return activity.exchange_counts(t.ticks)


@register("agg_61_average_prices", """
SELECT exchange, symbol, avg(price) AS avg_price FROM trades
WHERE data_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY 1, 2""")
def _(t):
    return activity.average_prices(t.trades, "1996-01-01", "1998-12-31")


@register("agg_62_totals", """
SELECT count(*) AS total_records, count(DISTINCT exchange || '-' || CAST(data_date AS VARCHAR)) AS unique_files FROM trades""")
def _(t):
    return t.trades.agg(F.count("*").alias("total_records"),
                        F.count_distinct(F.concat_ws("-", "exchange", "data_date")).alias("unique_files"))


@register("agg_40_category_members", """
WITH dim AS (SELECT category, unnest(syms) AS symbol, 'CME' AS exchange FROM (VALUES
 ('bitcoin_futures', ['MBTF25','BTCF25','MBTG25','BTCG25']),
 ('ethereum_futures', ['HTEF25','ETEF25','MTEF25','ETEG25']),
 ('crypto_futures', ['MBTF25','BTCF25','MBTG25','BTCG25','HTEF25','ETEF25','MTEF25','ETEG25']),
 ('micro_bitcoin', ['MBTF25','MBTG25']), ('standard_bitcoin', ['BTCF25','BTCG25']),
 ('micro_ethereum', ['HTEF25','MTEF25']), ('standard_ethereum', ['ETEF25','ETEG25'])) AS c(category, syms))
SELECT d.exchange, d.symbol, d.category, count(x.event_id) AS trade_count, min(x.data_date) AS first_seen,
 max(x.data_date) AS last_seen, avg(x.price) AS avg_price, avg(x.volume) AS avg_volume
FROM dim d LEFT JOIN (SELECT * FROM ticks WHERE data_date = DATE '2024-01-15') x
  ON x.exchange = d.exchange AND x.symbol = d.symbol GROUP BY 1, 2, 3""")
def _(t):
    return activity.category_members(t.ticks, DAY)


CATEGORY_SQL = """
WITH s AS (SELECT symbol, count(*) AS n, sum(volume) AS v, sum(price * volume) AS pv,
                  sum(CASE WHEN price IS NOT NULL THEN volume END) AS w
           FROM ticks WHERE exchange = 'CME' AND symbol IN ({symbols}) {day} GROUP BY 1)
SELECT symbol, CAST({size} AS BIGINT) AS symbols_in_category, CAST(1 AS BIGINT) AS symbols_active, n AS trade_count,
 CAST(v AS BIGINT) AS total_volume, pv / nullif(w, 0) AS weighted_avg_price FROM s
UNION ALL
SELECT 'TOTAL', CAST({size} AS BIGINT), count(*), coalesce(CAST(sum(n) AS BIGINT), 0), CAST(sum(v) AS BIGINT),
 sum(pv) / nullif(sum(w), 0) FROM s"""


@register("agg_41_category_volume", CATEGORY_SQL.format(
    symbols="'MBTF25','BTCF25','MBTG25','BTCG25'", size=4, day=""))
def _(t):
    return activity.category_volume(t.ticks, "bitcoin_futures", "CME")


@register("agg_41_category_volume_day", CATEGORY_SQL.format(
    symbols="'MBTF25','BTCF25','MBTG25','BTCG25','HTEF25','ETEF25','MTEF25','ETEG25'", size=8,
    day="AND data_date = DATE '2024-01-15'"))
def _(t):
    return activity.category_volume(t.ticks, "crypto_futures", "CME", DAY)


LATEST = """latest AS (SELECT * FROM ticks WHERE data_date >= DATE '2024-01-31' - 7
  QUALIFY row_number() OVER (PARTITION BY exchange, symbol ORDER BY exchange_time DESC, event_id DESC) = 1)"""


@register("win_01_latest", f"WITH {LATEST} SELECT * FROM latest")
def _(t):
    return activity.latest_per_symbol(filters.last_days(t.ticks, 7, TICKS_AS_OF))


@register("agg_47_cross_exchange_prices", f"""WITH {LATEST}
SELECT symbol, max(price) FILTER (exchange='LSE') AS lse_price, max(price) FILTER (exchange='CME') AS cme_price,
 max(price) FILTER (exchange='NYQ') AS nyq_price, max(exchange_time) AS latest_time, DATE '2024-01-31' AS data_date
FROM latest GROUP BY symbol""")
def _(t):
    latest = activity.latest_per_symbol(filters.last_days(t.ticks, 7, TICKS_AS_OF))
    return activity.cross_exchange_prices(latest, TICKS_AS_OF)


# --- top-k -------------------------------------------------------------------

ACTIVE = """a AS (SELECT symbol, avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price,
  count(*) AS trade_count, CAST(sum(volume) AS BIGINT) AS total_volume FROM ticks
  WHERE data_date = DATE '2024-01-15' {extra} GROUP BY 1)"""


@register("top_01_most_active", "WITH " + ACTIVE.format(extra="AND exchange = 'CME'") + """
SELECT * FROM a ORDER BY total_volume DESC NULLS LAST, symbol LIMIT 10""")
def _(t):
    return activity.most_active(t.ticks, DAY, "CME", "volume")


@register("top_02_least_active", "WITH " + ACTIVE.format(extra="AND exchange = 'NYQ'") + """
SELECT * FROM a ORDER BY trade_count, symbol LIMIT 10""")
def _(t):
    return activity.least_active(t.ticks, DAY, "NYQ", "trade_count")


@register("top_03_text_volume_fallback", "WITH " + ACTIVE.format(extra="AND exchange = 'LSE'") + """
SELECT symbol, avg_price, min_price, max_price, trade_count FROM a ORDER BY trade_count DESC, symbol LIMIT 10""")
def _(t):
    text = t.ticks.withColumn("volume", F.col("volume").cast("string"))
    return activity.most_active(text, DAY, "LSE", "volume")


@register("top_04_both_ends", "WITH " + ACTIVE.format(extra="") + """
SELECT * FROM (SELECT *, 'most' AS side FROM a ORDER BY trade_count DESC, symbol LIMIT 5)
UNION ALL SELECT * FROM (SELECT *, 'least' AS side FROM a ORDER BY trade_count, symbol LIMIT 5)""")
def _(t):
    return activity.activity_extremes(t.ticks, DAY, limit=10)


@register("agg_49_daily_digest", "WITH " + ACTIVE.format(extra="AND exchange = 'CME'") + """
SELECT * FROM (SELECT *, 'most' AS side FROM a ORDER BY total_volume DESC NULLS LAST, symbol LIMIT 10)
UNION ALL SELECT * FROM (SELECT *, 'least' AS side FROM a ORDER BY total_volume ASC NULLS LAST, symbol LIMIT 10)
UNION ALL SELECT NULL, avg(price), min(price), max(price), count(*), CAST(sum(volume) AS BIGINT), 'summary' FROM ticks
 WHERE data_date = DATE '2024-01-15' AND exchange = 'CME'""")
def _(t):
    from tickwell.plans import digest
    return digest.daily_digest(t.ticks, DAY, "CME", 10)


@register("top_08_leaders_per_day", """
SELECT * FROM (SELECT data_date, symbol, CAST(sum(volume) AS BIGINT) AS total_volume,
  CAST(row_number() OVER (PARTITION BY data_date ORDER BY sum(volume) DESC NULLS LAST, symbol) AS INT) AS position
  FROM ticks GROUP BY 1, 2) WHERE position <= 3""")
def _(t):
    return activity.leaders_per_day(t.ticks, 3)


@register("top_06_export_order", """
SELECT data_date, symbol, ts, price, volume FROM ticks ORDER BY data_date, symbol, ts""")
def _(t):
    return sets.export_order(t.ticks).select("data_date", "symbol", "ts", "price", "volume")


@register("top_05_sql_limit", """
SELECT exchange, symbol, data_date, count(*) AS n FROM ticks GROUP BY 1, 2, 3 ORDER BY 1, 2, 3 LIMIT 1000""")
def _(t):
    from tickwell.sources.tables import run_select
    t.ticks.createOrReplaceTempView("tickwell_ticks")
    return run_select(t.spark, """SELECT exchange, symbol, data_date, count(*) AS n FROM tickwell_ticks
                                  GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""", limit=1000)


@register("src_12_preview", "SELECT event_id, symbol, ts FROM ticks ORDER BY event_id LIMIT 5")
def _(t):
    from tickwell.sources.tables import preview
    return preview(t.ticks.select("event_id", "symbol", "ts").orderBy("event_id"))


# --- set operations ----------------------------------------------------------


def _by_exchange(t):
    return {e: t.ticks.where(F.col("exchange") == e).drop("exchange") for e in dimensions.LOADED_EXCHANGES}


@register("set_01_union_exchanges", "SELECT exchange, data_date, symbol FROM ticks")
def _(t):
    return sets.union_exchanges(_by_exchange(t)).select("exchange", "data_date", "symbol")


@register("set_02_exchange_totals", "SELECT exchange, count(*) AS total_records FROM ticks GROUP BY 1")
def _(t):
    return sets.union_exchanges(_by_exchange(t)).groupBy("exchange").agg(F.count("*").alias("total_records"))


@register("agg_29_data_summary", """
SELECT CASE WHEN grouping(exchange) = 1 THEN 'TOTAL' ELSE exchange END AS exchange, count(*) AS records,
 min(data_date) AS min_date, max(data_date) AS max_date FROM ticks GROUP BY ROLLUP(exchange)""")
def _(t):
    return sets.data_summary(t.ticks)


@register("agg_30_records_per_day", """
SELECT exchange, data_date, count(*) AS record_count FROM ticks WHERE data_date >= DATE '2024-01-31' - 30
GROUP BY 1, 2 ORDER BY data_date DESC, exchange LIMIT 100""")
def _(t):
    return sets.records_per_day(sets.union_exchanges(_by_exchange(t)), TICKS_AS_OF)


@register("set_05_distinct_rows", """
SELECT DISTINCT exchange, symbol, data_date, price, volume, turnover FROM (SELECT * FROM trades UNION ALL SELECT * FROM trades)""")
def _(t):
    six = t.trades.select("exchange", "symbol", "data_date", "price", "volume", "turnover")
    return sets.distinct_rows(six.unionAll(six))


@register("set_06_duplicate_count", """
WITH x AS (SELECT exchange, symbol, data_date, volume FROM trades)
SELECT (SELECT count(*) FROM x) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM x)) AS unique_rows,
 (SELECT count(*) FROM x) - (SELECT count(*) FROM (SELECT DISTINCT * FROM x)) AS duplicate_count""")
def _(t):
    return sets.duplicate_count(t.trades.select("exchange", "symbol", "data_date", "volume"))


@register("set_07_key_dedupe", """
SELECT exchange, symbol, data_date, price, volume, l_orderkey FROM trades
QUALIFY row_number() OVER (PARTITION BY exchange, symbol, data_date
  ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""")
def _(t):
    return sets.dedupe_by_key(
        t.trades, ["exchange", "symbol", "data_date"],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
    ).select("exchange", "symbol", "data_date", "price", "volume", "l_orderkey")


@register("set_04_unified", """
SELECT exchange, symbol, exchange_time, price, volume AS quantity, bid_price, ask_price, ask_price - bid_price AS spread,
 CAST(NULL AS DOUBLE) AS settlement_price,
 price IS NOT NULL AND price > 0 AND volume IS NOT NULL AND volume >= 0 AND symbol IS NOT NULL
   AND NOT coalesce(bid_price > ask_price, false) AS is_valid_trade,
 CASE WHEN price IS NULL OR price <= 0 THEN CAST(80 AS DOUBLE) ELSE CAST(100 AS DOUBLE) END AS quality_score,
 CASE WHEN price IS NULL THEN ['NULL_PRICE'] WHEN price <= 0 THEN ['BAD_PRICE'] ELSE CAST([] AS VARCHAR[]) END AS anomaly_flags,
 data_date FROM ticks""")
def _(t):
    lse = t.ticks.where("exchange = 'LSE'")
    cme = t.ticks.where("exchange = 'CME'").withColumn("settlement_price", F.lit(None).cast("double"))
    nyq = t.ticks.where("exchange = 'NYQ'")
    return sets.unify({"LSE": lse, "CME": cme, "NYQ": nyq}).select(
        "exchange", "symbol", "exchange_time", "price", "quantity", "bid_price", "ask_price", "spread",
        "settlement_price", "is_valid_trade", "quality_score", "anomaly_flags", "data_date")
