"""Cleaning, quality scores, profiles and outliers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tickwell.binding import TICKS_AS_OF, TRADES_AS_OF
from tickwell.operators import cleaning, control, outliers, profiling, quality, quantiles, sketches
from tickwell.registry import register
from tickwell.session import scratch_path
from tickwell.sinks import lake


@register("prj_08_standard_names", """
SELECT exchange AS trade_exchange, symbol AS "ric", price AS close_price FROM trades""")
def _(t):
    return cleaning.standard_names(t.trades.select(
        F.col("exchange").alias("Trade Exchange"), F.col("symbol").alias("RIC"), F.col("price").alias("Close-Price")))


@register("prj_09_missing_values", """
SELECT event_id, price, coalesce(volume, 0) AS volume FROM
 (SELECT event_id, price, CASE WHEN event_id % 4 <> 0 THEN volume END AS volume FROM ticks) WHERE price IS NOT NULL""")
def _(t):
    return cleaning.handle_missing(t.ticks.select(
        "event_id", "price", F.when(F.col("event_id") % 4 != 0, F.col("volume")).alias("volume")))


@register("prj_10_valid_ranges", """
SELECT event_id, price, volume, open_interest FROM
 (SELECT event_id, price, volume, volume - 5 AS open_interest FROM ticks)
WHERE price > 0 AND open_interest > 0 AND volume >= 0""")
def _(t):
    return cleaning.valid_ranges(t.ticks.select(
        "event_id", "price", "volume", (F.col("volume") - 5).alias("open_interest")))


@register("prj_11_clean_market_data", """
WITH d AS (SELECT DISTINCT symbol, data_date, price, coalesce(volume, 0) AS volume FROM ticks WHERE price IS NOT NULL)
SELECT (SELECT 2 * count(*) FROM ticks) AS original_count, count(*) AS cleaned_count,
 (SELECT 2 * count(*) FROM ticks) - count(*) AS removed_count FROM d WHERE price > 0 AND volume >= 0""")
def _(t):
    four = t.ticks.select("symbol", "data_date", "price", "volume")
    return cleaning.cleaning_counts(four.unionAll(four))


@register("prj_15_row_quality", """
WITH q AS (SELECT event_id, symbol, price, volume, bid_price, ask_price, list_filter([
  CASE WHEN price IS NULL THEN 'NULL_PRICE' END, CASE WHEN price <= 0 THEN 'BAD_PRICE' END,
  CASE WHEN volume IS NULL THEN 'NULL_VOLUME' END, CASE WHEN volume < 0 THEN 'BAD_VOLUME' END,
  CASE WHEN symbol IS NULL OR symbol = '' THEN 'NULL_SYMBOL' END,
  CASE WHEN bid_price > ask_price THEN 'CROSSED_QUOTE' END], lambda x: x IS NOT NULL) AS f FROM
  (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN '' ELSE symbol END AS symbol,
     CASE WHEN event_id % 13 = 0 THEN -price ELSE price END AS price,
     CASE WHEN event_id % 3 = 0 THEN volume - 50 END AS volume,
     CASE WHEN event_id % 5 = 0 THEN ask_price + 1 ELSE bid_price END AS bid_price, ask_price FROM ticks))
SELECT event_id, array_to_string(f, ',') AS flags, len(f) = 0 AS is_valid_trade,
 greatest(CAST(0 AS DOUBLE), CAST(100 - 20 * len(f) AS DOUBLE)) AS quality_score FROM q""")
def _(t):
    i = F.col("event_id")
    dirty = t.ticks.select(
        "event_id",
        F.when(i % 11 == 0, "").otherwise(F.col("symbol")).alias("symbol"),
        F.when(i % 13 == 0, -F.col("price")).otherwise(F.col("price")).alias("price"),
        F.when(i % 3 == 0, F.col("volume") - 50).alias("volume"),
        F.when(i % 5 == 0, F.col("ask_price") + 1).otherwise(F.col("bid_price")).alias("bid_price"),
        "ask_price")
    return quality.with_row_quality(dirty).select(
        "event_id", F.array_join("anomaly_flags", ",").alias("flags"), "is_valid_trade", "quality_score")


SCORES = """
WITH c AS (SELECT exchange, data_date, count(*) AS total_records,
   count(*) FILTER (price IS NULL) AS null_price_count, count(*) FILTER (volume IS NULL) AS null_volume_count,
   count(*) FILTER (symbol IS NULL OR symbol = '') AS null_symbol_count,
   count(*) FILTER (price <= 0) AS invalid_price_count, count(*) FILTER (volume < 0) AS invalid_volume_count,
   count(*) - count(DISTINCT s) AS duplicate_count FROM (SELECT x.*, x AS s FROM x) GROUP BY 1, 2),
 s AS (SELECT *, CAST(100 AS DOUBLE) * (total_records - null_price_count - null_volume_count - null_symbol_count) / total_records AS completeness_score,
   CAST(100 AS DOUBLE) * (total_records - invalid_price_count - invalid_volume_count) / total_records AS accuracy_score,
   CAST(100 AS DOUBLE) * (total_records - duplicate_count) / total_records AS consistency_score FROM c)
SELECT *, (completeness_score + accuracy_score + consistency_score) / 3 AS overall_quality_score FROM s"""


@register("agg_13_quality_scores", "WITH x AS (SELECT exchange, data_date, symbol, price, volume FROM ticks)," + SCORES.strip()[4:])
def _(t):
    return quality.quality_scores(t.ticks.select("exchange", "data_date", "symbol", "price", "volume"))


@register("agg_13_quality_scores_trades",
          "WITH x AS (SELECT exchange, data_date, symbol, round(price) AS price, volume FROM trades)," + SCORES.strip()[4:])
def _(t):
    return quality.quality_scores(t.trades.select(
        "exchange", "data_date", "symbol", F.round("price").alias("price"), "volume"))


@register("agg_44_null_report", """
SELECT exchange, count(*) AS record_count,
 count(*) FILTER (price IS NULL) * CAST(100 AS DOUBLE) / count(*) AS price_null_pct,
 count(*) FILTER (bid_price IS NULL) * CAST(100 AS DOUBLE) / count(*) AS bid_price_null_pct,
 count(*) FILTER (yield_value IS NULL) * CAST(100 AS DOUBLE) / count(*) AS yield_value_null_pct FROM ticks GROUP BY 1""")
def _(t):
    return quality.null_percentages(t.ticks, ["price", "bid_price", "yield_value"])


@register("agg_48_report_rows", """
SELECT exchange, data_date, 'daily' AS report_type, count(*) AS total_trades, CAST(sum(volume) AS BIGINT) AS total_volume,
 sum(price * volume) AS total_turnover, count(DISTINCT symbol) AS unique_symbols,
 count(*) FILTER (price IS NULL OR price <= 0) AS processing_errors,
 count(*) FILTER (price > 0) * CAST(100 AS DOUBLE) / count(*) AS data_quality_score FROM ticks GROUP BY 1, 2""")
def _(t):
    return quality.report_rows(t.ticks)


@register("agg_64_freshness", """
SELECT max(data_date) AS latest_date, CAST(date_diff('day', max(data_date), DATE '2001-11-05') AS INT) AS age_days,
 count(*) AS record_count FROM trades""")
def _(t):
    return quality.freshness(t.trades, TRADES_AS_OF)


@register("agg_65_table_stats", """
SELECT count(*) AS row_count, CAST(5 AS INT) AS column_count,
 CAST(sum((price IS NULL)::INT + (bid_price IS NULL)::INT + (symbol IS NULL)::INT + (volume IS NULL)::INT + (exchange IS NULL)::INT) AS BIGINT) AS null_count,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT exchange, symbol, price, volume, bid_price FROM ticks)) AS duplicate_count
FROM ticks""")
def _(t):
    return quality.table_stats(t.ticks.select("exchange", "symbol", "price", "volume", "bid_price"))


@register("agg_66_quartiles", """
SELECT 'price' AS column_name, quantile_cont(CAST(price AS DOUBLE), 0.25) AS q25, quantile_cont(CAST(price AS DOUBLE), 0.5) AS q50,
 quantile_cont(CAST(price AS DOUBLE), 0.75) AS q75 FROM trades
UNION ALL SELECT 'volume', quantile_cont(CAST(volume AS DOUBLE), 0.25), quantile_cont(CAST(volume AS DOUBLE), 0.5),
 quantile_cont(CAST(volume AS DOUBLE), 0.75) FROM trades""")
def _(t):
    return quantiles.quartiles(t.trades, ["price", "volume"])


# --- profiles ------------------------------------------------------------------


@register("prf_01_nulls", """
WITH n AS (SELECT count(*) AS r, count(*) FILTER (price IS NULL) AS p, count(*) FILTER (bid_price IS NULL) AS b,
  count(*) FILTER (ask_price IS NULL) AS a, count(*) FILTER (yield_value IS NULL) AS y FROM ticks)
SELECT column_name, null_count, null_count * CAST(100 AS DOUBLE) / r AS null_pct, p + b + a + y AS total_nulls FROM
 (SELECT *, unnest(['price','bid_price','ask_price','yield_value']) AS column_name, unnest([p, b, a, y]) AS null_count FROM n)
WHERE null_count > 0""")
def _(t):
    return profiling.null_profile(t.ticks)


@register("prf_02_duplicates", """
WITH x AS (SELECT exchange, symbol, data_date, volume FROM trades), d AS (SELECT count(*) AS u FROM (SELECT DISTINCT * FROM x))
SELECT count(*) - max(u) AS total_duplicates, (count(*) - max(u)) * CAST(100 AS DOUBLE) / count(*) AS duplicate_percentage,
 max(u) AS unique_rows FROM x, d""")
def _(t):
    return profiling.duplicate_profile(t.trades.select("exchange", "symbol", "data_date", "volume"))


@register("prf_03_types", """
SELECT unnest(['symbol','price','volume','data_date']) AS column_name, unnest(['string','double','bigint','date']) AS data_type,
 unnest([count(symbol), count(price), count(volume), count(data_date)]) AS non_null_count,
 unnest([count(DISTINCT symbol), count(DISTINCT price), count(DISTINCT volume), count(DISTINCT data_date)]) AS unique_values FROM ticks""")
def _(t):
    return profiling.type_profile(t.ticks.select("symbol", "price", "volume", "data_date"))


@register("prf_04_numeric_ranges", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value,
 avg({c}) AS mean_value, stddev({c}) AS std_value, count(*) FILTER ({c} < 0) AS negative_values,
 count(*) FILTER ({c} = 0) AS zero_values FROM ticks""" for c in ("price", "volume", "bid_price")))
def _(t):
    return profiling.numeric_profile(t.ticks.select("symbol", "price", "volume", "bid_price"))


@register("prf_05_strings", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(DISTINCT {c}) AS unique_values, avg(length({c})) AS avg_length,
 CAST(max(length({c})) AS INT) AS max_length, count(*) FILTER ({c} = '') AS empty_strings,
 (SELECT list(v ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM documents WHERE {c} IS NOT NULL ORDER BY v LIMIT 5)) AS sample_values
FROM documents""" for c in ("text", "lang", "source")))
def _(t):
    return profiling.string_profile(t.read("documents").select("text", "lang", "source"))


@register("prf_06_report", """
WITH x AS (SELECT symbol, price FROM ticks), d AS (SELECT count(*) AS u FROM (SELECT DISTINCT * FROM x)),
a AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(max(u) AS DOUBLE) AS u, CAST(count(*) FILTER (price IS NULL) AS DOUBLE) AS pn,
  CAST(count(price) AS DOUBLE) AS pc, CAST(count(DISTINCT price) AS DOUBLE) AS pd, CAST(count(DISTINCT symbol) AS DOUBLE) AS sd,
  min(price) AS lo, max(price) AS hi, avg(price) AS m, stddev(price) AS s, CAST(count(*) FILTER (price < 0) AS DOUBLE) AS ng,
  CAST(count(*) FILTER (price = 0) AS DOUBLE) AS z, avg(length(symbol)) AS al, CAST(max(length(symbol)) AS DOUBLE) AS ml FROM x, d)
SELECT unnest(['table','table','table','table','table','null_values','null_values','null_values','null_values',
  'data_types','data_types','data_types','data_types','numeric_ranges','numeric_ranges','numeric_ranges','numeric_ranges',
  'numeric_ranges','numeric_ranges','string_patterns','string_patterns','string_patterns','string_patterns']) AS check_name,
 unnest([NULL,NULL,NULL,NULL,NULL,'symbol','symbol','price','price','symbol','symbol','price','price',
  'price','price','price','price','price','price','symbol','symbol','symbol','symbol']) AS column_name,
 unnest(['total_rows','total_columns','size_mb','total_duplicates','unique_rows','null_count','null_pct','null_count','null_pct',
  'non_null_count','unique_values','non_null_count','unique_values','min_value','max_value','mean_value','std_value',
  'negative_values','zero_values','unique_values','avg_length','max_length','empty_strings']) AS metric,
 unnest([n, CAST(2 AS DOUBLE), NULL, n - u, u, 0, 0, pn, 100 * pn / n, n, sd, pc, pd, lo, hi, m, s, ng, z, sd, al, ml, 0]) AS value
FROM a""")
def _(t):
    return profiling.quality_report(t.ticks.select("symbol", "price"))


@register("prf_07_type_summary", """
SELECT 'string' AS data_type, CAST(2 AS BIGINT) AS column_count, count(exchange) + count(symbol) AS non_null_count FROM ticks UNION ALL
SELECT 'double', 3, count(price) + count(bid_price) + count(yield_value) FROM ticks UNION ALL
SELECT 'bigint', 1, count(volume) FROM ticks""")
def _(t):
    return profiling.type_summary(t.ticks.select("exchange", "symbol", "price", "bid_price", "yield_value", "volume"))


@register("prf_08_outliers_iqr", """
WITH q AS (SELECT quantile_cont(CAST(price AS DOUBLE), 0.25) AS a, quantile_cont(CAST(price AS DOUBLE), 0.75) AS b,
  quantile_cont(CAST(volume AS DOUBLE), 0.25) AS va, quantile_cont(CAST(volume AS DOUBLE), 0.75) AS vb FROM ticks)
SELECT event_id, price, volume FROM ticks, q
WHERE NOT coalesce(price < a - 1.5 * (b - a) OR price > b + 1.5 * (b - a), false)
  AND NOT coalesce(volume < va - 1.5 * (vb - va) OR volume > vb + 1.5 * (vb - va), false)""")
def _(t):
    return outliers.detect_outliers(t.ticks.select("event_id", "price", "volume"), ["price", "volume", "missing"], "iqr")


@register("prf_09_outliers_zscore", """
WITH s AS (SELECT avg(price) AS m, stddev(price) AS d FROM ticks)
SELECT event_id, price, volume FROM ticks, s WHERE NOT coalesce(abs((price - m) / nullif(d, 0)) > 3, false)""")
def _(t):
    return outliers.detect_outliers(t.ticks.select("event_id", "price", "volume"), ["price"], "zscore")


@register("prf_10_named_checks", """
WITH c AS (SELECT count(*) AS n, count(*) FILTER (NOT coalesce(price > 0, false)) AS p,
  count(*) FILTER (NOT coalesce(volume >= 0, false)) AS v, count(*) FILTER (symbol IS NULL) AS s FROM ticks)
SELECT check_name, n AS records_checked, records_failed, records_failed * CAST(100 AS DOUBLE) / n AS failure_rate,
 CASE WHEN records_failed = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM
 (SELECT n, unnest(['price_positive','volume_not_negative','symbol_present']) AS check_name, unnest([p, v, s]) AS records_failed FROM c)""")
def _(t):
    return quality.named_checks(t.ticks, {
        "price_positive": F.col("price") > 0,
        "volume_not_negative": F.col("volume") >= 0,
        "symbol_present": F.col("symbol").isNotNull(),
    })


@register("prf_11_completeness", """
WITH have AS (SELECT DISTINCT exchange, data_date FROM load_log WHERE status = 'completed' AND isodow(data_date) <= 5),
 span AS (SELECT exchange, min(data_date) AS lo, max(data_date) AS hi FROM load_log GROUP BY 1),
 days AS (SELECT exchange, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
SELECT d.exchange, CAST(date_trunc('month', d.d) AS DATE) AS month, count(*) AS expected_days, count(h.data_date) AS loaded_days,
 count(h.data_date) * CAST(100 AS DOUBLE) / count(*) AS completeness_pct
FROM days d LEFT JOIN have h ON h.exchange = d.exchange AND h.data_date = d.d WHERE isodow(d.d) <= 5 GROUP BY 1, 2""")
def _(t):
    return control.monthly_completeness(t.load_log)


# --- anomalies -----------------------------------------------------------------


@register("agg_51_volume_anomalies", """
WITH p AS (SELECT exchange, data_date, symbol, CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS trade_count,
   stddev(price) AS price_volatility FROM ticks GROUP BY 1, 2, 3),
 b AS (SELECT exchange, data_date, avg(total_volume) AS mean_volume, stddev(total_volume) AS std_volume FROM p GROUP BY 1, 2),
 z AS (SELECT p.*, mean_volume, std_volume, (total_volume - mean_volume) / nullif(std_volume, 0) AS z_score FROM p JOIN b USING (exchange, data_date))
SELECT *, CAST(row_number() OVER (PARTITION BY exchange, data_date ORDER BY abs(z_score) DESC, symbol) AS INT) AS anomaly_rank
FROM z WHERE abs(z_score) >= 2""")
def _(t):
    return outliers.volume_anomalies(t.ticks, threshold=2.0)


@register("agg_52_win_18_volume_trend", """
WITH d AS (SELECT exchange, symbol, data_date, CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS trade_count FROM ticks
  WHERE data_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY 1, 2, 3),
 l AS (SELECT *, lag(total_volume) OVER (PARTITION BY exchange, symbol ORDER BY data_date) AS prev FROM d)
SELECT exchange, symbol, data_date, total_volume, trade_count, total_volume - prev AS volume_change,
 (total_volume - prev) * CAST(100 AS DOUBLE) / nullif(prev, 0) AS volume_change_pct,
 CAST(rank() OVER (PARTITION BY exchange, data_date ORDER BY total_volume DESC NULLS LAST) AS INT) AS day_rank FROM l""")
def _(t):
    return outliers.volume_trend(t.ticks, "2024-01-05", "2024-01-25")


# --- mergeable summaries -------------------------------------------------------------

SKETCHED = ["symbol", "price", "volume", "ts"]


def _sketches(t, name: str, build):
    path = scratch_path(t.spark, name)
    lake.write_partitions(build(t.ticks, ["data_date", "exchange"], SKETCHED if build is sketches.distinct_sketches else ["price", "volume"]), path, ("data_date",), ())
    return t.spark.read.parquet(path)


@register("prf_03_distinct_sketch", """
WITH t AS (SELECT * FROM ticks WHERE data_date >= DATE '2024-01-10')
SELECT u.exchange, u.column_name, u.row_count, u.non_null_count, true AS within_bound FROM (
 SELECT exchange, 'symbol' AS column_name, count(*) AS row_count, count(symbol) AS non_null_count FROM t GROUP BY 1
 UNION ALL SELECT exchange, 'price', count(*), count(price) FROM t GROUP BY 1
 UNION ALL SELECT exchange, 'volume', count(*), count(volume) FROM t GROUP BY 1
 UNION ALL SELECT exchange, 'ts', count(*), count(ts) FROM t GROUP BY 1) u""")
def _(t):
    """Distinct counts of a range of days from a table of sketches, held against the exact counts: within 4 % or 2."""
    days = F.col("data_date") >= F.lit("2024-01-10").cast("date")
    found = sketches.merged_distinct(_sketches(t, "distinct", sketches.distinct_sketches).where(days), ["exchange", "column_name"])
    exact = t.ticks.where(days).groupBy("exchange").agg(*[F.count_distinct(c).alias(c) for c in SKETCHED]).unpivot(
        "exchange", SKETCHED, "column_name", "exact")
    near = F.abs(F.col("unique_values") - F.col("exact")) <= F.greatest(F.lit(2.0), F.col("exact") * 0.04)
    return found.join(exact, ["exchange", "column_name"]).select("exchange", "column_name", "row_count", "non_null_count", near.alias("within_bound"))


@register("agg_66_quantile_sketch", """
WITH t AS (SELECT * FROM ticks WHERE data_date >= DATE '2024-01-10')
SELECT exchange, 'price' AS column_name, count(price) AS non_null_count, true AS within_bound FROM t GROUP BY 1
UNION ALL SELECT exchange, 'volume', count(volume), true FROM t GROUP BY 1""")
def _(t):
    """Quartiles of a range of days from a table of sketches; each one's rank is within 2 % of the one asked for."""
    days = F.col("data_date") >= F.lit("2024-01-10").cast("date")
    asked = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = sketches.merged_quantiles(_sketches(t, "quantiles", sketches.quantile_sketches).where(days), ["exchange", "column_name"], asked)
    values = t.ticks.where(days).select("exchange", F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume")).unpivot(
        "exchange", ["price", "volume"], "column_name", "value").where("value IS NOT NULL")
    ranks = values.join(F.broadcast(found), ["exchange", "column_name"]).groupBy("exchange", "column_name", "non_null_count").agg(*[
        x for n in asked for x in (F.avg((F.col("value") < F.col(n)).cast("double")).alias(f"{n}_low"), F.avg((F.col("value") <= F.col(n)).cast("double")).alias(f"{n}_high"))])
    near = reduce(lambda a, b: a & b, [(F.col(f"{n}_low") <= p + 0.02) & (F.col(f"{n}_high") >= p - 0.02) for n, p in asked.items()])
    return ranks.select("exchange", "column_name", "non_null_count", near.alias("within_bound"))
