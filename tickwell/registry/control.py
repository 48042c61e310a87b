"""Load progress, statistics, errors and file sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwell.binding import LOADS_AS_OF
from tickwell.functions import scalar
from tickwell.operators import control
from tickwell.registry import register

NOW = "2001-08-02 00:00:00"
SEC = "((epoch_us(end_time) - epoch_us(start_time)) / CAST(1000000 AS DOUBLE))"
CNT = "count(*) FILTER (status = '{}')"
DONE, FAIL, RUN, SKIP = (CNT.format(s) for s in ("completed", "failed", "started", "skipped"))
PCT = "* CAST(100 AS DOUBLE) /"


# --- summaries ------------------------------------------------------------------


@register("agg_14_progress_summary", f"""
SELECT exchange, data_date, count(*) AS total_files, {DONE} AS completed_files, {FAIL} AS failed_files, {RUN} AS running_files,
 CAST(sum(records_loaded) AS BIGINT) AS total_records, min(data_date) AS start_date, max(data_date) AS end_date FROM load_log GROUP BY 1, 2""")
def _(t):
    return control.progress_summary(t.load_log)


@register("agg_14_overview", f"""
SELECT exchange, count(*) AS total_files, {DONE} AS completed_files, {FAIL} AS failed_files, {RUN} AS running_files,
 CAST(sum(records_loaded) AS BIGINT) AS total_records, min(data_date) AS start_date, max(data_date) AS end_date FROM load_log GROUP BY 1""")
def _(t):
    return control.progress_summary(t.load_log, keys=("exchange",))


DAILY = f"""daily AS (SELECT data_date AS stats_date, exchange, count(*) AS total_files, {DONE} AS successful_files,
 {FAIL} AS failed_files, CAST(sum(records_loaded) AS BIGINT) AS total_records, avg(records_loaded) AS avg_records_per_file,
 sum((epoch_us(coalesce(end_time, TIMESTAMP '{NOW}')) - epoch_us(start_time)) / CAST(1000000 AS DOUBLE)) AS total_processing_time_seconds,
 CAST(sum(file_size_bytes) AS BIGINT) AS total_file_size_bytes, avg(file_size_bytes) AS avg_file_size_bytes FROM load_log GROUP BY 1, 2)"""


def _daily(t):
    return control.daily_load_stats(t.load_log, NOW)


@register("agg_15_daily_load_stats", f"WITH {DAILY} SELECT * FROM daily")
def _(t):
    return _daily(t)


@register("agg_16_weekly_load_stats", f"""WITH {DAILY}
SELECT exchange, avg(total_files) AS avg_daily_files, avg(total_records) AS avg_daily_records,
 CAST(sum(total_files) AS BIGINT) AS total_files, CAST(sum(total_records) AS BIGINT) AS total_records,
 avg(total_processing_time_seconds) AS avg_processing_time_seconds, CAST(sum(total_file_size_bytes) AS BIGINT) AS total_file_size_bytes,
 DATE '2001-08-01' AS week_ending FROM daily WHERE stats_date BETWEEN DATE '2001-07-26' AND DATE '2001-08-01' GROUP BY 1""")
def _(t):
    return control.weekly_load_stats(_daily(t), "2001-08-01")


WEEKLY = f"""{DAILY}, weekly AS (SELECT exchange, stats_date AS week_ending, avg(total_files) OVER w AS avg_daily_files,
 avg(total_records) OVER w AS avg_daily_records, CAST(sum(total_files) OVER w AS BIGINT) AS total_files,
 CAST(sum(total_records) OVER w AS BIGINT) AS total_records, avg(total_processing_time_seconds) OVER w AS avg_processing_time_seconds
 FROM daily WINDOW w AS (PARTITION BY exchange ORDER BY stats_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW))"""


@register("win_14_rolling_load_stats", f"WITH {WEEKLY} SELECT * FROM weekly")
def _(t):
    return control.rolling_load_stats(_daily(t))


EXT = f"""l AS (SELECT *, {SEC} AS d, CASE WHEN status = 'completed' THEN records_loaded / nullif({SEC}, 0) END AS speed FROM load_log),
ext0 AS (SELECT data_date AS stats_date, exchange, count(*) AS total_files_processed, {DONE} AS total_files_completed,
 {FAIL} AS total_files_failed, {SKIP} AS total_files_skipped, {DONE} {PCT} count(*) AS completion_rate,
 CAST(sum(records_loaded + records_rejected) AS BIGINT) AS total_records_processed, CAST(sum(records_loaded) AS BIGINT) AS total_records_loaded,
 CAST(sum(records_rejected) AS BIGINT) AS total_records_rejected,
 CAST(sum(records_loaded) AS DOUBLE) * 100 / nullif(CAST(sum(records_loaded + records_rejected) AS DOUBLE), 0) AS data_quality_score,
 CAST(sum(records_rejected) AS DOUBLE) * 100 / nullif(CAST(sum(records_loaded + records_rejected) AS DOUBLE), 0) AS rejection_rate,
 avg(d) AS avg_processing_time_seconds, min(d) AS min_processing_time_seconds, max(d) AS max_processing_time_seconds,
 sum(d) AS total_processing_time_seconds, sum(d) / 3600 AS total_processing_duration_hours, avg(speed) AS avg_records_per_second,
 max(speed) AS peak_records_per_second, CAST(sum(file_size_bytes) AS BIGINT) AS total_data_volume_bytes,
 CAST(sum(CASE WHEN d IS NOT NULL THEN file_size_bytes END) AS DOUBLE) / nullif(sum(d), 0) AS avg_bytes_per_second,
 {FAIL} AS total_errors, {FAIL} {PCT} count(*) AS error_rate FROM l GROUP BY 1, 2),
tops AS (SELECT data_date AS stats_date, exchange, error_type AS top_error_type FROM l WHERE error_type IS NOT NULL GROUP BY 1, 2, 3
 QUALIFY row_number() OVER (PARTITION BY data_date, exchange ORDER BY count(*) DESC, error_type) = 1),
ext AS (SELECT ext0.*, top_error_type FROM ext0 LEFT JOIN tops USING (stats_date, exchange))"""


@register("agg_17_56_daily_stats", f"WITH {EXT} SELECT * FROM ext")
def _(t):
    return control.daily_stats(t.load_log)


@register("agg_18_progress_view", f"""
SELECT exchange, count(*) AS total_files, {CNT.format('queued')} AS queued_files, {RUN} AS processing_files, {DONE} AS completed_files,
 {FAIL} AS failed_files, {SKIP} AS skipped_files, CAST(sum(records_loaded) AS BIGINT) AS total_records_loaded,
 avg({SEC}) AS avg_processing_time, {DONE} {PCT} count(*) AS completion_percentage FROM load_log GROUP BY 1""")
def _(t):
    return control.progress_view(t.load_log)


ERR = """e AS (SELECT id AS progress_id, id AS file_id, error_type, error_message, end_time AS error_timestamp, resolved
 FROM load_log WHERE status = 'failed')"""


@register("agg_19_error_analysis", f"""WITH {ERR}
SELECT error_type, count(*) AS error_count, count(DISTINCT file_id) AS affected_files,
 avg(CASE WHEN resolved THEN CAST(1 AS DOUBLE) ELSE 0 END) AS resolution_rate, min(error_timestamp) AS first_occurrence,
 max(error_timestamp) AS last_occurrence FROM e GROUP BY 1""")
def _(t):
    return control.error_analysis(control.errors_of(t.load_log))


@register("agg_20_performance_by_day", f"""
SELECT CAST(start_time AS DATE) AS processing_date, exchange, count(*) AS files_processed, CAST(sum(records_loaded) AS BIGINT) AS total_records,
 avg({SEC}) AS avg_processing_time, avg(records_loaded / nullif({SEC}, 0)) AS avg_records_per_second,
 min({SEC}) AS min_processing_time, max({SEC}) AS max_processing_time FROM load_log
WHERE status = 'completed' AND end_time IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return control.performance_by_day(t.load_log)


@register("agg_21_errors_by_day", f"""WITH {ERR}
SELECT CAST(error_timestamp AS DATE) AS error_date, error_type, CAST(count(*) AS BIGINT) AS error_count, count(DISTINCT file_id) AS affected_files,
 array_to_string(list_sort(list_distinct(list(left(error_message, 100)))), '; ') AS sample_error_messages,
 avg(CASE WHEN resolved THEN CAST(1 AS DOUBLE) ELSE 0 END) AS resolution_rate FROM e
WHERE error_timestamp >= TIMESTAMP '2001-08-02' - INTERVAL 300 DAY GROUP BY 1, 2""")
def _(t):
    return control.errors_by_day(control.errors_of(t.load_log), LOADS_AS_OF, 300)


@register("agg_22_set_03_dashboard_totals", f"""WITH {EXT}
SELECT CASE WHEN grouping(exchange) = 1 THEN 'All Exchanges' ELSE exchange END AS exchange,
 CAST(sum(total_files_processed) AS BIGINT) AS total_files_processed, CAST(sum(total_files_completed) AS BIGINT) AS total_files_completed,
 CAST(sum(total_files_failed) AS BIGINT) AS total_files_failed, avg(completion_rate) AS avg_completion_rate,
 CAST(sum(total_records_processed) AS BIGINT) AS total_records_processed, avg(data_quality_score) AS avg_data_quality_score,
 avg(avg_records_per_second) AS avg_records_per_second, max(stats_date) AS last_updated_date
FROM ext WHERE stats_date >= DATE '2001-08-02' - 7 GROUP BY ROLLUP(exchange)""")
def _(t):
    return control.dashboard_totals(control.daily_stats(t.load_log), LOADS_AS_OF)


@register("agg_23_performance_by_exchange", f"""
SELECT exchange, avg(records_loaded) AS avg_records_per_file, avg({SEC}) AS avg_processing_time,
 max(records_loaded) AS max_records_per_file, min(records_loaded) AS min_records_per_file FROM load_log WHERE status = 'completed' GROUP BY 1""")
def _(t):
    return control.performance_by_exchange(t.load_log)


@register("agg_24_recent_performance", f"""
SELECT exchange, count(*) AS total_loads, avg(records_loaded) AS avg_records_per_load, CAST(sum(records_loaded) AS BIGINT) AS total_records,
 avg({SEC}) AS avg_duration_seconds FROM load_log WHERE status = 'completed' AND start_time >= TIMESTAMP '2001-07-26' GROUP BY 1""")
def _(t):
    return control.recent_performance(t.load_log, LOADS_AS_OF)


@register("agg_25_records_per_second", f"""
SELECT exchange, avg(records_loaded / nullif({SEC}, 0)) AS avg_records_per_second FROM load_log WHERE status = 'completed' GROUP BY 1""")
def _(t):
    return control.records_per_second(t.load_log)


@register("agg_26_errors_by_exchange", """
SELECT exchange, count(*) AS error_count, count(DISTINCT CAST(start_time AS DATE)) AS error_days FROM load_log WHERE status = 'failed' GROUP BY 1""")
def _(t):
    return control.errors_by_exchange(t.load_log)


@register("agg_27_top_errors", """
WITH x AS (SELECT exchange, error_message, count(*) AS error_count FROM load_log
  WHERE status = 'failed' AND start_time >= TIMESTAMP '2001-08-02' - INTERVAL 60 DAY GROUP BY 1, 2
  ORDER BY error_count DESC, exchange, error_message LIMIT 10)
SELECT *, CAST(sum(error_count) OVER () AS BIGINT) AS total_errors FROM x""")
def _(t):
    return control.top_errors(t.load_log, LOADS_AS_OF, 60)


@register("agg_28_activity_status", f"""
SELECT count(*) FILTER (start_time >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR) AS recent_activity, {RUN} AS running_count,
 bool_or(status = 'started') AS is_running FROM load_log""")
def _(t):
    return control.activity_status(t.load_log, NOW)


@register("agg_31_status_counts", "SELECT exchange, status, count(*) AS n FROM load_log GROUP BY 1, 2")
def _(t):
    return control.status_counts(t.load_log)


HOURLY = f"""h AS (SELECT date_trunc('hour', start_time) AS stats_hour, exchange, count(*) AS files_processed_this_hour,
 CAST(sum(records_loaded) AS BIGINT) AS records_processed_this_hour, avg({SEC}) AS avg_processing_time_seconds, {FAIL} AS errors_this_hour,
 CAST(sum(records_loaded) AS DOUBLE) / nullif(sum({SEC}), 0) AS current_throughput_per_second, {FAIL} {PCT} count(*) AS current_error_rate
 FROM load_log GROUP BY 1, 2)"""


@register("agg_53_win_13_hourly_stats", f"""WITH {HOURLY}
SELECT *, CAST(sum(files_processed_this_hour) OVER w AS BIGINT) AS cumulative_files_today,
 CAST(sum(records_processed_this_hour) OVER w AS BIGINT) AS cumulative_records_today,
 CAST(sum(errors_this_hour) OVER w AS BIGINT) AS cumulative_errors_today FROM h
WINDOW w AS (PARTITION BY exchange, CAST(stats_hour AS DATE) ORDER BY stats_hour ROWS UNBOUNDED PRECEDING)""")
def _(t):
    return control.hourly_stats(t.load_log)


def _window_sql(level, trunc, step, seconds):
    return f"""
SELECT '{level}' AS stat_level, exchange, w AS window_start, w + INTERVAL {step} AS window_end, files_total, files_completed, files_failed,
 files_processing, records_loaded, records_rejected, avg_duration_seconds, bytes_completed, percent_complete,
 files_completed * CAST(60 AS DOUBLE) / {seconds} AS files_per_minute, records_loaded / CAST({seconds} AS DOUBLE) AS records_per_second,
 bytes_completed / CAST({seconds} AS DOUBLE) AS bytes_per_second
FROM (SELECT {trunc} AS w, exchange, count(*) AS files_total, {DONE} AS files_completed, {FAIL} AS files_failed, {RUN} AS files_processing,
  CAST(sum(records_loaded) AS BIGINT) AS records_loaded, CAST(sum(records_rejected) AS BIGINT) AS records_rejected, avg({SEC}) AS avg_duration_seconds,
  CAST(sum(CASE WHEN status = 'completed' THEN file_size_bytes END) AS BIGINT) AS bytes_completed, {DONE} {PCT} count(*) AS percent_complete
  FROM load_log GROUP BY 1, 2)"""


@register("agg_54_window_stats_daily", _window_sql("daily", "CAST(CAST(start_time AS DATE) AS TIMESTAMP)", "1 DAY", 86400))
def _(t):
    return control.window_stats(t.load_log, "daily")


@register("agg_54_window_stats_hourly", _window_sql("hourly", "date_trunc('hour', start_time)", "1 HOUR", 3600))
def _(t):
    return control.window_stats(t.load_log, "hourly")


@register("agg_54_window_stats_real_time", _window_sql("real_time", "time_bucket(INTERVAL 30 SECOND, start_time)", "30 SECOND", 30))
def _(t):
    return control.window_stats(t.load_log, "real_time")


def _trend(col, better, worse, lower=False):
    up, down = (worse, better) if lower else (better, worse)
    now, prev = f"avg({col}) OVER w", f"avg({col}) OVER p"
    return (f"CASE WHEN ({now} - {prev}) / nullif(abs({prev}), 0) > 0.05 THEN '{up}' "
            f"WHEN ({now} - {prev}) / nullif(abs({prev}), 0) < -0.05 THEN '{down}' ELSE 'stable' END")


ROLLING = f"""{EXT}, r AS (SELECT exchange, stats_date AS window_end_date, CAST(stats_date - 6 AS DATE) AS window_start_date,
 avg(total_files_processed) OVER w AS avg_daily_files_processed, avg(total_records_processed) OVER w AS avg_daily_records_processed,
 avg(total_processing_duration_hours) OVER w AS avg_daily_processing_time_hours, avg(completion_rate) OVER w AS avg_completion_rate,
 avg(data_quality_score) OVER w AS avg_data_quality_score, CAST(sum(total_files_processed) OVER w AS BIGINT) AS total_files_processed,
 CAST(sum(total_records_processed) OVER w AS BIGINT) AS total_records_processed,
 sum(total_processing_duration_hours) OVER w AS total_processing_time_hours,
 CAST(sum(total_data_volume_bytes) OVER w AS DOUBLE) / 1073741824 AS total_data_volume_gb,
 {_trend('avg_processing_time_seconds', 'improving', 'degrading', True)} AS processing_time_trend,
 {_trend('avg_records_per_second', 'increasing', 'decreasing')} AS throughput_trend,
 {_trend('data_quality_score', 'improving', 'degrading')} AS quality_trend,
 var_samp(avg_processing_time_seconds) OVER w AS processing_time_variance, var_samp(avg_records_per_second) OVER w AS throughput_variance,
 var_samp(data_quality_score) OVER w AS quality_variance, max(avg_records_per_second) OVER w AS peak_daily_throughput,
 max(data_quality_score) OVER w AS best_daily_quality_score,
 greatest(CAST(0 AS DOUBLE), least(CAST(100 AS DOUBLE), 100 * (1 - stddev(total_processing_time_seconds) OVER w / nullif(avg(total_processing_time_seconds) OVER w, 0)))) AS processing_consistency_score
 FROM ext WINDOW w AS (PARTITION BY exchange ORDER BY stats_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
  p AS (PARTITION BY exchange ORDER BY stats_date RANGE BETWEEN INTERVAL 13 DAYS PRECEDING AND INTERVAL 7 DAYS PRECEDING))"""


@register("agg_55_win_15_rolling_stats", f"""WITH {ROLLING},
pk AS (SELECT r.exchange, r.window_end_date, first(e.stats_date ORDER BY e.avg_records_per_second DESC, e.stats_date) AS d
  FROM r JOIN ext e ON e.exchange = r.exchange AND e.stats_date BETWEEN r.window_start_date AND r.window_end_date
  WHERE e.avg_records_per_second IS NOT NULL GROUP BY 1, 2),
bq AS (SELECT r.exchange, r.window_end_date, first(e.stats_date ORDER BY e.data_quality_score DESC, e.stats_date) AS d
  FROM r JOIN ext e ON e.exchange = r.exchange AND e.stats_date BETWEEN r.window_start_date AND r.window_end_date
  WHERE e.data_quality_score IS NOT NULL GROUP BY 1, 2)
SELECT r.*, pk.d AS peak_daily_throughput_date, bq.d AS best_daily_quality_date FROM r
LEFT JOIN pk USING (exchange, window_end_date) LEFT JOIN bq USING (exchange, window_end_date)""")
def _(t):
    return control.rolling_stats(control.daily_stats(t.load_log))


@register("prj_26_weekly_trends", f"""WITH {ROLLING}
SELECT exchange, window_end_date, avg_daily_files_processed, avg_daily_records_processed, avg_completion_rate, avg_data_quality_score,
 processing_time_trend, throughput_trend, quality_trend, processing_consistency_score FROM r WHERE window_end_date >= DATE '2001-08-02' - 30""")
def _(t):
    return control.weekly_trends(control.rolling_stats(control.daily_stats(t.load_log)), LOADS_AS_OF)


@register("agg_57_file_sizes", """
SELECT exchange, count(*) AS file_count, avg(file_size_bytes) AS avg_size_bytes, min(file_size_bytes) AS min_size_bytes,
 max(file_size_bytes) AS max_size_bytes, avg(file_size_bytes) / 1048576 AS avg_size_mb FROM load_log GROUP BY 1""")
def _(t):
    return control.file_size_stats(t.load_log)


@register("agg_58_prj_16_performance_by_size", f"""
SELECT exchange, CASE WHEN file_size_bytes < 52428800 THEN 'small' WHEN file_size_bytes < 209715200 THEN 'medium' ELSE 'large' END AS size_category,
 count(*) AS file_count, avg(records_loaded) AS avg_records, avg({SEC}) AS avg_processing_seconds FROM load_log
WHERE status = 'completed' AND end_time IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return control.performance_by_size(t.load_log)


@register("agg_63_run_summary", f"""
SELECT exchange, count(*) AS files, {DONE} AS succeeded, {FAIL} AS failed, {SKIP} AS skipped, CAST(sum(records_loaded) AS BIGINT) AS records_loaded,
 min(data_date) AS first_date, max(data_date) AS last_date, count(DISTINCT data_date) AS date_count,
 CAST(sum(CASE WHEN end_time IS NOT NULL THEN records_loaded END) AS DOUBLE) / nullif(sum({SEC}), 0) AS records_per_second FROM load_log GROUP BY 1""")
def _(t):
    return control.run_summary(t.load_log)


@register("agg_67_completion_matrix", """
SELECT data_date, count(*) FILTER (exchange = 'LSE' AND status = 'completed') AS lse, count(*) FILTER (exchange = 'CME' AND status = 'completed') AS cme,
 count(*) FILTER (exchange = 'NYQ' AND status = 'completed') AS nyq FROM load_log GROUP BY 1""")
def _(t):
    return control.completion_matrix(t.load_log)


@register("agg_67_completion_percent", f"SELECT exchange, {DONE} {PCT} count(*) AS completion_pct FROM load_log GROUP BY 1")
def _(t):
    return control.completion_percent(t.load_log)


@register("win_04_volume_growth", f"""WITH {DAILY}, d AS (SELECT stats_date, CAST(sum(total_file_size_bytes) AS BIGINT) AS daily_total_bytes FROM daily GROUP BY 1),
 g AS (SELECT *, lag(daily_total_bytes) OVER (ORDER BY stats_date) AS prev_day_bytes FROM d)
SELECT *, (daily_total_bytes - prev_day_bytes) * CAST(100 AS DOUBLE) / prev_day_bytes AS growth_percentage FROM g ORDER BY stats_date DESC LIMIT 30""")
def _(t):
    return control.volume_growth(_daily(t))


# --- lists ----------------------------------------------------------------------


@register("prj_17_feed_health", """
WITH s AS (SELECT exchange, ['ingestion','normalization','transformation','extraction'][id % 4 + 1] AS processing_stage,
  max(data_date) AS last_processed_date, CAST(sum(records_loaded) AS BIGINT) AS records_processed, max(end_time) AS last_updated
  FROM load_log WHERE status = 'completed' GROUP BY 1, 2)
SELECT *, CAST(date_diff('day', last_processed_date, DATE '2001-08-02') AS INT) AS days_behind,
 CASE WHEN date_diff('day', last_processed_date, DATE '2001-08-02') <= 1 THEN 'HEALTHY'
      WHEN date_diff('day', last_processed_date, DATE '2001-08-02') <= 3 THEN 'WARNING' ELSE 'CRITICAL' END AS health_status FROM s""")
def _(t):
    stage = F.element_at(F.array(*[F.lit(s) for s in ("ingestion", "normalization", "transformation", "extraction")]),
                         (F.col("id") % 4 + 1).cast("int"))
    return control.feed_health(control.feed_state(t.load_log.withColumn("processing_stage", stage)), LOADS_AS_OF)


@register("prj_20_progress_list", f"""
SELECT id, exchange, data_date, status, records_loaded, start_time, end_time, error_message, {SEC} AS processing_time_seconds
FROM load_log ORDER BY start_time DESC, id DESC LIMIT 50""")
def _(t):
    return control.progress_list(t.load_log)


@register("prj_21_recent_failures", """
SELECT id, exchange, data_date, error_message, start_time FROM load_log WHERE status = 'failed' ORDER BY start_time DESC, id DESC LIMIT 20""")
def _(t):
    return control.recent_failures(t.load_log)


@register("prj_23_loading_status", """
SELECT id, exchange, data_date, status, records_loaded, CAST(date_diff('day', data_date, DATE '2001-08-02') AS INT) AS age_days
FROM load_log WHERE data_date >= DATE '2001-08-02' - 10 AND exchange = 'CME'""")
def _(t):
    return control.loading_status(t.load_log, "CME", 10, LOADS_AS_OF)


@register("prj_24_select_stats", f"WITH {DAILY} SELECT * FROM daily WHERE exchange = 'LSE' AND stats_date = DATE '2001-07-30'")
def _(t):
    return control.select_stats(_daily(t), "LSE", "2001-07-30")


@register("prj_25_newest_stats", f"""WITH {DAILY}
SELECT exchange, stats_date, total_files, successful_files, failed_files, total_records, round(avg_records_per_file, 0) AS avg_records_per_file,
 round(total_processing_time_seconds, 2) AS processing_time_seconds FROM daily ORDER BY stats_date DESC, exchange LIMIT 10""")
def _(t):
    return control.newest_stats(_daily(t))


@register("prj_25_chart_series", f"WITH {DAILY} SELECT stats_date, exchange, successful_files, failed_files, total_records FROM daily")
def _(t):
    return control.chart_series(_daily(t))


@register("prj_25_weekly_display", f"""WITH {WEEKLY}
SELECT exchange, week_ending, round(avg_daily_files, 1) AS avg_daily_files, round(avg_daily_records, 0) AS avg_daily_records, total_files, total_records,
 round(avg_processing_time_seconds, 2) AS avg_processing_time_seconds FROM weekly""")
def _(t):
    return control.weekly_display(control.rolling_load_stats(_daily(t)))


@register("prj_27_running_loads", "SELECT id, exchange, data_date, start_time FROM load_log WHERE status = 'started'")
def _(t):
    from tickwell.operators.filters import running_loads
    return running_loads(t.load_log).select("id", "exchange", "data_date", "start_time").orderBy(F.col("start_time").desc(), "id")


@register("prj_28_retryable", "SELECT id, exchange, data_date, id % 5 AS retry_count FROM load_log WHERE status = 'failed' AND id % 5 < 3")
def _(t):
    return control.retryable(t.load_log.withColumn("retry_count", F.col("id") % 5)).select("id", "exchange", "data_date", "retry_count")


@register("top_07_largest_files", """
SELECT id, exchange, data_date, file_size_bytes, file_size_bytes / CAST(1048576 AS DOUBLE) AS file_size_mb, records_loaded, status
FROM load_log ORDER BY file_size_bytes DESC, id LIMIT 10""")
def _(t):
    return control.largest_files(t.load_log)


# --- joins ----------------------------------------------------------------------


@register("jn_05_pending_files", """
WITH m AS (SELECT DISTINCT exchange, data_date FROM trades)
SELECT exchange, data_date FROM m WHERE NOT EXISTS (SELECT 1 FROM load_log l WHERE l.status = 'completed' AND l.exchange = m.exchange AND l.data_date = m.data_date)""")
def _(t):
    return control.pending_files(t.trades.select("exchange", "data_date").distinct(), t.load_log)


SHORT = "printf('%.1f', floor({0} * 10 + 0.5) / 10)"


@register("dsp_01_display", f"""
WITH v AS (SELECT file_size_bytes AS b, records_loaded AS n, epoch(end_time) - epoch(start_time) AS s FROM load_log)
SELECT CASE WHEN b >= 1000000000 THEN {SHORT.format('b / 1e9')} || 'B' WHEN b >= 1000000 THEN {SHORT.format('b / 1e6')} || 'M' ELSE {SHORT.format('b / 1e3')} || 'K' END AS size,
 CASE WHEN s >= 60 THEN {SHORT.format('s / 60')} || 'm' WHEN s IS NOT NULL THEN {SHORT.format('s')} || 's' END AS duration, count(*) AS loads
FROM v WHERE b >= 1000 GROUP BY 1, 2""")
def _(t):
    """Sizes and durations of loads as a dashboard shows them."""
    rows = t.load_log.where("file_size_bytes >= 1000")
    seconds = F.unix_micros(F.col("end_time").cast("timestamp")) / 1e6 - F.unix_micros(F.col("start_time").cast("timestamp")) / 1e6
    return rows.groupBy(scalar.short_number("file_size_bytes").alias("size"), scalar.short_duration(F.round(seconds, 3)).alias("duration")).agg(
        F.count("*").alias("loads"))


@register("ids_01_stable_ids", """
SELECT id, sha256(exchange || chr(31) || CAST(data_date AS VARCHAR) || chr(31) || coalesce(error_message, chr(0))) AS stable_id FROM load_log""")
def _(t):
    """Ids that a rerun gives again, null parts included."""
    return t.load_log.select("id", scalar.stable_id("exchange", "data_date", "error_message").alias("stable_id"))


@register("jsn_01_error_context", """
WITH e AS (SELECT id % 11 AS k, id % 5 AS h, id % 7 AS a FROM load_log WHERE status = 'failed'),
 c AS (SELECT CASE WHEN k = 0 OR a = 0 THEN NULL ELSE 'host' || h END AS context_value, CASE WHEN k = 0 THEN 1 ELSE 0 END AS broken FROM e)
SELECT context_value, count(*) AS error_count, CAST(sum(broken) AS BIGINT) AS without_context FROM c GROUP BY 1""")
def _(t):
    """Error contexts as VARIANT: some are no JSON, some lack the host."""
    i = F.col("progress_id")
    host = F.when(i % 7 == 0, F.lit("")).otherwise(F.format_string(', "host": "host%d"', i % 5))
    text = F.when(i % 11 == 0, F.lit("{broken")).otherwise(F.concat(F.lit('{"attempt": '), i.cast("string"), host, F.lit("}")))
    errors = control.with_context(control.errors_of(t.load_log).withColumn("additional_context", text))
    return control.errors_by_context(errors)


@register("jn_06_errors_with_progress", f"""WITH {ERR}
SELECT e.*, l.exchange, l.data_date, l.status, l.start_time FROM e LEFT JOIN load_log l ON l.id = e.progress_id""")
def _(t):
    return control.errors_with_progress(control.errors_of(t.load_log), t.load_log)


@register("jn_07_missing_days", """
WITH s AS (SELECT exchange, min(data_date) AS lo, max(data_date) AS hi FROM load_log GROUP BY 1),
 d AS (SELECT exchange, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS data_date FROM s)
SELECT exchange, data_date FROM d WHERE isodow(data_date) <= 5
 AND NOT EXISTS (SELECT 1 FROM load_log l WHERE l.status = 'completed' AND l.exchange = d.exchange AND l.data_date = d.data_date)""")
def _(t):
    return control.missing_days(t.load_log)


@register("jn_10_outlier_files", """
SELECT id, exchange, data_date, file_size_bytes FROM load_log
WHERE file_size_bytes > (SELECT avg(file_size_bytes) + 1.5 * stddev(file_size_bytes) FROM load_log)""")
def _(t):
    return control.outlier_files(t.load_log, 1.5).select("id", "exchange", "data_date", "file_size_bytes")


@register("jn_11_reconcile", """
WITH r AS (SELECT exchange, data_date, count(*) AS files, CAST(sum(records_loaded) AS BIGINT) AS reported_records FROM load_log GROUP BY 1, 2),
 c AS (SELECT exchange, data_date, count(*) AS counted_records FROM trades GROUP BY 1, 2)
SELECT exchange, data_date, files, reported_records, counted_records, coalesce(reported_records, 0) - coalesce(counted_records, 0) AS difference
FROM r FULL JOIN c USING (exchange, data_date)""")
def _(t):
    return control.reconcile(t.load_log, t.trades)


@register("anl_19_complete_days", """
SELECT data_date, count(DISTINCT exchange) AS exchange_count, count(*) AS record_count FROM trades GROUP BY 1""")
def _(t):
    return control.complete_days(t.trades)
