"""Load progress, daily and rolling statistics, errors, reconciliation.

Inputs follow the load log: one row per file with ``id, exchange, data_date,
status, start_time, end_time, records_loaded, records_rejected,
file_size_bytes, error_type, error_message, resolved``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell import dimensions
from tickwell.functions.scalar import (
    count_where, days_behind, health_status, percent, ratio, seconds_between, size_bucket,
)
from tickwell.operators.filters import last_days

DURATION = "duration_seconds"


def status_is(*names: str) -> Column:
    return F.col("status").isin(*names)


def with_duration(loads: DataFrame, as_of=None) -> DataFrame:
    """Elapsed seconds; open loads are NULL, or run to ``as_of`` when given."""
    end = F.col("end_time")
    if as_of is not None:
        end = F.coalesce(end, F.lit(as_of).cast(loads.schema["end_time"].dataType))
    return loads.withColumn(DURATION, seconds_between("start_time", end))


def _status_counts(*pairs: tuple[str, tuple[str, ...]]) -> list[Column]:
    return [count_where(status_is(*names)).alias(alias) for alias, names in pairs]


# --- summaries ------------------------------------------------------------------


def progress_summary(loads: DataFrame, data_date: str | None = None,
                     keys: tuple[str, ...] = ("exchange", "data_date")) -> DataFrame:
    df = loads if data_date is None else loads.where(F.col("data_date") == F.lit(data_date).cast("date"))
    return df.groupBy(*keys).agg(
        F.count("*").alias("total_files"),
        *_status_counts(("completed_files", ("completed",)), ("failed_files", ("failed",)), ("running_files", ("started",))),
        F.coalesce(F.sum("records_loaded"), F.lit(0)).alias("total_records"),
        F.min("data_date").alias("start_date"),
        F.max("data_date").alias("end_date"),
    )


def progress_view(loads: DataFrame) -> DataFrame:
    """Every state of the life cycle per exchange, with completion percent."""
    done = count_where(status_is("completed"))
    return with_duration(loads).groupBy("exchange").agg(
        F.count("*").alias("total_files"),
        *_status_counts(
            ("queued_files", ("queued",)), ("processing_files", ("processing", "started")),
            ("completed_files", ("completed",)), ("failed_files", ("failed",)), ("skipped_files", ("skipped",))),
        F.sum("records_loaded").alias("total_records_loaded"),
        F.avg(DURATION).alias("avg_processing_time"),
        percent(done, F.count("*")).alias("completion_percentage"),
    )


def daily_load_stats(loads: DataFrame, as_of=None) -> DataFrame:
    """Files, records, seconds and sizes per day and exchange."""
    records = F.coalesce(F.col("records_loaded"), F.lit(0))
    return with_duration(loads, as_of).groupBy(F.col("data_date").alias("stats_date"), "exchange").agg(
        F.count("*").alias("total_files"),
        *_status_counts(("successful_files", ("completed",)), ("failed_files", ("failed",))),
        F.sum(records).alias("total_records"),
        F.avg(records).alias("avg_records_per_file"),
        F.sum(DURATION).alias("total_processing_time_seconds"),
        F.sum("file_size_bytes").alias("total_file_size_bytes"),
        F.avg("file_size_bytes").alias("avg_file_size_bytes"),
    )


def weekly_load_stats(daily: DataFrame, week_ending: str) -> DataFrame:
    """Averages and totals of the seven days that end at ``week_ending``."""
    end = F.lit(week_ending).cast("date")
    week = daily.where(F.col("stats_date").between(F.date_sub(end, 6), end))
    return week.groupBy("exchange").agg(
        F.avg("total_files").alias("avg_daily_files"),
        F.avg("total_records").alias("avg_daily_records"),
        F.sum("total_files").alias("total_files"),
        F.sum("total_records").alias("total_records"),
        F.avg("total_processing_time_seconds").alias("avg_processing_time_seconds"),
        F.sum("total_file_size_bytes").alias("total_file_size_bytes"),
    ).withColumn("week_ending", end)


def week_end(day: str | Column) -> Column:
    """The Sunday that ends the week of a day."""
    return F.next_day(F.date_sub(day, 1), "SUN")


def weeks_load_stats(daily: DataFrame) -> DataFrame:
    """The weekly statistics of every calendar week on record, Monday to Sunday, per exchange."""
    return daily.groupBy("exchange", week_end("stats_date").alias("week_ending")).agg(
        F.avg("total_files").alias("avg_daily_files"),
        F.avg("total_records").alias("avg_daily_records"),
        F.sum("total_files").alias("total_files"),
        F.sum("total_records").alias("total_records"),
        F.avg("total_processing_time_seconds").alias("avg_processing_time_seconds"),
        F.sum("total_file_size_bytes").alias("total_file_size_bytes"),
    )


def _days_window(first: int, last: int) -> Window:
    """Range of calendar days relative to the row's own day, per exchange."""
    return Window.partitionBy("exchange").orderBy(F.unix_date("stats_date")).rangeBetween(first, last)


def rolling_load_stats(daily: DataFrame) -> DataFrame:
    """The weekly statistics for every day on record (one row per day and exchange)."""
    w = _days_window(-6, 0)
    return daily.select(
        "exchange", F.col("stats_date").alias("week_ending"),
        F.avg("total_files").over(w).alias("avg_daily_files"),
        F.avg("total_records").over(w).alias("avg_daily_records"),
        F.sum("total_files").over(w).alias("total_files"),
        F.sum("total_records").over(w).alias("total_records"),
        F.avg("total_processing_time_seconds").over(w).alias("avg_processing_time_seconds"),
    )


def daily_stats(loads: DataFrame) -> DataFrame:
    """Extended daily statistics: rates, quality, throughput, bytes, top error."""
    loaded = F.coalesce(F.col("records_loaded"), F.lit(0))
    rejected = F.coalesce(F.col("records_rejected"), F.lit(0))
    speed = ratio(F.when(status_is("completed"), F.col("records_loaded")), DURATION)
    keyed = with_duration(loads).withColumnRenamed("data_date", "stats_date").withColumn("_speed", speed)
    stats = keyed.groupBy("stats_date", "exchange").agg(
        F.count("*").alias("total_files_processed"),
        *_status_counts(
            ("total_files_completed", ("completed",)), ("total_files_failed", ("failed",)),
            ("total_files_skipped", ("skipped",))),
        percent(count_where(status_is("completed")), F.count("*")).alias("completion_rate"),
        F.sum(loaded + rejected).alias("total_records_processed"),
        F.sum(loaded).alias("total_records_loaded"),
        F.sum(rejected).alias("total_records_rejected"),
        percent(F.sum(loaded), F.sum(loaded + rejected)).alias("data_quality_score"),
        percent(F.sum(rejected), F.sum(loaded + rejected)).alias("rejection_rate"),
        F.avg(DURATION).alias("avg_processing_time_seconds"),
        F.min(DURATION).alias("min_processing_time_seconds"),
        F.max(DURATION).alias("max_processing_time_seconds"),
        F.sum(DURATION).alias("total_processing_time_seconds"),
        (F.sum(DURATION) / 3600.0).alias("total_processing_duration_hours"),
        F.avg("_speed").alias("avg_records_per_second"),
        F.max("_speed").alias("peak_records_per_second"),
        F.sum("file_size_bytes").alias("total_data_volume_bytes"),
        ratio(F.sum(F.when(F.col(DURATION).isNotNull(), F.col("file_size_bytes"))), F.sum(DURATION)).alias("avg_bytes_per_second"),
        count_where(status_is("failed")).alias("total_errors"),
        percent(count_where(status_is("failed")), F.count("*")).alias("error_rate"),
    )
    by_type = keyed.where(F.col("error_type").isNotNull()).groupBy("stats_date", "exchange", "error_type").agg(F.count("*").alias("n"))
    top = by_type.groupBy("stats_date", "exchange").agg(
        F.min_by("error_type", F.struct(-F.col("n"), F.col("error_type"))).alias("top_error_type"))
    return stats.join(top, ["stats_date", "exchange"], "left")


def dashboard_totals(daily: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Per-exchange rows and an All Exchanges row from one rollup."""
    recent = last_days(daily, days, as_of, "stats_date")
    rolled = recent.rollup("exchange").agg(
        F.grouping("exchange").alias("_g"),
        F.sum("total_files_processed").alias("total_files_processed"),
        F.sum("total_files_completed").alias("total_files_completed"),
        F.sum("total_files_failed").alias("total_files_failed"),
        F.avg("completion_rate").alias("avg_completion_rate"),
        F.sum("total_records_processed").alias("total_records_processed"),
        F.avg("data_quality_score").alias("avg_data_quality_score"),
        F.avg("avg_records_per_second").alias("avg_records_per_second"),
        F.max("stats_date").alias("last_updated_date"),
    )
    label = F.when(F.col("_g") == 1, "All Exchanges").otherwise(F.col("exchange"))
    return rolled.withColumn("exchange", label).drop("_g")


def rolling_stats(daily: DataFrame) -> DataFrame:
    """Seven-day windows over the extended daily rows, with peaks and trends.

    The rows are one per exchange and day, so each window partition is bounded
    by the calendar whatever the size of the lake.
    """
    w, before = _days_window(-6, 0), _days_window(-13, -7)
    hours = F.col("total_processing_duration_hours")
    earliest = -F.unix_date("stats_date")

    def trend(column: str, better: str, worse: str, lower_is_better: bool = False) -> Column:
        now, prev = F.avg(column).over(w), F.avg(column).over(before)
        move = F.try_divide(now - prev, F.abs(prev))
        up, down = (worse, better) if lower_is_better else (better, worse)
        return F.when(move > 0.05, up).when(move < -0.05, down).otherwise("stable")

    spread = F.try_divide(F.stddev("total_processing_time_seconds").over(w), F.avg("total_processing_time_seconds").over(w))
    return daily.select(
        "exchange",
        F.col("stats_date").alias("window_end_date"),
        F.date_sub("stats_date", 6).alias("window_start_date"),
        F.avg("total_files_processed").over(w).alias("avg_daily_files_processed"),
        F.avg("total_records_processed").over(w).alias("avg_daily_records_processed"),
        F.avg(hours).over(w).alias("avg_daily_processing_time_hours"),
        F.avg("completion_rate").over(w).alias("avg_completion_rate"),
        F.avg("data_quality_score").over(w).alias("avg_data_quality_score"),
        F.sum("total_files_processed").over(w).alias("total_files_processed"),
        F.sum("total_records_processed").over(w).alias("total_records_processed"),
        F.sum(hours).over(w).alias("total_processing_time_hours"),
        (F.sum("total_data_volume_bytes").over(w) / F.lit(1024.0 ** 3)).alias("total_data_volume_gb"),
        trend("avg_processing_time_seconds", "improving", "degrading", lower_is_better=True).alias("processing_time_trend"),
        trend("avg_records_per_second", "increasing", "decreasing").alias("throughput_trend"),
        trend("data_quality_score", "improving", "degrading").alias("quality_trend"),
        F.var_samp("avg_processing_time_seconds").over(w).alias("processing_time_variance"),
        F.var_samp("avg_records_per_second").over(w).alias("throughput_variance"),
        F.var_samp("data_quality_score").over(w).alias("quality_variance"),
        F.max("avg_records_per_second").over(w).alias("peak_daily_throughput"),
        F.max_by("stats_date", F.when(F.col("avg_records_per_second").isNotNull(), F.struct("avg_records_per_second", earliest))).over(w).alias("peak_daily_throughput_date"),
        F.max("data_quality_score").over(w).alias("best_daily_quality_score"),
        F.max_by("stats_date", F.when(F.col("data_quality_score").isNotNull(), F.struct("data_quality_score", earliest))).over(w).alias("best_daily_quality_date"),
        F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100.0 * (1.0 - spread))).alias("processing_consistency_score"),
    )


def weekly_trends(rolling: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    return last_days(rolling, days, as_of, "window_end_date").select(
        "exchange", "window_end_date", "avg_daily_files_processed", "avg_daily_records_processed",
        "avg_completion_rate", "avg_data_quality_score", "processing_time_trend", "throughput_trend",
        "quality_trend", "processing_consistency_score",
    )


def hourly_stats(loads: DataFrame) -> DataFrame:
    """Files, records, errors and rates per hour, cumulated since midnight."""
    hourly = with_duration(loads).groupBy(F.window("start_time", "1 hour")["start"].alias("stats_hour"), "exchange").agg(
        F.count("*").alias("files_processed_this_hour"),
        F.sum("records_loaded").alias("records_processed_this_hour"),
        F.avg(DURATION).alias("avg_processing_time_seconds"),
        count_where(status_is("failed")).alias("errors_this_hour"),
        ratio(F.sum("records_loaded"), F.sum(DURATION)).alias("current_throughput_per_second"),
        percent(count_where(status_is("failed")), F.count("*")).alias("current_error_rate"),
    )
    today = (
        Window.partitionBy("exchange", F.to_date("stats_hour")).orderBy("stats_hour")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return hourly.select(
        "*",
        F.sum("files_processed_this_hour").over(today).alias("cumulative_files_today"),
        F.sum("records_processed_this_hour").over(today).alias("cumulative_records_today"),
        F.sum("errors_this_hour").over(today).alias("cumulative_errors_today"),
    )


# Statistic levels and the width of their windows.
LEVELS = {"real_time": "30 seconds", "hourly": "1 hour", "daily": "1 day"}


def window_stats(loads: DataFrame, level: str = "hourly", by_exchange: bool = True) -> DataFrame:
    """Throughput statistics of fixed windows at one of the named levels."""
    width = LEVELS.get(level, level)
    keys = ["exchange"] if by_exchange else []
    kind = loads.schema["start_time"].dataType
    span = F.window("start_time", width)
    out = with_duration(loads).groupBy(span.alias("w"), *keys).agg(
        F.count("*").alias("files_total"),
        *_status_counts(("files_completed", ("completed",)), ("files_failed", ("failed",)), ("files_processing", ("started", "processing"))),
        F.sum("records_loaded").alias("records_loaded"),
        F.sum("records_rejected").alias("records_rejected"),
        F.avg(DURATION).alias("avg_duration_seconds"),
        F.sum(F.when(status_is("completed"), F.col("file_size_bytes"))).alias("bytes_completed"),
        percent(count_where(status_is("completed")), F.count("*")).alias("percent_complete"),
    )
    seconds = seconds_between(F.col("w")["start"], F.col("w")["end"])
    return out.select(
        F.lit(level).alias("stat_level"), *keys,
        F.col("w")["start"].cast(kind).alias("window_start"), F.col("w")["end"].cast(kind).alias("window_end"),
        *[c for c in out.columns if c not in ("w", *keys)],
        (F.col("files_completed") * 60.0 / seconds).alias("files_per_minute"),
        (F.col("records_loaded") / seconds).alias("records_per_second"),
        (F.col("bytes_completed") / seconds).alias("bytes_per_second"),
    )


# --- performance ----------------------------------------------------------------


def performance_by_day(loads: DataFrame) -> DataFrame:
    """Finished loads per start day; the rate is the mean of per-file rates."""
    done = with_duration(loads).where(status_is("completed") & F.col("end_time").isNotNull())
    return done.groupBy(F.to_date("start_time").alias("processing_date"), "exchange").agg(
        F.count("*").alias("files_processed"),
        F.sum("records_loaded").alias("total_records"),
        F.avg(DURATION).alias("avg_processing_time"),
        F.avg(ratio("records_loaded", DURATION)).alias("avg_records_per_second"),
        F.min(DURATION).alias("min_processing_time"),
        F.max(DURATION).alias("max_processing_time"),
    )


def performance_by_exchange(loads: DataFrame) -> DataFrame:
    return with_duration(loads).where(status_is("completed")).groupBy("exchange").agg(
        F.avg("records_loaded").alias("avg_records_per_file"),
        F.avg(DURATION).alias("avg_processing_time"),
        F.max("records_loaded").alias("max_records_per_file"),
        F.min("records_loaded").alias("min_records_per_file"),
    )


def recent_performance(loads: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    done = last_days(loads, days, as_of, "start_time").where(status_is("completed"))
    return with_duration(done).groupBy("exchange").agg(
        F.count("*").alias("total_loads"),
        F.avg("records_loaded").alias("avg_records_per_load"),
        F.sum("records_loaded").alias("total_records"),
        F.avg(DURATION).alias("avg_duration_seconds"),
    )


def records_per_second(loads: DataFrame) -> DataFrame:
    done = with_duration(loads).where(status_is("completed"))
    return done.groupBy("exchange").agg(F.avg(ratio("records_loaded", DURATION)).alias("avg_records_per_second"))


def run_summary(results: DataFrame) -> DataFrame:
    """One row per exchange of a load run."""
    return with_duration(results).groupBy("exchange").agg(
        F.count("*").alias("files"),
        *_status_counts(("succeeded", ("completed",)), ("failed", ("failed",)), ("skipped", ("skipped",))),
        F.sum("records_loaded").alias("records_loaded"),
        F.min("data_date").alias("first_date"),
        F.max("data_date").alias("last_date"),
        F.count_distinct("data_date").alias("date_count"),
        ratio(F.sum(F.when(F.col(DURATION).isNotNull(), F.col("records_loaded"))), F.sum(DURATION)).alias("records_per_second"),
    )


def completion_matrix(loads: DataFrame, exchanges: list[str] | None = None) -> DataFrame:
    """Completed files: a row per day, a column per exchange, 0 when absent."""
    names = exchanges or dimensions.exchanges_of(loads)
    return loads.groupBy("data_date").agg(*[
        count_where((F.col("exchange") == e) & status_is("completed")).alias(e.lower()) for e in names
    ])


def completion_percent(loads: DataFrame) -> DataFrame:
    return loads.groupBy("exchange").agg(
        percent(count_where(status_is("completed")), F.count("*")).alias("completion_pct"))


# --- errors ---------------------------------------------------------------------


def errors_of(loads: DataFrame) -> DataFrame:
    """Error rows: one per failed load, keyed back by ``progress_id``."""
    return loads.where(status_is("failed")).select(
        F.col("id").alias("progress_id"), F.col("id").alias("file_id"), "error_type", "error_message",
        F.col("end_time").alias("error_timestamp"), "resolved",
    )


def error_analysis(errors: DataFrame) -> DataFrame:
    return errors.groupBy("error_type").agg(
        F.count("*").alias("error_count"),
        F.count_distinct("file_id").alias("affected_files"),
        F.avg(F.when(F.col("resolved"), 1.0).otherwise(0.0)).alias("resolution_rate"),
        F.min("error_timestamp").alias("first_occurrence"),
        F.max("error_timestamp").alias("last_occurrence"),
    )


def with_context(errors: DataFrame, column: str = "additional_context") -> DataFrame:
    """The JSON text of an error's context as VARIANT; text that is no JSON becomes NULL."""
    return errors.withColumn(column, F.try_parse_json(column))


def errors_by_context(errors: DataFrame, path: str = "$.host", kind: str = "string", column: str = "additional_context") -> DataFrame:
    """Errors per value at ``path`` of their context; contexts without it, or with another type there, count under NULL."""
    return errors.groupBy(F.try_variant_get(column, path, kind).alias("context_value")).agg(
        F.count("*").alias("error_count"), count_where(F.col(column).isNull()).alias("without_context"))


def errors_by_day(errors: DataFrame, as_of=None, days: int | None = 7) -> DataFrame:
    """Errors per day and type with the distinct messages, cut to 100 characters.

    Equal messages are collapsed before any text is gathered into a cell.
    """
    recent = errors if days is None else last_days(errors, days, as_of, "error_timestamp")
    keyed = recent.withColumn("error_date", F.to_date("error_timestamp"))
    per_file = keyed.groupBy("error_date", "error_type", F.left("error_message", F.lit(100)).alias("msg"), "file_id").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("resolved"), 1).otherwise(0)).alias("ok"))
    counts = per_file.groupBy("error_date", "error_type").agg(
        F.sum("n").alias("error_count"),
        F.count_distinct("file_id").alias("affected_files"),
        ratio(F.sum("ok"), F.sum("n")).alias("resolution_rate"),
    )
    texts = per_file.where(F.col("msg").isNotNull()).select("error_date", "error_type", "msg").distinct()
    joined = texts.groupBy("error_date", "error_type").agg(
        F.array_join(F.sort_array(F.collect_list("msg")), "; ").alias("sample_error_messages"))
    return counts.join(joined, ["error_date", "error_type"], "left")


def errors_by_exchange(loads: DataFrame) -> DataFrame:
    return loads.where(status_is("failed")).groupBy("exchange").agg(
        F.count("*").alias("error_count"),
        F.count_distinct(F.to_date("start_time")).alias("error_days"),
    )


def top_errors(loads: DataFrame, as_of=None, days: int = 7, limit: int = 10) -> DataFrame:
    """Most frequent messages and the total over the listed rows."""
    listed = (
        last_days(loads, days, as_of, "start_time").where(status_is("failed"))
        .groupBy("exchange", "error_message").agg(F.count("*").alias("error_count"))
        .orderBy(F.col("error_count").desc(), "exchange", "error_message").limit(limit)
    )
    return listed.withColumn("total_errors", F.sum("error_count").over(Window.partitionBy()))


def errors_with_progress(errors: DataFrame, loads: DataFrame) -> DataFrame:
    progress = loads.select(F.col("id").alias("progress_id"), "exchange", "data_date", "status", "start_time")
    return errors.join(progress, "progress_id", "left")


# --- lists ----------------------------------------------------------------------


def progress_list(loads: DataFrame, limit: int = 50) -> DataFrame:
    return (
        with_duration(loads)
        .select("id", "exchange", "data_date", "status", "records_loaded", "start_time", "end_time", "error_message",
                F.col(DURATION).alias("processing_time_seconds"))
        .orderBy(F.col("start_time").desc(), F.col("id").desc()).limit(limit)
    )


def recent_failures(loads: DataFrame, limit: int = 20) -> DataFrame:
    return (
        loads.where(status_is("failed")).select("id", "exchange", "data_date", "error_message", "start_time")
        .orderBy(F.col("start_time").desc(), F.col("id").desc()).limit(limit)
    )


def loading_status(loads: DataFrame, exchange: str | None = None, days_back: int = 7, as_of=None) -> DataFrame:
    df = last_days(loads, days_back, as_of)
    if exchange:
        df = df.where(F.col("exchange") == exchange)
    return df.select(
        "id", "exchange", "data_date", "status", "records_loaded", days_behind("data_date", as_of).alias("age_days"))


def retryable(loads: DataFrame, max_retries: int = 3) -> DataFrame:
    return loads.where(status_is("failed") & (F.col("retry_count") < max_retries))


def select_stats(stats: DataFrame, exchange: str | None = None, day: str | None = None,
                 column: str = "stats_date") -> DataFrame:
    """Optional exchange and date filters over a statistics table."""
    if exchange:
        stats = stats.where(F.col("exchange") == exchange)
    if day:
        stats = stats.where(F.col(column) == F.lit(day).cast("date"))
    return stats


def newest_stats(daily: DataFrame, limit: int = 10) -> DataFrame:
    return daily.select(
        "exchange", "stats_date", "total_files", "successful_files", "failed_files", "total_records",
        F.round("avg_records_per_file", 0).alias("avg_records_per_file"),
        F.round("total_processing_time_seconds", 2).alias("processing_time_seconds"),
    ).orderBy(F.col("stats_date").desc(), "exchange").limit(limit)


def chart_series(daily: DataFrame) -> DataFrame:
    return daily.select("stats_date", "exchange", "successful_files", "failed_files", "total_records")


def weekly_display(weekly: DataFrame) -> DataFrame:
    return weekly.select(
        "exchange", "week_ending",
        F.round("avg_daily_files", 1).alias("avg_daily_files"),
        F.round("avg_daily_records", 0).alias("avg_daily_records"),
        "total_files", "total_records",
        F.round("avg_processing_time_seconds", 2).alias("avg_processing_time_seconds"),
    )


def status_counts(loads: DataFrame) -> DataFrame:
    return loads.groupBy("exchange", "status").agg(F.count("*").alias("n"))


def activity_status(loads: DataFrame, as_of: str) -> DataFrame:
    """Loads started in the 24 hours before ``as_of`` and whether any still runs."""
    instant = F.lit(as_of).cast(loads.schema["start_time"].dataType)
    return loads.agg(
        count_where(F.col("start_time") >= instant - F.make_dt_interval(hours=F.lit(24))).alias("recent_activity"),
        count_where(status_is("started")).alias("running_count"),
        F.coalesce(F.bool_or(status_is("started")), F.lit(False)).alias("is_running"),
    )


# --- file sizes -----------------------------------------------------------------


def file_size_stats(loads: DataFrame) -> DataFrame:
    return loads.where(F.col("file_size_bytes").isNotNull()).groupBy("exchange").agg(
        F.count("*").alias("file_count"),
        F.avg("file_size_bytes").alias("avg_size_bytes"),
        F.min("file_size_bytes").alias("min_size_bytes"),
        F.max("file_size_bytes").alias("max_size_bytes"),
        (F.avg("file_size_bytes") / 1048576.0).alias("avg_size_mb"),
    )


def performance_by_size(loads: DataFrame) -> DataFrame:
    done = with_duration(loads).where(status_is("completed") & F.col("end_time").isNotNull())
    sized = done.withColumn("size_category", size_bucket("file_size_bytes")).where(F.col("size_category").isNotNull())
    return sized.groupBy("exchange", "size_category").agg(
        F.count("*").alias("file_count"),
        F.avg("records_loaded").alias("avg_records"),
        F.avg(DURATION).alias("avg_processing_seconds"),
    )


def largest_files(loads: DataFrame, limit: int = 10) -> DataFrame:
    return (
        loads.where(F.col("file_size_bytes").isNotNull())
        .select("id", "exchange", "data_date", "file_size_bytes", (F.col("file_size_bytes") / 1048576.0).alias("file_size_mb"),
                "records_loaded", "status")
        .orderBy(F.col("file_size_bytes").desc(), "id").limit(limit)
    )


def outlier_files(loads: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Files larger than mean plus ``sigmas`` deviations (a one-row subquery)."""
    limit = loads.agg((F.avg("file_size_bytes") + sigmas * F.stddev("file_size_bytes")).alias("m"))
    return loads.where(F.col("file_size_bytes") > limit.scalar())


def volume_growth(daily: DataFrame, limit: int | None = 30) -> DataFrame:
    """Bytes per day and growth to the previous day; one row per calendar day."""
    per_day = daily.where(F.col("total_file_size_bytes") > 0).groupBy("stats_date").agg(
        F.sum("total_file_size_bytes").alias("daily_total_bytes"))
    before = F.lag("daily_total_bytes").over(Window.partitionBy().orderBy("stats_date"))
    out = per_day.select(
        "*", before.alias("prev_day_bytes"),
        percent(F.col("daily_total_bytes") - before, before).alias("growth_percentage"))
    return out if limit is None else out.orderBy(F.col("stats_date").desc()).limit(limit)


# --- feeds, calendars, reconciliation ---------------------------------------------


def feed_state(loads: DataFrame) -> DataFrame:
    """High-water mark of successful loads per exchange and stage."""
    done = loads.where(status_is("completed"))
    return done.groupBy("exchange", "processing_stage").agg(
        F.max("data_date").alias("last_processed_date"),
        F.sum("records_loaded").alias("records_processed"),
        F.max("end_time").alias("last_updated"),
    )


def feed_health(state: DataFrame, as_of=None) -> DataFrame:
    behind = days_behind("last_processed_date", as_of)
    return state.select("*", behind.alias("days_behind"), health_status(behind).alias("health_status"))


def pending_files(manifest: DataFrame, loads: DataFrame, keys: tuple[str, ...] = ("exchange", "data_date")) -> DataFrame:
    """Manifest rows that no completed load covers."""
    done = loads.where(status_is("completed")).select(*keys)
    return manifest.join(done, list(keys), "left_anti")


def _expected_weekdays(loads: DataFrame) -> DataFrame:
    """Weekdays between the first and last day of each exchange."""
    span = loads.groupBy("exchange").agg(F.min("data_date").alias("lo"), F.max("data_date").alias("hi"))
    days = span.select("exchange", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("data_date"))
    return days.where(F.weekday("data_date") < 5)


def missing_days(loads: DataFrame, done: Column | None = None) -> DataFrame:
    """Weekdays without a finished load per exchange."""
    have = loads.where(status_is("completed") if done is None else done)
    return _expected_weekdays(loads).join(have.select("exchange", "data_date"), ["exchange", "data_date"], "left_anti")


def monthly_completeness(loads: DataFrame) -> DataFrame:
    have = loads.where(status_is("completed")).select("exchange", "data_date").distinct().withColumn("have", F.lit(1))
    days = _expected_weekdays(loads).join(have, ["exchange", "data_date"], "left")
    return days.groupBy("exchange", F.trunc("data_date", "MM").alias("month")).agg(
        F.count("*").alias("expected_days"),
        F.count("have").alias("loaded_days"),
        percent(F.count("have"), F.count("*")).alias("completeness_pct"),
    )


def reconcile(loads: DataFrame, ticks: DataFrame) -> DataFrame:
    """Reported against counted rows per exchange and day, both sides kept."""
    reported = loads.groupBy("exchange", "data_date").agg(
        F.count("*").alias("files"), F.sum("records_loaded").alias("reported_records"))
    counted = ticks.groupBy("exchange", "data_date").agg(F.count("*").alias("counted_records"))
    return reported.join(counted, ["exchange", "data_date"], "full").withColumn(
        "difference", F.coalesce("reported_records", F.lit(0)) - F.coalesce("counted_records", F.lit(0)))


def complete_days(ticks: DataFrame, limit: int | None = None) -> DataFrame:
    """Days by how many exchanges have data, then by rows."""
    days = ticks.groupBy("data_date").agg(
        F.count_distinct("exchange").alias("exchange_count"), F.count("*").alias("record_count"))
    best = days.orderBy(F.col("exchange_count").desc(), F.col("record_count").desc(), "data_date")
    return best if limit is None else best.limit(limit)


