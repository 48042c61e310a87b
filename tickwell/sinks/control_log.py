"""Append-only control tables: progress events, audit rows, quality metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.functions.scalar import null_safe_join, stable_id
from tickwell.operators import control, outliers, quality
from tickwell.sinks import lake

MESSAGE_LENGTH = 1000
EVENT = [
    "id", "exchange", "data_date", "processing_stage", "source_file", "file_size_bytes",
    "status", "event_time", "records_loaded", "records_rejected", "error_message",
]


def progress_events(files: DataFrame, status: str, event_time=None) -> DataFrame:
    """One event per file; the id is a hash of the load key, so retries match."""
    def have(name, kind):
        return F.col(name).cast(kind) if name in files.columns else F.lit(None).cast(kind)
    return files.select(
        stable_id("exchange", "data_date", "processing_stage", "source_file").alias("id"),
        "exchange", "data_date", "processing_stage", "source_file",
        have("file_size_bytes", "bigint").alias("file_size_bytes"),
        F.lit(status).alias("status"),
        (F.current_timestamp() if event_time is None else F.lit(event_time).cast("timestamp")).alias("event_time"),
        have("records_loaded", "bigint").alias("records_loaded"),
        have("records_rejected", "bigint").alias("records_rejected"),
        F.left(have("error_message", "string"), F.lit(MESSAGE_LENGTH)).alias("error_message"),
    )


def append_progress(files: DataFrame, path: str, status: str, event_time=None) -> None:
    lake.append(progress_events(files, status, event_time), path)


# Order of the life cycle, for events with equal times.
STATUS_ORDER = ["queued", "started", "processing", "skipped", "failed", "completed"]


def current_state(events: DataFrame) -> DataFrame:
    """Newest event per id, with the time the load started and ended and the failures before it."""
    step = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col("status"))
    payload = [c for c in events.columns if c != "id"]
    done = F.col("status").isin("completed", "failed", "skipped")
    return events.groupBy("id").agg(
        F.max_by(F.struct(*payload), F.struct("event_time", step)).alias("now"),
        F.min("event_time").alias("start_time"),
        F.max(F.when(done, F.col("event_time"))).alias("end_time"),
        F.count_if(F.col("status") == "failed").alias("failures"),
    ).select(
        "id", "now.*", "start_time", "end_time",
        (F.col("failures") - F.when(F.col("now.status") == "failed", 1).otherwise(0)).alias("retry_count"))


def audit_rows(df: DataFrame, event_type: str, table: str, message: str | None = None, records: int | None = None) -> DataFrame:
    """One audit row about ``df``: its row count, or ``records`` when it is known."""
    n = F.count("*") if records is None else F.lit(records).cast("bigint")
    return df.agg(n.alias("record_count")).select(
        F.uuid().alias("log_id"), F.lit(event_type).alias("event_type"), F.lit(table).alias("table_name"),
        "record_count", F.lit(message).cast("string").alias("message"), F.current_timestamp().alias("logged_at"),
    )


def log_event(spark: SparkSession, path: str, event_type: str, table: str, records: int, message: str | None = None) -> None:
    """Append one processing event to the audit table."""
    lake.append(audit_rows(spark.range(1), event_type, table, message, records), path)


def quality_metrics(ticks: DataFrame, table: str, threshold: float = 3.0) -> DataFrame:
    """Quality scores in the shape of the metric log; anomalies are symbols whose volume is far from the mean of their day."""
    bad = F.col("invalid_price_count") + F.col("invalid_volume_count")
    odd = outliers.volume_anomalies(ticks, threshold=threshold).groupBy("exchange", "data_date").agg(F.count("*").alias("anomaly_count"))
    return null_safe_join(quality.quality_scores(ticks), odd, ["exchange", "data_date"]).select(
        "exchange", F.lit(table).alias("table_name"), "data_date", "total_records",
        (F.col("total_records") - bad).alias("valid_records"), bad.alias("invalid_records"),
        "null_price_count", "null_volume_count", "duplicate_count",
        F.coalesce("anomaly_count", F.lit(0).cast("bigint")).alias("anomaly_count"),
        "completeness_score", "accuracy_score", "consistency_score", "overall_quality_score",
    )


def update_feed_state(loads: DataFrame, path: str) -> None:
    """Upsert the high-water mark per exchange and stage."""
    lake.upsert(control.feed_state(loads), path, ["exchange", "processing_stage"], ("exchange",))


def calculate_daily_stats(loads: DataFrame, path: str, day: str, exchange: str) -> DataFrame:
    """Recompute one day of one exchange, upsert it, report what it covered."""
    picked = loads.where((F.col("data_date") == F.lit(day).cast("date")) & (F.col("exchange") == exchange))
    stats = control.daily_stats(picked)
    lake.upsert(stats, path, ["stats_date", "exchange"], ("stats_date", "exchange"))
    stored = loads.sparkSession.read.schema(stats.schema).parquet(path)
    return stored.where((F.col("stats_date") == F.lit(day).cast("date")) & (F.col("exchange") == exchange)).agg(
        F.lit(True).alias("success"),
        F.lit("Daily statistics calculated successfully").alias("message"),
        F.coalesce(F.sum("total_records_processed"), F.lit(0)).alias("records_processed"),
        F.coalesce(F.sum("total_files_processed"), F.lit(0)).alias("files_processed"),
    )
