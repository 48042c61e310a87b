"""Rows that come after the watermark: how many there are, and the reload that repairs what was derived without them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwell.functions.scalar import null_safe_join
from tickwell.operators import bars
from tickwell.operators.filters import priced_trades
from tickwell.session import remove_path, scratch_path
from tickwell.sinks import lake
from tickwell.streaming import jobs

BAR_PARTITIONS = ("data_date", "exchange")
BAR = ["exchange", "symbol", "bar_time", "bar_end", "open_price", "high_price", "low_price", "close_price", "volume", "trade_count"]


def on_time_bars_stream(ticks: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Closed minute bars of the trades that came in time.

    The first state operator drops repeated keys and rows behind the
    watermark; it counts the latter row by row, which an aggregate behind a
    partial one cannot.
    """
    unique = priced_trades(ticks).withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["exchange", "symbol", "ts", "event_id"])
    order = bars.order_key(unique, ("ts", "event_id"))
    closed = unique.groupBy(F.window("ts", "1 minute").alias("w"), "exchange", "symbol").agg(
        F.min_by("price", order).alias("open_price"), F.max("price").alias("high_price"), F.min("price").alias("low_price"),
        F.max_by("price", order).alias("close_price"), F.sum("volume").alias("volume"), F.count("*").alias("trade_count"))
    return closed.select("exchange", "symbol", F.col("w.start").alias("bar_time"), F.col("w.end").alias("bar_end"), *BAR[4:])


def append_bars(table: str):
    """A batch writer for closed bars, in folders by day and exchange; a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = jobs.plain_time(batch, "bar_time", "bar_end").withColumn("data_date", F.to_date("bar_time"))
        lake.write_partitions(rows.withColumn("ingest_batch", F.lit(batch_id).cast("bigint")), table, (*BAR_PARTITIONS, "ingest_batch"), ("symbol", "bar_time"))
    return write


def late_rows(query: StreamingQuery) -> int:
    """Rows that the batches of a query dropped behind the watermark."""
    return sum(r["late"] for r in jobs.batch_counts(query))


def closed_until(query: StreamingQuery) -> dt.datetime | None:
    """The watermark that a query has reached, as it reports it, in UTC."""
    marks = [p.eventTime["watermark"] for p in query.recentProgress if p.eventTime and "watermark" in p.eventTime]
    return dt.datetime.fromisoformat(max(marks)).replace(tzinfo=None) if marks else None


def repair(ticks: DataFrame, table: str, until: dt.datetime) -> DataFrame:
    """Recompute the days of an exchange whose bars lack rows; returns them with the number of rows that were missing.

    ``ticks`` is the stored table, late rows included; bars that end after
    ``until`` are still open in the stream and stay so.  Trades are counted per
    day and exchange on both sides; only days that differ are read again and
    replaced, all batches of theirs at once.  A crash can leave a day with both
    its old and its new folder; repeating the repair mends that.
    """
    spark = ticks.sparkSession
    trades = priced_trades(ticks).dropDuplicates(["exchange", "symbol", "ts", "event_id"])
    ends = F.date_trunc("minute", "ts") + F.expr("INTERVAL 1 MINUTE")
    closed = trades.withColumn("data_date", F.to_date("ts")).where(ends <= F.lit(until).cast("timestamp_ntz"))
    want = closed.groupBy(*BAR_PARTITIONS).agg(F.count("*").alias("stored"))
    have = spark.read.parquet(table).groupBy(*BAR_PARTITIONS).agg(F.sum("trade_count").alias("counted"))
    touched_at = scratch_path(spark, "late")
    touched = want.join(have, list(BAR_PARTITIONS), "left").withColumn("missing", F.col("stored") - F.coalesce("counted", F.lit(0))).where(
        "missing <> 0").select(*BAR_PARTITIONS, "missing")
    touched.write.parquet(touched_at)
    touched = spark.read.schema(touched.schema).parquet(touched_at)
    fresh = bars.minute_bars(null_safe_join(closed, touched, list(BAR_PARTITIONS), "left_semi"), session_start="00:00:00", session_end="24:00:00")
    rows = fresh.withColumn("bar_end", F.col("bar_time") + F.expr("INTERVAL 1 MINUTE")).withColumn("data_date", F.to_date("bar_time")).select(*BAR, "data_date")
    partitions = (*BAR_PARTITIONS, "ingest_batch")
    stale = null_safe_join(spark.read.parquet(table).select(*partitions).distinct(), touched, list(BAR_PARTITIONS), "left_semi")
    stale_at = scratch_path(spark, "stale")
    stale.write.parquet(stale_at)
    lake.write_partitions(rows.withColumn("ingest_batch", F.lit(-1).cast("bigint")), table, partitions, ("symbol", "bar_time"))
    lake.remove_partitions(spark, table, partitions, spark.read.schema(stale.schema).parquet(stale_at).where("ingest_batch <> -1"))
    remove_path(spark, stale_at)
    return touched
