"""Streaming jobs run to the end of the available files, then read back.

Checks compare with closed windows only: a window is emitted once the
watermark, the newest event time minus the lateness, has passed its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.binding import load_log_from_orders, ticks_from_events
from tickwell.operators import bars
from tickwell.registry import register
from tickwell.registry.lake import GLOB, HEADER, vendor_cells, write_vendor_files
from tickwell.session import scratch_path
from tickwell.streaming import alerts, jobs, late


def _source(t, table: str) -> DataFrame:
    own = jobs.stream_session(t.spark)
    return jobs.read_stream(own, t.path(table), t.read(table).schema)


def _ticks(t) -> DataFrame:
    return jobs.event_time(ticks_from_events(_source(t, "events")), "ts")


def _loads(t) -> DataFrame:
    loads = load_log_from_orders(_source(t, "orders"))
    return jobs.event_time(loads, "start_time", "end_time")


def _run(t, df: DataFrame, **kw) -> DataFrame:
    path = scratch_path(t.spark, "stream")
    jobs.finish(jobs.run(df, f"{path}/checkpoint", f"{path}/out", **kw))
    return t.spark.read.schema(df.schema).parquet(f"{path}/out")


BARS = """b AS (SELECT exchange, symbol, date_trunc('minute', ts) AS bar_time, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS bar_end,
 arg_min(price, ts) AS open_price, max(price) AS high_price, min(price) AS low_price, arg_max(price, ts) AS close_price,
 CAST(sum(volume) AS BIGINT) AS volume, count(*) AS trade_count FROM ticks WHERE type = 'Trade' AND price IS NOT NULL GROUP BY 1, 2, 3, 4),
 closed AS (SELECT * FROM b WHERE bar_end <= (SELECT max(ts) FROM ticks WHERE type = 'Trade' AND price IS NOT NULL) - INTERVAL 1 MINUTE)"""


@register("str_03_minute_bars", f"WITH {BARS} SELECT * FROM closed")
def _(t):
    return _run(t, jobs.plain_time(jobs.minute_bars_stream(_ticks(t)), "bar_time", "bar_end"))


SEC = "((epoch_us(end_time) - epoch_us(start_time)) / CAST(1000000 AS DOUBLE))"
STATS = f"""count(*) AS files, CAST(sum(records_loaded) AS BIGINT) AS records, count(*) FILTER (status = 'failed') AS errors,
 avg({SEC}) AS avg_processing_time_seconds, CAST(sum(records_loaded) AS DOUBLE) / nullif(sum({SEC}), 0) AS records_per_second,
 count(*) FILTER (status = 'failed') * CAST(100 AS DOUBLE) / count(*) AS error_rate"""


@register("str_04_08_hourly_load_stats", f"""
SELECT * FROM (SELECT date_trunc('hour', start_time) AS window_start, date_trunc('hour', start_time) + INTERVAL 1 HOUR AS window_end, exchange, {STATS}
 FROM load_log GROUP BY 1, 2, 3)""")
def _(t):
    """Update mode: every batch upserts the hours it changed."""
    path = scratch_path(t.spark, "hourly")
    stats = jobs.plain_time(jobs.load_stats_stream(_loads(t)), "window_start", "window_end")
    write = jobs.upsert_windows(f"{path}/out", ["window_start", "exchange"])
    jobs.finish(jobs.run(stats, f"{path}/checkpoint", mode="update", each_batch=write))
    return t.spark.read.parquet(f"{path}/out").drop("window_day")


@register("str_05_rolling_7_days", f"""
WITH w AS (SELECT l.*, unnest(generate_series(CAST(start_time AS DATE) - INTERVAL 6 DAY, CAST(CAST(start_time AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS window_start FROM load_log l)
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, exchange, {STATS} FROM w GROUP BY 1, 2, 3
HAVING window_start + INTERVAL 7 DAY <= (SELECT max(start_time) FROM load_log) - INTERVAL 1 HOUR""")
def _(t):
    return _run(t, jobs.plain_time(jobs.load_stats_stream(_loads(t), "7 days", "1 day"), "window_start", "window_end"))


@register("str_06_latest_price", """
SELECT exchange, symbol, ts, event_id, price, volume FROM ticks WHERE price IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY exchange, symbol ORDER BY ts DESC, event_id DESC) = 1""")
def _(t):
    path = scratch_path(t.spark, "latest")
    write = jobs.upsert_newest(f"{path}/out", ["exchange", "symbol"], ["ts", "event_id"], ("exchange",))
    latest = jobs.plain_time(jobs.latest_price_stream(_ticks(t)), "ts")
    jobs.finish(jobs.run(latest, f"{path}/checkpoint", mode="update", each_batch=write))
    return t.spark.read.parquet(f"{path}/out")


@register("str_07_unique_ticks", "SELECT exchange, symbol, count(*) AS n, count(DISTINCT ts) AS times FROM ticks GROUP BY 1, 2")
def _(t):
    ticks = _ticks(t)
    unique = jobs.unique_ticks_stream(ticks.unionByName(ticks), ["exchange", "symbol", "ts", "event_id"])
    return _run(t, unique).groupBy("exchange", "symbol").agg(F.count("*").alias("n"), F.count_distinct("ts").alias("times"))


ALERTS = """g AS (SELECT *, CASE WHEN bar_time - lag(bar_time) OVER (PARTITION BY exchange, symbol ORDER BY bar_time) > INTERVAL 7 DAY THEN 1 ELSE 0 END AS idle FROM closed),
 s AS (SELECT *, sum(idle) OVER (PARTITION BY exchange, symbol ORDER BY bar_time ROWS UNBOUNDED PRECEDING) AS spell FROM g),
 a AS (SELECT exchange, symbol, bar_time, coalesce(volume, 0) AS volume, close_price, lag(close_price) OVER w AS last,
  avg(coalesce(volume, 0)) OVER p AS mean_volume, count(*) OVER p AS bars FROM s
  WINDOW w AS (PARTITION BY exchange, symbol, spell ORDER BY bar_time), p AS (PARTITION BY exchange, symbol, spell ORDER BY bar_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT exchange, symbol, bar_time, 'price_move' AS alert, (close_price / nullif(last, 0) - 1) * 100 AS value, last AS baseline FROM a WHERE abs(close_price / nullif(last, 0) - 1) * 100 >= 5
UNION ALL SELECT exchange, symbol, bar_time, 'volume_spike', CAST(volume AS DOUBLE), mean_volume FROM a WHERE bars >= 5 AND volume > 3 * mean_volume"""


@register("str_09_udf_07_alerts", f"WITH {BARS}, {ALERTS}")
def _(t):
    path = scratch_path(t.spark, "bars")
    bar_stream = jobs.minute_bars_stream(_ticks(t))
    jobs.finish(jobs.run(bar_stream, f"{path}/checkpoint", f"{path}/out"))
    closed = jobs.read_stream(jobs.stream_session(t.spark, timers=True), f"{path}/out", bar_stream.schema)
    return _run(t, jobs.plain_time(alerts.alerts_stream(closed), "bar_time"))


@register("str_09_alerts_history", f"WITH {BARS}, " + ALERTS.replace("FROM closed", "FROM b"))
def _(t):
    history = bars.minute_bars(t.ticks, session_start="00:00:00", session_end="24:00:00")
    return alerts.alerts_batch(history)


# --- vendor files ------------------------------------------------------------------

# The stream's own exchanges: two begin with L, and their headers differ.
FEED = "SELECT * REPLACE (CASE exchange WHEN 'NYQ' THEN 'LIF' ELSE exchange END AS exchange) FROM ticks"


def _arrive(t, path: str, part: int) -> None:
    """Nine tenths of the ticks, then the rest with other columns in another order."""
    ticks = t.ticks.withColumn("exchange", F.when(F.col("exchange") == "NYQ", "LIF").otherwise(F.col("exchange")))
    i, cells, lse = F.col("event_id"), vendor_cells(), F.col("exchange") == "LSE"
    if part == 0:
        line = F.when(lse, F.concat_ws(",", *cells)).otherwise(F.concat_ws(",", *cells, F.concat(F.lit("q"), "type")))
        header, rows = F.when(lse, HEADER).otherwise(f"{HEADER},Qualifiers"), ticks.where(i % 10 != 0)
    else:
        line = F.concat_ws(",", F.lit("v"), cells[1], cells[0], *cells[2:])
        header, rows = F.lit("Venue,Date-Time,#RIC,Type,Price,Volume,Exch Time"), ticks.where(i % 10 == 0)
    write_vendor_files(rows, path, header, F.when(i % 97 == 0, "broken,line").otherwise(line), "append")


def _vendor_stream(t) -> str:
    """Two arrivals of vendor files through one stream; each is taken up twice, the second time finds nothing new."""
    path = scratch_path(t.spark, "stream-ingest")
    for part in range(2):
        _arrive(t, f"{path}/in", part)
        for _ in range(2):
            lines = jobs.read_vendor_lines(jobs.stream_session(t.spark), f"{path}/in", GLOB)
            write = jobs.vendor_batches(f"{path}/out", f"{path}/audit", f"{path}/counts")
            jobs.finish(jobs.run(lines, f"{path}/checkpoint", each_batch=write))
    return path


@register("str_01_02_stream_ingest", f"""
SELECT symbol, ts, type, price, CASE WHEN event_id % 89 <> 0 THEN volume END AS volume, exchange, data_date FROM ({FEED}) WHERE event_id % 97 <> 0""")
def _(t):
    """New vendor files, whatever their headers, through a replay-safe batch writer."""
    stored = t.spark.read.parquet(f"{_vendor_stream(t)}/out").where(~F.col("is_rejected"))
    return stored.select("symbol", "ts", "type", "price", "volume", "exchange", "data_date")


@register("str_10_11_batch_counts", """
WITH good AS (SELECT * FROM ticks WHERE event_id % 97 <> 0)
SELECT count(*) AS processed, count(*) FILTER (event_id % 97 <> 0) AS loaded, count(*) FILTER (event_id % 97 = 0) AS rejected,
 (SELECT count(*) FROM good WHERE event_id % 10 = 0 AND ts <= (SELECT max(ts) FROM good WHERE event_id % 10 <> 0) - INTERVAL 10 MINUTE) AS late FROM ticks""")
def _(t):
    counts = t.spark.read.parquet(f"{_vendor_stream(t)}/counts")
    return counts.agg(*[F.sum(c).alias(c) for c in ("processed", "loaded", "rejected", "late")])


@register("str_11_late_rows", """
WITH t AS (SELECT * FROM ticks WHERE type = 'Trade' AND price IS NOT NULL),
 late AS (SELECT count(*) AS late_rows FROM t WHERE event_id % 10 = 0
  AND ts <= (SELECT date_trunc('milliseconds', max(ts)) FROM t WHERE event_id % 10 <> 0) - INTERVAL 10 MINUTE),
 b AS (SELECT exchange, symbol, date_trunc('minute', ts) AS bar_time, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS bar_end,
  arg_min(price, ts) AS open_price, max(price) AS high_price, min(price) AS low_price, arg_max(price, ts) AS close_price,
  CAST(sum(volume) AS BIGINT) AS volume, count(*) AS trade_count FROM t GROUP BY 1, 2, 3)
SELECT b.*, late_rows FROM b, late WHERE bar_end <= (SELECT date_trunc('milliseconds', max(ts)) FROM t) - INTERVAL 10 MINUTE""")
def _(t):
    """Bars of a stream in which a tenth of the rows come behind the watermark, after the reload of their days."""
    path = scratch_path(t.spark, "late")
    dropped = 0
    for part in range(2):
        events = t.read("events").where(F.col("event_id") % 10 != 0 if part == 0 else F.col("event_id") % 10 == 0)
        events.write.mode("append").parquet(f"{path}/in")
        stream = jobs.read_stream(jobs.stream_session(t.spark), f"{path}/in", t.read("events").schema)
        ticks = jobs.event_time(ticks_from_events(stream), "ts")
        query = jobs.run(late.on_time_bars_stream(ticks), f"{path}/checkpoint", each_batch=late.append_bars(f"{path}/bars"))
        jobs.finish(query)
        dropped += late.late_rows(query)
    late.repair(t.ticks, f"{path}/bars", late.closed_until(query))
    return t.spark.read.parquet(f"{path}/bars").select(*late.BAR, F.lit(dropped).cast("bigint").alias("late_rows"))
