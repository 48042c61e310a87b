"""Price-move and volume-spike alerts on closed minute bars.

The alert job reads the table the bar job writes.  Its per-symbol state sees
one row per minute and symbol, never the raw ticks of a hot symbol.  A symbol
without bars for longer than ``idle`` starts anew: its state goes when the
watermark passes that time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MOVE_PERCENT = 5.0
SPIKE_FACTOR = 3.0
MIN_BARS = 5
IDLE_DAYS = 7

ALERT = "exchange string, symbol string, bar_time timestamp, alert string, value double, baseline double"
STATE = "last_close double, bars bigint, total_volume bigint, last_time timestamp"


def session_alerts(close: np.ndarray, volume: np.ndarray, last: float | None, bars: int, total: int,
                   move: float, spike: float, min_bars: int) -> list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, positions, values, baselines) for consecutive bars after ``bars`` earlier ones."""
    before = np.r_[np.nan if last is None else last, close[:-1]]
    with np.errstate(divide="ignore", invalid="ignore"):
        change = (close / np.where(before == 0, np.nan, before) - 1.0) * 100.0
        seen = bars + np.arange(len(close))
        mean = (total + np.cumsum(volume) - volume) / seen
    moved = np.flatnonzero(np.abs(change) >= move)
    spiked = np.flatnonzero((seen >= min_bars) & (volume > spike * mean))
    return [("price_move", moved, change[moved], before[moved]), ("volume_spike", spiked, volume[spiked].astype(float), mean[spiked])]


class AlertProcessor(StatefulProcessor):
    """One value per symbol: last close, number of bars, their volume, and the time of the last; a timer ends an idle one."""

    def __init__(self, move: float, spike: float, min_bars: int, idle: dt.timedelta):
        self.limits, self.idle = (move, spike, min_bars), idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("bar_time", kind="stable")
        times, close, volume = frame["bar_time"].to_numpy(), frame["close_price"].to_numpy(float), frame["volume"].to_numpy(np.int64)
        last, bars, total, at = self.seen.get() if self.seen.exists() else (None, 0, 0, None)
        previous = np.r_[times[:1] if at is None else np.array([pd.Timestamp(at).to_datetime64()], times.dtype), times[:-1]]
        fresh = np.flatnonzero(times - previous > np.timedelta64(self.idle))
        for part in np.split(np.arange(len(times)), fresh):
            if not len(part):
                continue
            if part[0] in fresh:
                last, bars, total = None, 0, 0
            for kind, where, values, baselines in session_alerts(close[part], volume[part], last, bars, total, *self.limits):
                if len(where):
                    yield pd.DataFrame({"exchange": key[0], "symbol": key[1], "bar_time": times[part][where], "alert": kind,
                                        "value": values, "baseline": baselines})
            last, bars, total = float(close[part[-1]]), bars + len(part), total + int(volume[part].sum())
        newest = pd.Timestamp(times[-1])
        self.seen.update((last, bars, total, newest.to_pydatetime()))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(newest.value // 1_000_000 + self.idle / dt.timedelta(milliseconds=1)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


def alerts_stream(bars: DataFrame, move: float = MOVE_PERCENT, spike: float = SPIKE_FACTOR,
                  min_bars: int = MIN_BARS, idle_days: int = IDLE_DAYS, lateness: str = "1 minute") -> DataFrame:
    """Alerts per symbol against its last close and its running mean volume.

    Needs a session with the RocksDB state store (``jobs.stream_session(spark, timers=True)``).
    """
    needed = bars.select("exchange", "symbol", "bar_time", "close_price", F.coalesce("volume", F.lit(0)).alias("volume"))
    return needed.withWatermark("bar_time", lateness).groupBy("exchange", "symbol").transformWithStateInPandas(
        AlertProcessor(move, spike, min_bars, dt.timedelta(days=idle_days)), ALERT, "append", "EventTime")


def alerts_batch(bars: DataFrame, move: float = MOVE_PERCENT, spike: float = SPIKE_FACTOR,
                 min_bars: int = MIN_BARS, idle_days: int = IDLE_DAYS) -> DataFrame:
    """The same alerts over a bar table, for history and for checking the stream."""
    along = Window.partitionBy("exchange", "symbol").orderBy("bar_time")
    idle = F.col("bar_time") - F.lag("bar_time").over(along) > F.make_dt_interval(days=F.lit(idle_days))
    w = Window.partitionBy("exchange", "symbol", "spell").orderBy("bar_time")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    seen = bars.withColumn("idle", F.coalesce(idle, F.lit(False)).cast("int")).withColumn(
        "spell", F.sum("idle").over(along.rowsBetween(Window.unboundedPreceding, 0))).select(
        "exchange", "symbol", "bar_time", F.coalesce("volume", F.lit(0)).alias("volume"),
        F.lag("close_price").over(w).alias("last"), "close_price",
        F.avg(F.coalesce("volume", F.lit(0))).over(before).alias("mean_volume"), F.count("*").over(before).alias("bars"))
    pct = (F.try_divide(F.col("close_price"), F.col("last")) - 1.0) * 100.0
    kinds = F.array_compact(F.array(
        F.when(F.abs(pct) >= move, F.struct(F.lit("price_move").alias("alert"), pct.alias("value"), F.col("last").alias("baseline"))),
        F.when((F.col("bars") >= min_bars) & (F.col("volume") > spike * F.col("mean_volume")),
               F.struct(F.lit("volume_spike").alias("alert"), F.col("volume").cast("double").alias("value"), F.col("mean_volume").alias("baseline"))),
    ))
    return seen.select("exchange", "symbol", "bar_time", F.explode(kinds).alias("a")).select("exchange", "symbol", "bar_time", "a.*")
