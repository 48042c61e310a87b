"""Projections and predicates over tick frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell import dimensions
from tickwell.functions.scalar import as_of_date, finite, first_date

NUMERIC = (T.NumericType,)


def time_range(
    ticks: DataFrame, start: str, end: str, exchange: str | None = None,
    symbol: str | None = None, limit: int | None = 1000,
    order: tuple[str, ...] = ("data_date", "ts", "event_id"),
) -> DataFrame:
    """Rows of an inclusive date range, oldest first; the limit is the feature."""
    out = ticks.where(F.col("data_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if exchange:
        out = out.where(F.col("exchange") == exchange)
    if symbol:
        out = out.where(F.col("symbol") == symbol)
    out = out.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return out.limit(limit) if limit is not None else out


def rename_vendor_columns(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Vendor headers to the tick contract; other columns keep their names."""
    names = names or VENDOR_NAMES
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


# Vendor header -> tick column.
VENDOR_NAMES = {
    "#RIC": "symbol",
    "Date-Time": "ts",
    "Type": "type",
    "Price": "price",
    "Volume": "volume",
    "Exch Time": "exchange_time",
    "Qualifiers": "qualifiers",
}


def symbols_in(ticks: DataFrame, symbols: list[str]) -> DataFrame:
    """An IN list; Catalyst turns it into a pushed-down set filter."""
    return ticks.where(F.col("symbol").isin(symbols))


def last_days(df: DataFrame, days: int, as_of=None, column: str = "data_date") -> DataFrame:
    """Rows at or after ``as_of - days``; works for date and timestamp columns."""
    floor = F.date_sub(as_of_date(as_of), days)
    kind = df.schema[column].dataType
    if not isinstance(kind, T.DateType):
        floor = floor.cast(kind)
    return df.where(F.col(column) >= floor)


def last_hours(df: DataFrame, hours: int, as_of, column: str) -> DataFrame:
    """Rows of the ``hours`` before the instant ``as_of``."""
    kind = df.schema[column].dataType
    floor = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast(kind) - F.make_dt_interval(hours=F.lit(hours))
    return df.where(F.col(column) >= floor)


def positive_trades(ticks: DataFrame) -> DataFrame:
    return ticks.where((finite("price") > 0) & (F.col("volume") > 0))


def priced_trades(ticks: DataFrame) -> DataFrame:
    return ticks.where((F.col("type") == "Trade") & F.col("price").isNotNull())


def quotes(ticks: DataFrame) -> DataFrame:
    return ticks.where(F.col("type") == "Quote")


def with_spread(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("spread", F.col("ask_price") - F.col("bid_price"))


def second_of_day(ts: str = "ts") -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _clock(text: str) -> int:
    h, m, *s = (int(p) for p in text.split(":"))
    return h * 3600 + m * 60 + (s[0] if s else 0)


def in_session(start: str = "08:00:00", end: str = "17:00:00", ts: str = "ts") -> Column:
    """Half-open ``[start, end)``; a start after the end wraps midnight."""
    lo, hi, t = _clock(start), _clock(end), second_of_day(ts)
    return (t >= lo) & (t < hi) if lo <= hi else (t >= lo) | (t < hi)


def in_exchange_hours(ticks: DataFrame, ts: str = "ts") -> DataFrame:
    """Keep rows inside their exchange's own trading hours (local clock)."""
    cond = F.lit(False)
    for row in dimensions.EXCHANGES:
        lo, hi = row[4].split("-")
        cond = cond | ((F.col("exchange") == row[0]) & in_session(lo, hi, ts))
    return ticks.where(cond)


def to_utc(ticks: DataFrame, ts: str = "ts", out: str = "ts_utc") -> DataFrame:
    """Exchange-local wall time to UTC through the exchange dimension."""
    spark = ticks.sparkSession
    zones = dimensions.exchange_dim(spark).select("exchange", "timezone")
    return (
        ticks.join(F.broadcast(zones), "exchange", "left")
        .withColumn(out, F.convert_timezone(F.col("timezone"), F.lit("UTC"), F.col(ts)))
    )


def with_exchange_metadata(df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(dimensions.exchange_dim(df.sparkSession)), "exchange", "left")


def safe_double(name: str) -> Column:
    """Text to double, NULL when it is not a number."""
    return F.col(f"`{name}`").try_cast("double")


def completeness_flag(*raw: str) -> Column:
    """VALID when every raw value is present, else INCOMPLETE (text counts as present)."""
    cond = F.lit(True)
    for name in raw:
        cond = cond & F.col(f"`{name}`").isNotNull()
    return F.when(cond, "VALID").otherwise("INCOMPLETE")


def dated_since(df: DataFrame, floor: str = "2020-01-01", column: str = "data_date") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) >= F.lit(floor).cast("date")))


def date_from_path(df: DataFrame, path: str = "source_file", out: str = "data_date") -> DataFrame:
    return df.withColumn(out, first_date(path))


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, NUMERIC)


def running_loads(loads: DataFrame) -> DataFrame:
    return loads.where(F.col("status") == "started")


