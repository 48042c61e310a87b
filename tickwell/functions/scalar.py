"""Column expressions used across operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division in double; NULL when the denominator is zero."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def percent(num: Column | str, den: Column | str) -> Column:
    return F.try_divide(as_col(num).cast("double") * F.lit(100.0), as_col(den).cast("double"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join in which a null key equals a null key; the keys appear once, as on the left."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = left.join(renamed, same, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"_right_{k}" for k in keys])


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def _interval_micros(i: Column) -> Column:
    hours = F.extract(F.lit("DAY"), i) * F.lit(24).cast("bigint") + F.extract(F.lit("HOUR"), i)
    seconds = F.extract(F.lit("SECOND"), i) * 1_000_000
    return (hours * 60 + F.extract(F.lit("MINUTE"), i)) * 60_000_000 + seconds.cast("bigint")


def micros_since_epoch(c: str | Column) -> Column:
    """Microseconds of a zone-less timestamp, whatever the session zone."""
    return _interval_micros(as_col(c) - F.lit("1970-01-01").cast("timestamp_ntz"))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Elapsed seconds with microsecond precision, NULL when either is NULL."""
    return _interval_micros(as_col(end) - as_col(start)).cast("double") / F.lit(1_000_000.0)


def first_date(text: str | Column) -> Column:
    """First YYYY-MM-DD in a text as a date; NULL when there is none."""
    found = F.regexp_extract(as_col(text), r"(\d{4}-\d{2}-\d{2})", 1)
    return F.nullif(found, F.lit("")).try_cast("date")


def base_name(path: str | Column) -> Column:
    """File name without folder and ``.csv.gz``; NULL for other files."""
    found = F.regexp_extract(as_col(path), r"([^/]+)\.csv\.gz$", 1)
    return F.nullif(found, F.lit(""))


def finite(c: str | Column) -> Column:
    """NaN becomes NULL: NaN compares greater than any number in Spark."""
    col = as_col(c)
    return F.when(~F.isnan(col), col)


def size_bucket(size_bytes: str | Column) -> Column:
    mib = 1024 * 1024
    c = as_col(size_bytes)
    return (
        F.when(c < 50 * mib, "small").when(c < 200 * mib, "medium").when(c.isNotNull(), "large")
    )


def days_behind(last: str | Column, as_of: str | Column | None = None) -> Column:
    """Whole days from ``last`` to ``as_of`` (today when not given)."""
    return F.datediff(as_of_date(as_of), as_col(last))


def as_of_date(as_of=None) -> Column:
    """A date column from a literal, a column or, when missing, today."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def health_status(behind: Column) -> Column:
    return F.when(behind <= 1, "HEALTHY").when(behind <= 3, "WARNING").otherwise("CRITICAL")


def short_number(c: str | Column) -> Column:
    """1234567 -> 1.2M, with K, M and B steps."""
    v = as_col(c).cast("double")
    return (
        F.when(v >= 1e9, F.concat(F.format_string("%.1f", v / 1e9), F.lit("B")))
        .when(v >= 1e6, F.concat(F.format_string("%.1f", v / 1e6), F.lit("M")))
        .when(v >= 1e3, F.concat(F.format_string("%.1f", v / 1e3), F.lit("K")))
        .when(v.isNotNull(), F.format_string("%.0f", v))
    )


def short_duration(seconds: str | Column) -> Column:
    """Seconds as 42.0s, 3.5m or 1.2h."""
    v = as_col(seconds).cast("double")
    return (
        F.when(v >= 3600, F.concat(F.format_string("%.1f", v / 3600), F.lit("h")))
        .when(v >= 60, F.concat(F.format_string("%.1f", v / 60), F.lit("m")))
        .when(v.isNotNull(), F.concat(F.format_string("%.1f", v), F.lit("s")))
    )


def stable_id(*cols: str | Column) -> Column:
    """Deterministic id of a natural key; reruns give the same value."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("\x00")) for c in cols]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)
