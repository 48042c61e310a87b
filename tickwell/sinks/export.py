"""Exports: whole tables, symbol categories, minute bars."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell import dimensions
from tickwell.operators.bars import minute_bars
from tickwell.operators.filters import symbols_in
from tickwell.operators.sets import export_order


def export_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options: str) -> None:
    """Write a frame in any Spark format, one file per task."""
    if fmt == "csv":
        options = {"header": "true", **options}
    df.write.format(fmt).mode(mode).options(**options).save(path)


def category_rows(ticks: DataFrame, category: str, exchange: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Raw ticks of a category in export order."""
    symbols = dimensions.category_symbols(category, exchange)
    df = symbols_in(ticks.where(F.col("exchange") == exchange.upper()), symbols)
    if start:
        df = df.where(F.col("data_date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("data_date") <= F.lit(end).cast("date"))
    return export_order(df)


def export_summary(df: DataFrame) -> DataFrame:
    """Records, symbols, day range, volume and mean price of exported rows.

    The symbol list holds at most the symbols of one category.
    """
    return df.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("symbol").alias("unique_symbols"),
        F.array_sort(F.collect_set("symbol")).alias("symbols_found"),
        F.min("data_date").alias("earliest"),
        F.max("data_date").alias("latest"),
        F.count_distinct("data_date").alias("unique_dates"),
        F.sum("volume").alias("total_volume"),
        F.avg("price").alias("avg_price"),
    )


def export_name(category: str, exchange: str, start: str | None, end: str | None, fmt: str) -> str:
    span = f"_{start}_to_{end}" if start and end else f"_from_{start}" if start else f"_until_{end}" if end else ""
    return f"{category}_{exchange.lower()}{span}_{datetime.now():%Y%m%d_%H%M%S}.{fmt}"


def export_category(ticks: DataFrame, folder: str, category: str, exchange: str, start: str | None = None,
                    end: str | None = None, name: str | None = None, fmt: str = "csv") -> tuple[str, DataFrame]:
    """Write a category's ticks as CSV or JSON; returns the path and a summary frame."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"format must be 'csv' or 'json', not {fmt!r}")
    rows = category_rows(ticks, category, exchange, start, end)
    name = name or export_name(category, exchange, start, end, fmt)
    path = f"{folder.rstrip('/')}/{name if name.endswith('.' + fmt) else name + '.' + fmt}"
    export_table(rows, path, fmt)
    return path, export_summary(rows)


def export_minute_bars(ticks: DataFrame, path: str, **request) -> None:
    """Minute bars as CSV, ordered by symbol and time."""
    bars = minute_bars(ticks, **request)
    export_table(bars.orderBy("exchange", "symbol", "bar_time"), path, "csv")
