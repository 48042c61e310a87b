"""Row flags, exchange-day scores, named checks, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.functions.scalar import as_of_date, count_where, percent, ratio


def anomaly_flags() -> Column:
    """Names of the rules a row breaks, in rule order."""
    c = F.col
    rules = [
        ("NULL_PRICE", c("price").isNull()),
        ("BAD_PRICE", c("price") <= 0),
        ("NULL_VOLUME", c("volume").isNull()),
        ("BAD_VOLUME", c("volume") < 0),
        ("NULL_SYMBOL", c("symbol").isNull() | (c("symbol") == "")),
        ("CROSSED_QUOTE", c("bid_price") > c("ask_price")),
    ]
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))


def with_row_quality(df: DataFrame) -> DataFrame:
    """``anomaly_flags``, ``is_valid_trade`` and a score of 100 - 20 per flag."""
    return df.withColumn("anomaly_flags", anomaly_flags()).withColumns({
        "is_valid_trade": F.size("anomaly_flags") == 0,
        "quality_score": F.greatest(F.lit(0.0), 100.0 - 20.0 * F.size("anomaly_flags")),
    })


def quality_scores(df: DataFrame, keys: tuple[str, ...] = ("exchange", "data_date")) -> DataFrame:
    """Null, range and duplicate counts with the four scores per key.

    Rows are first grouped by all columns: copies collapse on the map side and
    the second, small aggregation needs no distinct expansion.
    """
    c = F.col
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))

    def weigh(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, c("_n"))), F.lit(0).cast("bigint"))

    counts = copies.groupBy(*keys).agg(
        F.sum("_n").alias("total_records"),
        weigh(c("price").isNull()).alias("null_price_count"),
        weigh(c("volume").isNull()).alias("null_volume_count"),
        weigh(c("symbol").isNull() | (c("symbol") == "")).alias("null_symbol_count"),
        weigh(c("price") <= 0).alias("invalid_price_count"),
        weigh(c("volume") < 0).alias("invalid_volume_count"),
        F.sum(c("_n") - 1).alias("duplicate_count"),
    )
    total = c("total_records")
    scored = counts.select(
        "*",
        percent(total - c("null_price_count") - c("null_volume_count") - c("null_symbol_count"), total)
        .alias("completeness_score"),
        percent(total - c("invalid_price_count") - c("invalid_volume_count"), total).alias("accuracy_score"),
        percent(total - c("duplicate_count"), total).alias("consistency_score"),
    )
    overall = (c("completeness_score") + c("accuracy_score") + c("consistency_score")) / 3.0
    return scored.withColumn("overall_quality_score", overall)


def null_percentages(df: DataFrame, columns: list[str], key: str = "exchange") -> DataFrame:
    """Rows per key and the share of nulls in each column."""
    return df.groupBy(key).agg(
        F.count("*").alias("record_count"),
        *[percent(count_where(F.col(c).isNull()), F.count("*")).alias(f"{c}_null_pct") for c in columns],
    )


def named_checks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows checked and failed per named rule in one pass; a null outcome fails."""
    wide = df.agg(
        F.count("*").alias("n"),
        *[count_where(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()],
    )
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col("n").alias("records_checked"),
                 F.col(name).alias("records_failed"))
        for name in rules
    ])).alias("r")
    return wide.select(pairs).select("r.*").select(
        "*",
        percent("records_failed", "records_checked").alias("failure_rate"),
        F.when(F.col("records_failed") == 0, "PASSED").otherwise("FAILED").alias("status"),
    )


def freshness(df: DataFrame, as_of=None, column: str = "data_date") -> DataFrame:
    newest = F.max(column)
    return df.agg(
        newest.alias("latest_date"),
        F.datediff(as_of_date(as_of), newest).alias("age_days"),
        F.count("*").alias("record_count"),
    )


def table_stats(df: DataFrame) -> DataFrame:
    """Rows, columns, null cells and duplicate rows over every column."""
    nulls = sum((F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0) for c in df.columns), F.lit(0))
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.coalesce(F.sum(nulls.cast("bigint") * F.col("_n")), F.lit(0)).alias("null_count"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_count"),
    )


def report_rows(ticks: DataFrame) -> DataFrame:
    """Daily report per exchange, for days without a report file."""
    bad = (F.col("price") <= 0) | F.col("price").isNull()
    return ticks.groupBy("exchange", "data_date").agg(
        F.lit("daily").alias("report_type"),
        F.count("*").alias("total_trades"),
        F.sum("volume").alias("total_volume"),
        F.sum(F.col("price") * F.col("volume")).alias("total_turnover"),
        F.count_distinct("symbol").alias("unique_symbols"),
        count_where(bad).alias("processing_errors"),
        (ratio(count_where(~bad), F.count("*")) * 100.0).alias("data_quality_score"),
    )
