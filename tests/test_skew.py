"""Queries on tables where one symbol, exchange-day or row is a third of all rows."""

import os
import sys
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SOURCE = "/root/testdata/sf0.001"
KEYS = [
    "agg_46_daily_summary", "agg_12_symbol_directory", "agg_13_quality_scores_trades", "agg_37_minute_bars",
    "agg_41_category_volume", "agg_51_volume_anomalies", "agg_66_quartiles", "prf_06_report", "prf_08_outliers_iqr",
    "set_05_distinct_rows", "set_06_duplicate_count", "win_01_latest", "win_17_indicators", "win_19_price_timeseries",
    "jn_01_arbitrage_hourly", "jn_08_trades_with_quotes_sliced", "jn_11_reconcile", "anl_13_order_flow_sliced",
    "agg_17_56_daily_stats", "agg_55_win_15_rolling_stats", "snk_01_05_bronze_load", "snk_11_upsert", "snk_17_layout",
    "str_03_minute_bars", "str_06_latest_price", "str_09_udf_07_alerts",
]


@pytest.fixture(scope="module")
def skewed_dir(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    read = lambda name: spark.read.parquet(f"{SOURCE}/{name}.parquet")
    third = F.col("event_id") % 3 == 0
    read("events").withColumn("user_id", F.when(third, 0).otherwise(F.col("user_id"))).withColumn(
        "value", F.when(third, F.round("value")).otherwise(F.col("value"))).write.parquet(f"{path}/events.parquet")
    lines = read("lineitem")
    copies = lines.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("n")
    lines.unionByName(copies).write.parquet(f"{path}/lineitem.parquet")
    orders = read("orders")
    hot = F.col("o_orderkey") % 3 == 0
    orders.withColumn("o_orderdate", F.when(hot, F.lit("1998-03-06").cast("timestamp_ntz")).otherwise(F.col("o_orderdate"))).write.parquet(f"{path}/orders.parquet")
    return path


@pytest.mark.parametrize("key", KEYS)
def test_skewed_tables(spark, skewed_dir, key):
    con = duckdb.connect()
    for name in ("events", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{skewed_dir}/{name}.parquet/*.parquet'")
    text, _, ok = check_oracle.check(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], skewed_dir)
    assert ok, text
