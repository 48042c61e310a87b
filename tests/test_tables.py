"""Cleaning, resampling, outliers, futures and quality on small frames."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tickwell import dimensions
from tickwell.functions import scalar
from tickwell.operators import activity, bars, cleaning, filters, futures, outliers, profiling, quality, sets
from tickwell.sources import tables


def test_clean_market_data(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 5, 1), ("a", 1.0, 5, 1), ("b", None, 1, 1), ("c", -1.0, 1, 1), ("d", 2.0, None, 1), ("e", 3.0, -1, 1), ("f", 3.0, 1, 0)],
        "`Trade ID` string, Price double, Volume int, `open-interest` int")
    seen, kept = Observation(), Observation()
    out = cleaning.clean_market_data(df, seen, kept)
    rows = {r["trade_id"]: r["volume"] for r in out.collect()}
    assert out.columns == ["trade_id", "price", "volume", "open_interest"]
    assert rows == {"a": 5, "d": 0}  # f falls because open-interest counts as price-like
    assert seen.get == {"rows": 7} and kept.get == {"rows": 2}


def test_resample_keeps_empty_buckets(spark):
    rows = [(dt.datetime(2024, 1, 1, 9), 10.0, 1, 2.0), (dt.datetime(2024, 1, 1, 17), None, 2, 4.0), (dt.datetime(2024, 1, 3, 8), 12.0, 3, 6.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, price double, volume bigint, size double")
    got = [tuple(r) for r in bars.resample(df, "D").orderBy("ts").collect()]
    assert got == [
        (dt.datetime(2024, 1, 1), 10.0, 10.0, 10.0, 10.0, 3, 3.0),
        (dt.datetime(2024, 1, 2), None, None, None, None, 0, None),
        (dt.datetime(2024, 1, 3), 12.0, 12.0, 12.0, 12.0, 3, 6.0),
    ]


def test_resample_equals_pandas(spark):
    pdf = pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=500, freq="37min"), "price": range(500), "volume": 2})
    got = bars.resample(spark.createDataFrame(pdf), "H").orderBy("ts").toPandas()
    want = pdf.set_index("ts").resample("h").agg({"price": ["first", "max", "min", "last"], "volume": "sum"})
    assert got["open"].astype(float).equals(want[("price", "first")].reset_index(drop=True).astype(float))
    assert got["close"].astype(float).equals(want[("price", "last")].reset_index(drop=True).astype(float))
    assert got["volume"].tolist() == want[("volume", "sum")].tolist()


def test_outliers_keep_nulls_and_ignore_unknown_columns(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,), (None,)], "v double")
    for method in ("iqr", "zscore"):
        kept = [r["v"] for r in outliers.detect_outliers(df, ["v", "nope"], method).collect()]
        assert 1000.0 not in kept and None in kept and len(kept) == 21
    with pytest.raises(ValueError):
        outliers.detect_outliers(df, ["v"], "other")


def test_futures_golden_symbols(spark):
    requests = spark.createDataFrame(
        [("bitcoin", "February", 2025, 6), ("MBT", "november", 2024, 4), ("ethereum", "March", 2025, 4),
         ("btc", "Smarch", 2025, 4), ("btc", "March", 2019, 4), ("btc", "March", 2025, 25)],
        "product_type string, start_month_name string, start_year int, num_futures int")
    rows = futures.contract_calendar(requests).orderBy("position").collect()
    by = {}
    for r in rows:
        by.setdefault((r["product_type"], r["start_month_name"], r["start_year"], r["num_futures"]), []).append((r["status"], r["symbol"]))
    assert [s for _, s in by["bitcoin", "February", 2025, 6]] == ["BTCG5", "BTCH5", "BTCJ5", "BTCK5", "BTCM5", "BTCN5"]
    assert [s for _, s in by["MBT", "november", 2024, 4]] == ["MBTX4", "MBTZ4", "MBTF5", "MBTG5"]
    assert by["ethereum", "March", 2025, 4] == [("work_in_progress", None)]
    bad = [v for k, v in by.items() if k[0] == "btc"]
    assert bad == [[("invalid_request", None)]] * 3


def test_quarterly_contracts_wrap_the_year(spark):
    requests = spark.createDataFrame([("btc", "October", 2024, 12)], "product_type string, start_month_name string, start_year int, num_futures int")
    got = futures.quarterly_contracts(futures.contract_calendar(requests), 3).orderBy("quarter_rank").collect()
    assert [r["symbol"] for r in got] == ["BTCZ4", "BTCH5", "BTCM5"]


def test_contract_parsing(spark):
    df = spark.createDataFrame([("BTCH5",), ("ETEZ25",), ("AAPL.O",)], "symbol string")
    got = {r["symbol"]: (r["contract_root"], r["contract_month"], r["contract_year"], r["is_quarterly"]) for r in futures.with_contract(df).collect()}
    assert got == {"BTCH5": ("BTC", 3, 2025, True), "ETEZ25": ("ETE", 12, 2025, True), "AAPL.O": (None, None, None, None)}


def test_category_errors():
    with pytest.raises(ValueError):
        dimensions.category_symbols("gold")
    with pytest.raises(ValueError):
        dimensions.category_symbols("bitcoin_futures", "LSE")


def test_quality_flags_and_floor(spark):
    df = spark.createDataFrame([("", None, None, 2.0, 1.0), ("A", 1.0, 1, 1.0, 2.0)], "symbol string, price double, volume bigint, bid_price double, ask_price double")
    got = quality.with_row_quality(df).collect()
    assert got[0]["anomaly_flags"] == ["NULL_PRICE", "NULL_VOLUME", "NULL_SYMBOL", "CROSSED_QUOTE"] and got[0]["quality_score"] == 20.0
    assert got[1]["is_valid_trade"] and got[1]["quality_score"] == 100.0


def test_duplicates_count_null_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    assert tuple(sets.duplicate_count(df).first()) == (3, 2, 1)
    assert tuple(profiling.duplicate_profile(df.limit(0)).first()) == (0, None, 0)


def test_scores_of_a_table_with_a_hot_copy(spark):
    rows = [("LSE", dt.date(2024, 1, 1), "A", 1.0, 1)] * 50 + [("LSE", dt.date(2024, 1, 1), "B", None, -1)]
    got = quality.quality_scores(spark.createDataFrame(rows, "exchange string, data_date date, symbol string, price double, volume bigint")).first()
    assert got["duplicate_count"] == 49 and got["total_records"] == 51 and got["invalid_volume_count"] == 1
    assert 0 <= got["overall_quality_score"] <= 100


def test_nan_is_not_a_positive_price(spark):
    df = spark.createDataFrame([(float("nan"), 1), (1.0, 1), (2.0, 0)], "price double, volume bigint")
    assert [r["price"] for r in filters.positive_trades(df).collect()] == [1.0]


def test_elapsed_seconds_and_display(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-31 01:30:00' AS a, timestamp_ntz'2024-03-31 03:30:00.5' AS b, 1234567D AS n")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")  # a night with a missing hour
    try:
        row = df.select(scalar.seconds_between("a", "b").alias("s"), scalar.short_number("n").alias("n"),
                        scalar.short_duration(F.lit(5400)).alias("d"), scalar.micros_since_epoch("a").alias("m")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["s"] == 7200.5 and row["n"] == "1.2M" and row["d"] == "1.5h"
    assert row["m"] == int(dt.datetime(2024, 3, 31, 1, 30, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000


def test_path_parts(spark):
    df = spark.createDataFrame([("x/2024-01-02/LSE-2024-01-02-a.csv.gz",), ("none.txt",)], "p string")
    got = [tuple(r) for r in df.select(scalar.first_date("p"), scalar.base_name("p")).collect()]
    assert got == [(dt.date(2024, 1, 2), "LSE-2024-01-02-a"), (None, None)]


def test_only_read_statements(spark):
    assert tables.run_select(spark, "SELECT id FROM range(5000)").count() == 1000
    with pytest.raises(ValueError):
        tables.run_select(spark, "DROP TABLE x")


def test_table_info_of_missing_table(spark):
    assert tables.table_info(spark, "no_such_table").first()["table_exists"] is False


def test_latest_price_of_a_large_decimal(spark):
    df = spark.createDataFrame([("143407374.00",)], "v string").withColumn("v", F.col("v").cast("decimal(20,2)"))
    assert str(df.agg(F.avg("v").cast("decimal(20,2)")).first()[0]) == "143407374.00"


def test_bars_are_ordered(spark):
    from tickwell.binding import Tables
    daily = bars.daily_summary(Tables(spark, "/root/testdata/sf0.001").ticks)
    low, high = F.col("low_price"), F.col("high_price")
    bad = (F.col("open_price") < low) | (F.col("open_price") > high) | (F.col("close_price") < low) | (F.col("close_price") > high)
    assert daily.where(bad).count() == 0 and daily.count() > 0


def test_metric_names(spark):
    df = spark.createDataFrame([("A", 1.0, "x")], "symbol string, price double, volume string")
    assert activity.activity_metric(df, "volume") == "trade_count"
    with pytest.raises(ValueError):
        activity.activity_metric(df, "price")
