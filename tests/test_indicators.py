"""Indicators against pandas on hand-made series."""

import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwell.operators import indicators as ind

DAY0 = dt.date(2024, 1, 1)


def series(spark, values, symbol="A"):
    rows = [("X", symbol, DAY0 + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "exchange string, symbol string, data_date date, close_price double")


def expected(values):
    p = pd.Series(values, dtype="float64")
    out = pd.DataFrame({f"sma_{n}": p.rolling(n, min_periods=1).mean() for n in (5, 10, 20, 50)})
    out["ema_12"], out["ema_26"] = p.ewm(span=12).mean(), p.ewm(span=26).mean()
    out["macd"] = out.ema_12 - out.ema_26
    out["macd_signal"] = out.macd.ewm(span=9).mean()
    out["macd_histogram"] = out.macd - out.macd_signal
    d = p.diff()
    gain = d.where(d > 0, 0).rolling(14).mean()
    loss = (-d.where(d < 0, 0)).rolling(14).mean()
    out["rsi"] = 100 - 100 / (1 + gain / loss)
    mean, std = p.rolling(20).mean(), p.rolling(20).std()
    out["bb_upper"], out["bb_lower"], out["bb_middle"] = mean + 2 * std, mean - 2 * std, mean
    out["price_change_pct"] = p.pct_change(fill_method=None) * 100
    return out


def run(spark, values):
    return ind.add_indicators(series(spark, values)).orderBy("data_date").toPandas()


@pytest.mark.parametrize("n,seed", [(1, 0), (13, 1), (60, 2), (1500, 3)])
def test_bundle_equals_pandas(spark, n, seed):
    values = (100 + np.random.default_rng(seed).normal(0, 1, n).cumsum()).round(2)
    got, want = run(spark, values), expected(values)
    for c in want.columns:
        np.testing.assert_allclose(got[c].astype(float), want[c], rtol=1e-8, atol=1e-8, equal_nan=True, err_msg=c)


def test_rsi_of_constant_and_rising_series(spark):
    flat, up = run(spark, [5.0] * 20)["rsi"], run(spark, range(1, 21))["rsi"]
    assert flat.isna().all()
    assert up[:13].isna().all() and (up[13:] == 100).all()


def test_bollinger_starts_at_row_20(spark):
    bands = run(spark, np.arange(1.0, 26.0) ** 2)["bb_middle"]
    assert bands[:19].isna().all() and bands[19:].notna().all()


def test_ema_with_gaps_equals_pandas(spark):
    values = [1.0, None, 3.0, None, None, 6.0, 2.0]
    out = ind.with_position(series(spark, values), ind.SERIES, ["data_date"])
    got = ind.add_ema(out, ind.SERIES, {"e": ("close_price", 12)}).orderBy("data_date").toPandas()["e"]
    np.testing.assert_allclose(got, pd.Series(values, dtype=float).ewm(span=12).mean(), rtol=1e-12)


def test_percent_change_fills_gaps_forward(spark):
    w = ind.series_window(ind.SERIES, ["data_date"])
    df = series(spark, [10, None, 11]).withColumn("c", ind.percent_change("close_price", w))
    got = df.orderBy("data_date").toPandas()["c"]
    np.testing.assert_allclose(got.astype(float), [np.nan, 0.0, 10.0], equal_nan=True)


def test_too_long_span_is_refused(spark):
    df = ind.with_position(series(spark, [1.0, 2.0]), ind.SERIES, ["data_date"])
    with pytest.raises(ValueError):
        ind.add_ema(df, ind.SERIES, {"e": ("close_price", 200)})


def test_ema_by_series_equals_expressions(spark):
    values = np.random.default_rng(5).uniform(1, 2, 40)
    a = ind.ema_by_series(series(spark, values), {"ema_12": 12}).orderBy("data_date").toPandas()["ema_12"]
    np.testing.assert_allclose(a, run(spark, values)["ema_12"], rtol=1e-12)


def test_tick_indicators_same_on_both_paths(spark):
    rng = np.random.default_rng(7)
    n = 9000  # one symbol holds two thirds of the rows
    pdf = pd.DataFrame({
        "exchange": "X", "symbol": np.where(np.arange(n) % 3 == 0, [f"S{i % 20}" for i in range(n)], "HOT"),
        "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n) // 2, unit="s"),
        "event_id": np.arange(n), "price": (100 + rng.normal(0, 1, n).cumsum()).round(2),
    })
    ticks = spark.createDataFrame(pdf)
    plain = ind.tick_indicators(ticks).orderBy("event_id").toPandas()
    sliced = ind.tick_indicators(ticks, max_group_rows=100, slice_rows=700).orderBy("event_id").toPandas()
    assert list(plain.columns) == list(sliced.columns) and len(plain) == len(sliced) == n
    for c in plain.columns[5:]:
        np.testing.assert_allclose(plain[c].astype(float), sliced[c].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True, err_msg=c)


def rsi_by_frames(df, price, w, window):
    """The definition: means over sliding frames of the gains and losses."""
    frame = ind.trailing(w, window)
    d = F.col("_d")
    moved = df.withColumns({"_d": ind.difference(price, w), "_seen": F.count(F.lit(1)).over(frame)})
    rated = moved.withColumns({
        "_gain": F.avg(F.when(d > 0, d).otherwise(0.0)).over(frame), "_loss": F.avg(F.when(d < 0, -d).otherwise(0.0)).over(frame)})
    value = F.when(F.col("_loss") > 0, 100.0 - 100.0 / (1.0 + F.try_divide("_gain", "_loss"))).when(F.col("_gain") > 0, 100.0)
    return rated.withColumn("rsi", F.when(F.col("_seen") == window, value))


@pytest.mark.parametrize("kind", ["double", "float", "int", "decimal(12,3)"])
@pytest.mark.parametrize("spans,window,rsi", [((5, 10, 20, 50), 20, 14), ((3, 7), 5, 3), ((4,), 1, 1), ((1, 12), 6, 9)])
def test_trailing_equals_sliding_frames(spark, kind, spans, window, rsi):
    rng = np.random.default_rng(11)
    rows = []
    for symbol, n, gaps in (("A", 130, 0.0), ("B", 130, 0.1), ("C", 12, 0.5), ("D", 60, 1.0), (None, 40, 0.05)):
        prices = np.where(np.arange(n) // 25 % 2, 100.0, 1e6 + rng.normal(0, 9, n).round(1).cumsum())
        rows += [("X", symbol, DAY0 + dt.timedelta(days=i), None if rng.random() < gaps else float(p)) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "exchange string, symbol string, data_date date, close_price double")
    df = df.withColumn("close_price", F.col("close_price").cast(kind))
    w = ind.series_window(ind.SERIES, ["data_date"])
    want = rsi_by_frames(df, "close_price", w, rsi).withColumns({
        **{f"m{n}": ind.sma("close_price", n, w) for n in spans}, **ind.bollinger("close_price", w, window)})
    got = ind.add_trailing(df, "close_price", w, {f"m{n}": n for n in spans}, (window, 2.0), rsi=("rsi", rsi))
    assert got.columns == [*df.columns, *[f"m{n}" for n in spans], "bb_upper", "bb_lower", "bb_middle", "rsi"]
    assert dict(got.dtypes) == dict(want.select(got.columns).dtypes)
    order = ["symbol", "data_date"]
    got, want = got.orderBy(*order).toPandas(), want.orderBy(*order).toPandas()
    assert len(got) == len(rows)
    for c in got.columns[4:]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True, err_msg=c)


def test_sliding_frames_hold_each_mean_once_and_nothing_else(spark):
    bars = series(spark, [1.0, 2.0])
    for df, most in ((ind.add_indicators(bars), 4), (ind.add_rsi(bars, "close_price", ind.SERIES, ["data_date"]), 0),
                     (ind.add_bollinger(bars, "close_price", ind.SERIES, ["data_date"]), 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        frames = re.findall(r"(\w+)\([^()]*\) windowspecdefinition\([^()]*specifiedwindowframe\(RowFrame, -\d+, currentrow", plan)
        assert "Window" in plan and frames == ["avg"] * most


def test_bundle_sorts_no_rows_that_carry_indicators(spark):
    plan = ind.add_indicators(series(spark, [1.0, 2.0]))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Sort ["):]
    assert plan.count("Sort [") == 2 and not re.search(r"sma_|bb_|rsi", below)


def test_bundle_keeps_the_order_of_columns(spark):
    bars = series(spark, [1.0, 2.0])
    assert ind.add_indicators(bars).columns == [*bars.columns, *ind.INDICATORS]
    assert ind.add_indicators(bars.select(F.lit(0).alias("rsi"), "*")).columns == ["rsi", *bars.columns, *[c for c in ind.INDICATORS if c != "rsi"]]
