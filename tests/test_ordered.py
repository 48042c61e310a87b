"""As-of join, lookback windows and quantiles on skewed data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickwell.operators import ordered
from tickwell.operators.quantiles import exact_quantiles, quantiles_of, values_at_ranks


def skewed(n, seed, symbols=12, ties=3):
    rng = np.random.default_rng(seed)
    hot = rng.random(n) < 0.4
    return pd.DataFrame({
        "symbol": np.where(hot, "HOT", [f"S{i}" for i in rng.integers(0, symbols, n)]),
        "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, n // ties, n), unit="s"),
        "event_id": np.arange(n), "price": rng.normal(10, 2, n).round(3),
    })


@pytest.mark.parametrize("limit", [10**9, 50])
def test_asof_equals_pandas(spark, limit):
    trades, quotes = skewed(3000, 1), skewed(2000, 2).rename(columns={"price": "bid"})
    got = ordered.asof_join(
        spark.createDataFrame(trades), spark.createDataFrame(quotes), ["symbol"], "ts", ["bid"],
        "event_id", "event_id", max_group_rows=limit, slice_rows=400,
    ).orderBy("event_id").toPandas()
    want = pd.merge_asof(
        trades.sort_values(["ts", "event_id"]),
        quotes.sort_values(["ts", "event_id"])[["symbol", "ts", "bid"]].assign(quote_ts=lambda d: d.ts), on="ts", by="symbol",
    ).sort_values("event_id")
    assert len(got) == len(trades)
    np.testing.assert_allclose(got["quote_bid"].astype(float), want["bid"], equal_nan=True)
    assert (got["quote_ts"].fillna(pd.Timestamp(0)).values == want["quote_ts"].fillna(pd.Timestamp(0)).values).all()


@pytest.mark.parametrize("lookback", [1, 3, 700])
def test_lookback_same_on_both_paths(spark, lookback):
    df = spark.createDataFrame(skewed(4000, 3))
    order = ["ts", "event_id"]

    def add(part, by):
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-lookback, 0)
        return part.withColumn("s", F.sum("price").over(w)).withColumn("n", F.count("*").over(w))

    plain = ordered.lookback_window(df, ["symbol"], order, lookback, add).orderBy("event_id").toPandas()
    cut = ordered.lookback_window(df, ["symbol"], order, lookback, add, 10, 300).orderBy("event_id").toPandas()
    assert (plain["event_id"].values == cut["event_id"].values).all() and (plain["n"].values == cut["n"].values).all()
    np.testing.assert_allclose(plain["s"], cut["s"], rtol=1e-9)


def test_slices_are_contiguous_and_bounded(spark):
    df = spark.createDataFrame(skewed(5000, 4))
    out = ordered.slices(df, ["symbol"], ["ts", "event_id"], 5000, 500).toPandas()
    assert len(out) == 5000 and out.groupby("_slice").size().max() < 1500
    ordered_ids = out.sort_values(["symbol", "ts", "event_id"])["_slice"]
    assert ordered_ids.is_monotonic_increasing


@pytest.mark.parametrize("driver_values", [50_000, 40, 1])
def test_quantiles_equal_numpy(spark, driver_values):
    rng = np.random.default_rng(8)
    values = np.concatenate([np.full(2000, 3.0), 10.0 ** rng.uniform(-20, 20, 2500), -rng.random(500), rng.integers(0, 4, 999)])
    df = spark.createDataFrame(pd.DataFrame({"v": values})).unionByName(spark.createDataFrame([(None,)], "v double"))
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, "v", probabilities, accuracy=50, driver_values=driver_values)
    np.testing.assert_allclose(got, np.quantile(values, probabilities), rtol=1e-12)


def test_rank_search_from_scratch(spark):
    values = np.random.default_rng(9).permutation(np.arange(3000) // 3).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    found = values_at_ranks(df, "v", [0, 1499, 2999], 3000, accuracy=20, driver_values=25)
    assert found == {0: 0.0, 1499: 499.0, 2999: 999.0}


def test_quantiles_of_empty_and_several_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, None)], "a double, b double")
    assert quantiles_of(df, ["a", "b"], [0.25, 0.75]) == {"a": [1.75, 3.25], "b": [None, None]}


def test_null_keys_survive_on_both_paths(spark):
    from tickwell.operators import analyst, bars, cross, indicators
    rows = [(i, None if i % 2 else "LSE", None if i % 3 == 0 else "A", f"2025-01-01 09:{i:02d}:00", "Quote" if i % 4 == 0 else "Trade", 10.0 + i % 7, 5) for i in range(40)]
    ticks = spark.createDataFrame(rows, "event_id bigint, exchange string, symbol string, t string, type string, price double, volume bigint").selectExpr(
        "event_id", "exchange", "symbol", "cast(t as timestamp_ntz) AS ts", "date'2025-01-01' AS data_date", "type", "price", "volume", "price - 1 AS bid_price", "price + 1 AS ask_price")

    def both(run):
        plain, sliced = (sorted(map(str, run(**limits).collect())) for limits in ({}, {"max_group_rows": 0, "slice_rows": 7}))
        assert plain == sliced
        return plain
    assert len(both(lambda **x: cross.trades_with_quotes(ticks, **x))) == 30
    assert len(both(lambda **x: indicators.price_timeseries(ticks, **x))) == 40
    both(lambda **x: analyst.order_flow(ticks, **x))
    daily = bars.resample(ticks, "D", keys=("symbol",)).collect()
    assert sum(r["volume"] for r in daily) == 200 and all(r["open"] is not None for r in daily)
    pairs = cross.arbitrage(ticks.withColumn("exchange", F.when(F.col("event_id") % 2 == 0, "NSQ").otherwise("XXX")), "1 hour")
    assert pairs.count() > 0
