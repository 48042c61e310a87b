"""Technical indicators as window expressions over an ordered price series.

The usual input is bars, one series per (exchange, symbol): the size of a
series is bounded by the calendar.  ``tick_indicators`` runs the same
expressions on raw ticks through ``ordered.lookback_window``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell.operators.ordered import MAX_GROUP_ROWS, SLICE_ROWS, lookback_window

SERIES = ["exchange", "symbol"]
SMA_SPANS = (5, 10, 20, 50)
INDICATORS = [*[f"sma_{n}" for n in SMA_SPANS], "bb_upper", "bb_lower", "bb_middle", "price_change_pct", "rsi",
              "ema_12", "ema_26", "macd", "macd_signal", "macd_histogram"]
EMA_BLOCK = 512  # weights older than one block are below 1e-17 for spans up to 26
EMA_LOOKBACK = 2 * EMA_BLOCK


def series_window(keys: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def trailing(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(-(rows - 1), 0)


def sma(price: str, span: int, w: WindowSpec) -> Column:
    """Mean of up to ``span`` rows; the first rows use what is there."""
    return F.avg(price).over(trailing(w, span))


def difference(price: str, w: WindowSpec) -> Column:
    return F.col(price) - F.lag(price).over(w)


def percent_change(price: str, w: WindowSpec) -> Column:
    """Change to the previous known price in percent; gaps are filled forward."""
    here = F.last(price, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = F.last(price, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return (F.try_divide(here, before) - 1.0) * 100.0


def bollinger(price: str, w: WindowSpec, window: int = 20, num_std: float = 2.0) -> dict[str, Column]:
    """Bands around the mean; NULL until ``window`` prices are there."""
    frame = trailing(w, window)
    full = F.count(price).over(frame) == window
    middle, reach = F.avg(price).over(frame), F.stddev(price).over(frame) * num_std
    return {
        "bb_upper": F.when(full, middle + reach),
        "bb_lower": F.when(full, middle - reach),
        "bb_middle": F.when(full, middle),
    }


def _step(width: int) -> int:
    """The divisor of a width that needs the fewest lags: step - 1 rows, then width / step - 1 steps."""
    return min((d for d in range(1, width + 1) if width % d == 0), key=lambda d: d + width // d)


def add_trailing(df: DataFrame, price: str, w: WindowSpec, means: dict[str, int] | None = None,
                 bands: tuple[int, float] | None = None, change: str | None = None,
                 rsi: tuple[str, int] | None = None) -> DataFrame:
    """Trailing means ``{out: rows}``, Bollinger bands, percent change and RSI in two passes over ``w``.

    A sliding frame takes up every row of the frame again for each row.  The
    deviations, gains and losses are added up over ``step`` rows by lags, then
    those sums, ``step`` rows apart.  Nothing is taken out of a sum again, so
    nothing cancels; only counts, which are exact, are differences of running
    ones.  Means stay frames, each width once: their sums keep their order,
    and so their last digit.
    """
    means = means or {}
    summed = bands and isinstance(df.schema[price].dataType, (T.DoubleType, T.FloatType, T.IntegralType))
    step, move = _step(bands[0]) if summed else 1, _step(rsi[1]) if rsi else 0
    x = [F.col(price), *[F.col(f"_x{i}") for i in range(1, max(step - 1, move) + 1)]]

    def total(terms: list[Column]) -> Column:
        return sum(terms[1:], terms[0])

    def back(name: str, width: int, by: int) -> list[Column]:
        return [F.col(name), *[F.col(f"{name}_{i}") for i in range(by, width, by)]]

    near = {f"_x{i}": F.lag(price, i).over(w) for i in range(1, len(x))}
    short, far, out = {}, {}, {}
    if summed:
        n, num_std = bands
        known = [v.cast("double") for v in x[:step]]
        near["_c"] = F.count(price).over(w.rowsBetween(Window.unboundedPreceding, 0))
        short["_s"] = total(known) / step
        short["_q"] = total([(v - short["_s"]) * (v - short["_s"]) for v in known])
        far["_before"] = F.lag("_c", n, 0).over(w)
        far |= {f"{c}_{i}": F.lag(c, i).over(w) for c in ("_s", "_q") for i in range(step, n, step)}
    if rsi:
        near["_row"] = F.row_number().over(w)
        moves = [x[i] - x[i + 1] for i in range(move)]
        short["_up"] = total([F.when(d > 0, d).otherwise(0.0) for d in moves])
        short["_down"] = total([F.when(d < 0, -d).otherwise(0.0) for d in moves])
        far |= {f"{n}_{i}": F.lag(n, i).over(w) for n in ("_up", "_down") for i in range(move, rsi[1], move)}

    far |= {f"_m_{k}": sma(price, k, w) for k in {*means.values(), *([n] if summed else [])}}
    out |= {name: F.col(f"_m_{k}") for name, k in means.items()}
    if summed:
        full, middle = F.col("_c") - F.col("_before") == n, F.col(f"_m_{n}")
        apart = total([(m - middle) * (m - middle) for m in back("_s", n, step)]) * step
        reach = F.sqrt(F.try_divide(total(back("_q", n, step)) + apart, F.lit(n - 1))) * num_std
        out |= {
            "bb_upper": F.when(full, middle + reach),
            "bb_lower": F.when(full, middle - reach),
            "bb_middle": F.when(full, middle),
        }
    elif bands:
        out |= bollinger(price, w, *bands)
    if change:
        out[change] = percent_change(price, w)
    if rsi:
        name, n = rsi
        gain, loss = total(back("_up", n, move)) / n, total(back("_down", n, move)) / n
        value = F.when(loss > 0, 100.0 - 100.0 / (1.0 + F.try_divide(gain, loss))).when(gain > 0, 100.0)
        out[name] = F.when(F.col("_row") >= n, value)
    return df.withColumns(near).withColumns(short).drop(*[c for c in near if c.startswith("_x")]).withColumns(
        far).withColumns(out).drop(*near, *short, *far)


def add_bollinger(df: DataFrame, price: str, keys: list[str], order: list[str],
                  window: int = 20, num_std: float = 2.0) -> DataFrame:
    """Bands around the mean, as by ``bollinger``."""
    return add_trailing(df, price, series_window(keys, order), bands=(window, num_std))


def add_rsi(df: DataFrame, price: str, keys: list[str], order: list[str],
            window: int = 14, out: str = "rsi") -> DataFrame:
    """Relative strength from simple means of gains and losses.

    The first row counts as no change, so the first value is on row ``window``.
    No losses gives 100; no movement at all gives NULL.
    """
    return add_trailing(df, price, series_window(keys, order), rsi=(out, window))


def with_position(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row position in the series and its block, as ``add_ema`` needs them."""
    pos = F.row_number().over(series_window(keys, order)) - 1
    return df.withColumn("_pos", pos).withColumns({
        "_blk": F.floor(F.col("_pos") / EMA_BLOCK), "_off": F.col("_pos") % EMA_BLOCK,
    })


def add_ema(df: DataFrame, keys: list[str], columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Exponential means ``{out: (price, span)}`` with weights (1-a)^age, a = 2/(span+1).

    The mean is sum(x w) / sum(w).  Inside a block both sums are running sums
    of terms scaled by (1-a)^-offset; the block before enters through the sums
    at its last row, and anything older weighs less than 1e-17.
    """
    in_block = Window.partitionBy(*keys, "_blk").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_blk", "_pos").rowsBetween(Window.unboundedPreceding, -1)
    weight, local, carry, result = {}, {}, {}, {}
    for i, (out, (price, span)) in enumerate(columns.items()):
        keep = 1.0 - 2.0 / (span + 1)
        if keep ** EMA_BLOCK > 1e-16:
            raise ValueError(f"span {span} needs a longer block than {EMA_BLOCK} rows")
        weight[f"_w{i}"] = F.pow(F.lit(keep), F.col("_off"))
        down, n, d = F.col(f"_w{i}"), f"_n{i}", f"_d{i}"
        up = 1.0 / down
        local[n] = down * F.sum(F.coalesce(F.col(price) * up, F.lit(0.0))).over(in_block)
        local[d] = down * F.sum(F.when(F.col(price).isNotNull(), up).otherwise(0.0)).over(in_block)
        last_row = F.col("_off") == EMA_BLOCK - 1
        for x in (n, d):
            carry[f"{x}c"] = F.coalesce(F.last(F.when(last_row, F.col(x)), ignorenulls=True).over(earlier), F.lit(0.0))
        older = down * keep
        result[out] = F.try_divide(F.col(n) + older * F.col(f"{n}c"), F.col(d) + older * F.col(f"{d}c"))
    return df.withColumns(weight).withColumns(local).withColumns(carry).withColumns(result).drop(*weight, *local, *carry)


def add_indicators(df: DataFrame, price_col: str = "close_price", keys: list[str] | None = None,
                   order: list[str] | None = None) -> DataFrame:
    """Moving averages, MACD, RSI, Bollinger bands and percent change in one call."""
    keys, order = SERIES if keys is None else keys, order or ["data_date"]
    # Positions come first, while rows are narrow: all that follows shares their one order.
    out = with_position(df, keys, order)
    out = add_ema(out, keys, {"ema_12": (price_col, 12), "ema_26": (price_col, 26)})
    out = add_ema(out.withColumn("macd", F.col("ema_12") - F.col("ema_26")), keys, {"macd_signal": ("macd", 9)})
    out = out.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    out = add_trailing(
        out, price_col, series_window(keys, ["_blk", "_pos"]), {f"sma_{n}": n for n in SMA_SPANS},
        (20, 2.0), "price_change_pct", ("rsi", 14))
    return out.select(*dict.fromkeys([*df.columns, *INDICATORS]))


def tick_indicators(ticks: DataFrame, price_col: str = "price", keys: list[str] | None = None,
                    order: list[str] | None = None, max_group_rows: int = MAX_GROUP_ROWS,
                    slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The indicator bundle on raw priced ticks, safe for a hot symbol."""
    keys, order = keys or SERIES, order or ["ts", "event_id"]
    priced = ticks.where(F.col(price_col).isNotNull())
    return lookback_window(
        priced, keys, order, EMA_LOOKBACK,
        lambda part, by: add_indicators(part, price_col, by, order), max_group_rows, slice_rows,
    )


def price_timeseries(ticks: DataFrame, max_group_rows: int = MAX_GROUP_ROWS,
                     slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Silver price series: price, volume, two averages and RSI per tick."""
    priced = ticks.where(F.col("price").isNotNull()).select(
        "exchange", "symbol", "ts", "event_id", "price", "volume", "data_date")
    order = ["ts", "event_id"]

    def add(part: DataFrame, by: list[str]) -> DataFrame:
        w = series_window(by, order)
        return add_trailing(part, "price", w, {"sma_10": 10, "sma_50": 50}, rsi=("rsi", 14))

    return lookback_window(priced, SERIES, order, 64, add, max_group_rows, slice_rows)


def ema_by_series(df: DataFrame, spans: dict[str, int], price_col: str = "close_price",
                  keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Exponential means by one Arrow batch per series.

    The exact reference path for bars: a series is one symbol's bars.
    """
    keys, order = keys or SERIES, order or ["data_date"]
    out_type = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"{n} double" for n in spans])

    def smooth(pdf):
        pdf = pdf.sort_values(order)
        return pdf.assign(**{name: pdf[price_col].ewm(span=span).mean() for name, span in spans.items()})

    return df.groupBy(*keys).applyInPandas(smooth, out_type)
