"""Exact quantiles without gathering a column in one task.

``percentile`` keeps every distinct value of a group in one aggregation
buffer, which does not hold for a whole price column.  Here a quantile sketch
brackets the wanted ranks, one counting pass fixes how many rows lie below
each bracket, and only the few values inside a bracket are looked at exactly.
Each round shrinks the bracket by the sketch accuracy, so a table of 10^12
rows needs three rounds.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.functions.scalar import count_where

DRIVER_VALUES = 50_000  # distinct values of one bracket that may reach the driver


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float],
                    accuracy: int = 10_000, driver_values: int = DRIVER_VALUES) -> list[float | None]:
    """Linear-interpolated quantiles of a numeric column, nulls ignored."""
    return quantiles_of(df, [column], probabilities, accuracy, driver_values)[column]


def quantiles_of(df: DataFrame, columns: list[str], probabilities: list[float],
                 accuracy: int = 10_000, driver_values: int = DRIVER_VALUES) -> dict[str, list[float | None]]:
    """The same for several columns at once, normally in three passes.

    Ranks the sketch missed, or whose bracket is still too wide, go through
    ``values_at_ranks``.
    """
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    eps = 2.0 / accuracy
    cuts = [x for p in probabilities for x in (max(p - eps, 0.0), min(p + eps, 1.0))]
    sketch = values.agg(*[
        x for i in range(len(columns))
        for x in (F.count(f"v{i}").alias(f"n{i}"), F.percentile_approx(f"v{i}", cuts, accuracy).alias(f"q{i}"))
    ]).first()
    filled = [i for i in range(len(columns)) if sketch[f"n{i}"]]
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    if not filled:
        return result
    brackets = {(i, j): (sketch[f"q{i}"][2 * j], sketch[f"q{i}"][2 * j + 1])
                for i in filled for j in range(len(probabilities))}
    counts = values.agg(*[
        x for (i, j), (a, b) in brackets.items() for v in [F.col(f"v{i}")]
        for x in (count_where(v < a).alias(f"lt{i}_{j}"), count_where(v == a).alias(f"ea{i}_{j}"),
                  count_where((v > a) & (v < b)).alias(f"in{i}_{j}"), count_where(v == b).alias(f"eb{i}_{j}"))
    ]).first()

    found: dict[tuple[int, int], float] = {}
    inner: dict[tuple[int, int], list[int]] = {}
    missed: dict[int, list[int]] = {}
    for (i, j), (a, b) in brackets.items():
        lt, ea, mid = (counts[f"{k}{i}_{j}"] for k in ("lt", "ea", "in"))
        eb = counts[f"eb{i}_{j}"] if b != a else 0
        at = probabilities[j] * (sketch[f"n{i}"] - 1)
        for r in {math.floor(at), math.ceil(at)}:
            if lt <= r < lt + ea:
                found[i, r] = a
            elif lt + ea <= r < lt + ea + mid and mid <= driver_values:
                inner.setdefault((i, j), []).append(r)
            elif lt + ea + mid <= r < lt + ea + mid + eb:
                found[i, r] = b
            else:
                missed.setdefault(i, []).append(r)
    if inner:
        picks = F.explode(F.array_compact(F.array(*[
            F.when((F.col(f"v{i}") > brackets[i, j][0]) & (F.col(f"v{i}") < brackets[i, j][1]),
                   F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"v{i}").alias("v")))
            for i, j in inner
        ]))).alias("p")
        rows = values.select(picks).groupBy("p.i", "p.j", "p.v").agg(F.count("*").alias("c")).collect()
        for (i, j), ranks in inner.items():
            upto = counts[f"lt{i}_{j}"] + counts[f"ea{i}_{j}"]
            want = sorted(ranks)
            for row in sorted((r for r in rows if r["i"] == i and r["j"] == j), key=lambda r: r["v"]):
                upto += row["c"]
                while want and want[0] < upto:
                    found[i, want.pop(0)] = row["v"]
    for i, ranks in missed.items():
        one = values.select(F.col(f"v{i}").alias("v")).where(F.col("v").isNotNull())
        exact = values_at_ranks(one, "v", sorted(set(ranks)), sketch[f"n{i}"], accuracy, driver_values)
        found.update({(i, r): v for r, v in exact.items()})
    for i in filled:
        for j, p in enumerate(probabilities):
            at = p * (sketch[f"n{i}"] - 1)
            lo, hi = found[i, math.floor(at)], found[i, math.ceil(at)]
            result[columns[i]][j] = lo + (hi - lo) * (at - math.floor(at))
    return result


def values_at_ranks(values: DataFrame, column: str, ranks: list[int], n: int,
                    accuracy: int = 10_000, driver_values: int = DRIVER_VALUES) -> dict[int, float]:
    """Value at each 0-based rank of the ascending order."""
    v = F.col(column)
    found: dict[int, float] = {}
    # bracket per rank: (low, high, rows strictly below low); None = open end
    todo = {r: (None, None, 0, n) for r in ranks}
    while todo:
        brackets = sorted({b for b in todo.values()}, key=lambda b: b[2])
        for bracket in brackets:
            low, high, below, inside = bracket
            mine = [r for r, b in todo.items() if b == bracket]
            rows = values
            if low is not None:
                rows = rows.where((v >= low) & (v <= high))
            distinct = None
            if inside <= driver_values:
                distinct = rows.groupBy(column).agg(F.count("*").alias("c")).orderBy(column).collect()
            if distinct is not None:
                upto = below
                it = iter(sorted(mine))
                want = next(it, None)
                for row in distinct:
                    upto += row["c"]
                    while want is not None and want < upto:
                        found[want] = row[column]
                        want = next(it, None)
                for r in mine:
                    del todo[r]
                continue
            cuts: list[float] = []
            for r in mine:
                p = (r - below) / max(inside - 1, 1)
                eps = 2.0 / accuracy
                cuts += [max(p - eps, 0.0), min(p + eps, 1.0)]
            sketch = rows.agg(F.percentile_approx(v, cuts, accuracy).alias("q")).first()["q"]
            spans = [(sketch[2 * i], sketch[2 * i + 1]) for i in range(len(mine))]
            aggs = []
            for i, (a, b) in enumerate(spans):
                aggs += [
                    count_where(v < a).alias(f"lt{i}"), count_where(v == a).alias(f"ea{i}"),
                    count_where((v > a) & (v < b)).alias(f"in{i}"), count_where(v == b).alias(f"eb{i}"),
                    F.max(F.when(v < a, v)).alias(f"pa{i}"), F.min(F.when(v > b, v)).alias(f"nb{i}"),
                    F.min(F.when((v > a) & (v < b), v)).alias(f"lo{i}"),
                    F.max(F.when((v > a) & (v < b), v)).alias(f"hi{i}"),
                    F.min(v).alias(f"mn{i}"), F.max(v).alias(f"mx{i}"),
                ]
            s = rows.agg(*aggs).first()
            for i, r in enumerate(mine):
                a, b = spans[i]
                at = r - below
                lt, ea, mid, eb = s[f"lt{i}"], s[f"ea{i}"], s[f"in{i}"], (s[f"eb{i}"] if b != a else 0)
                if at < lt:
                    todo[r] = (s[f"mn{i}"], s[f"pa{i}"], below, lt)
                elif at < lt + ea:
                    found[r] = a
                    del todo[r]
                elif at < lt + ea + mid:
                    todo[r] = (s[f"lo{i}"], s[f"hi{i}"], below + lt + ea, mid)
                elif at < lt + ea + mid + eb:
                    found[r] = b
                    del todo[r]
                else:
                    rest = lt + ea + mid + eb
                    todo[r] = (s[f"nb{i}"], s[f"mx{i}"], below + rest, inside - rest)
    return found


def quartiles(df: DataFrame, columns: list[str], probabilities: tuple[float, ...] = (0.25, 0.5, 0.75),
              approximate: bool = False) -> DataFrame:
    """Quartiles per column; ``approximate`` opts into one sketch pass."""
    names = [f"q{round(p * 100)}" for p in probabilities]
    if approximate:
        rows = df.agg(*[
            F.percentile_approx(F.col(c).cast("double"), list(probabilities)).alias(c) for c in columns
        ]).first()
        data = [(c, *(rows[c] or [None] * len(names))) for c in columns]
    else:
        data = [(c, *found) for c, found in quantiles_of(df, columns, list(probabilities)).items()]
    schema = "column_name string, " + ", ".join(f"{n} double" for n in names)
    return df.sparkSession.createDataFrame(data, schema)
