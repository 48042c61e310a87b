"""Futures contracts: symbol parsing, contract calendars, quarterly chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.dimensions import MONTH_CODES, MONTH_NAMES, PRODUCT_ROOTS, QUARTERLY_CODES
from tickwell.operators.filters import in_session

CONTRACT = rf"^([A-Z]+)([{MONTH_CODES}])(\d{{1,2}})$"


def month_code(month: Column) -> Column:
    return F.substring(F.lit(MONTH_CODES), month.cast("int"), F.lit(1))


def is_contract(symbol: str = "symbol") -> Column:
    return F.col(symbol).rlike(CONTRACT)


def with_contract(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Root, month and year of a contract symbol; NULL for other symbols.

    One-digit years mean 2020 to 2029, two-digit years 2000 to 2099.
    """
    def part(i):
        return F.nullif(F.regexp_extract(symbol, CONTRACT, i), F.lit(""))
    code, digits = part(2), part(3)
    year = F.when(F.length(digits) == 1, digits.cast("int") + 2020).otherwise(digits.cast("int") + 2000)
    return df.withColumns({
        "contract_root": part(1),
        "contract_month": F.nullif(F.instr(F.lit(MONTH_CODES), code), F.lit(0)),
        "contract_year": year,
        "is_quarterly": code.isin(list(QUARTERLY_CODES)),
    })


def contract_directory(ticks: DataFrame) -> DataFrame:
    """Parsed contract and activity per stored symbol; aggregated before parsing."""
    per_symbol = ticks.groupBy("exchange", "symbol").agg(
        F.count("*").alias("record_count"), F.min("data_date").alias("first_seen"), F.max("data_date").alias("last_seen"))
    return with_contract(per_symbol)


def unique_futures(ticks: DataFrame, exchange: str | None = None, start: str | None = None,
                   end: str | None = None, detail: bool = False) -> DataFrame:
    """Number of distinct futures symbols, or one row per symbol."""
    df = ticks.where(is_contract())
    if exchange:
        df = df.where(F.col("exchange") == exchange)
    if start:
        df = df.where(F.col("data_date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("data_date") <= F.lit(end).cast("date"))
    if detail:
        return df.groupBy("symbol").agg(
            F.count("*").alias("record_count"), F.min("data_date").alias("first_seen"), F.max("data_date").alias("last_seen"))
    return df.agg(F.count_distinct("symbol").alias("unique_futures"))


def contract_calendar(requests: DataFrame) -> DataFrame:
    """Consecutive contracts for every request row.

    ``requests`` has ``product_type, start_month_name, start_year,
    num_futures``.  Unknown products give one row with status
    ``work_in_progress``; a bad month, year or count gives ``invalid_request``.
    """
    names = F.array(*[F.lit(m.lower()) for m in MONTH_NAMES])
    roots = F.create_map(*[F.lit(x) for name, (root, _) in PRODUCT_ROOTS.items() for x in (name, root)])
    kinds = F.create_map(*[F.lit(x) for name, (_, kind) in PRODUCT_ROOTS.items() for x in (name, kind)])
    product = F.lower(F.trim("product_type"))
    month = F.array_position(names, F.lower(F.trim("start_month_name"))).cast("int")
    valid = (
        (month > 0) & F.col("start_year").between(2020, 2030) & F.col("num_futures").between(1, 24)
    )
    status = (
        F.when(roots[product].isNull(), "work_in_progress")
        .when(F.coalesce(valid, F.lit(False)), "ok").otherwise("invalid_request")
    )
    first = F.make_date(F.col("start_year"), month, F.lit(1))
    dates = F.when(
        F.col("status") == "ok",
        F.sequence(first, F.add_months(first, F.col("num_futures") - 1), F.expr("INTERVAL 1 MONTH")),
    )
    exploded = requests.withColumn("status", status).select(
        "*", product.alias("_product"), F.posexplode_outer(dates).alias("_i", "contract_date"))
    year = F.year("contract_date")
    code = month_code(F.month("contract_date"))
    return exploded.select(
        *requests.columns, "status",
        roots[F.col("_product")].alias("symbol_prefix"),
        kinds[F.col("_product")].alias("product_category"),
        (F.col("_i") + 1).alias("position"),
        F.concat(roots[F.col("_product")], code, (year % 10).cast("string")).alias("symbol"),
        code.alias("month_code"),
        F.month("contract_date").alias("contract_month"),
        year.alias("contract_year"),
    )


def quarterly_contracts(calendar: DataFrame, first: int = 2) -> DataFrame:
    """The first March, June, September or December contracts of each request.

    A request has at most 24 contracts, so its list is bounded.
    """
    quarterly = calendar.where((F.col("status") == "ok") & F.col("month_code").isin(list(QUARTERLY_CODES)))
    request = Window.partitionBy("product_type", "start_month_name", "start_year", "num_futures")
    rank = (F.col("position") - F.min("position").over(request)) / 3
    return quarterly.withColumn("quarter_rank", (rank + 1).cast("int")).where(F.col("quarter_rank") <= first)


def quarterly_activity(calendar: DataFrame, ticks: DataFrame, first: int = 2,
                       session_start: str = "08:00:00", session_end: str = "17:00:00") -> DataFrame:
    """Trades and quotes of the quarterly contracts inside the session.

    Generated symbols carry one year digit and stored ones two, so both sides
    join on root, month and year.  Ticks are aggregated per symbol first.
    """
    wanted = quarterly_contracts(calendar, first).select(
        "symbol", "contract_month", "contract_year", F.col("symbol_prefix").alias("contract_root")).distinct()
    is_trade = F.col("type") == "Trade"
    per_symbol = ticks.where(in_session(session_start, session_end)).groupBy("exchange", F.col("symbol").alias("stored_symbol")).agg(
        F.count(F.when(is_trade, 1)).alias("trade_count"),
        F.count(F.when(~is_trade, 1)).alias("quote_count"),
        F.sum(F.when(is_trade, F.col("volume"))).alias("trade_volume"),
        F.avg(F.when(is_trade, F.col("price"))).alias("avg_trade_price"),
        F.avg(F.col("ask_price") - F.col("bid_price")).alias("avg_spread"),
    )
    stored = with_contract(per_symbol, "stored_symbol").drop("is_quarterly")
    return wanted.join(stored, ["contract_root", "contract_month", "contract_year"])
