"""Bind the generic test tables to the market-data model.

``Tables`` derives ticks, trades and the load log from events, lineitem and
orders.  ``ORACLE_VIEWS`` states the same three views in the checker's SQL.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TICKS_AS_OF = "2024-01-31"
TRADES_AS_OF = "2001-11-05"
LOADS_AS_OF = "2001-08-02"


def _pick(index, *values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def ticks_from_events(events: DataFrame) -> DataFrame:
    quote = F.col("event_type").isin("view", "signup")
    root = _pick(F.col("user_id") % 5, "BTC", "MBT", "ETE", "HTE", "MTE")
    code = F.substring(F.lit("FGHJKMNQUVXZ"), (F.floor(F.col("user_id") / 5).cast("int") % 12) + 1, F.lit(1))
    return events.select(
        "event_id",
        _pick(F.col("event_id") % 3, "LSE", "CME", "NYQ").alias("exchange"),
        F.concat(root, code, F.lit("25")).alias("symbol"),
        "ts",
        F.col("ts").alias("exchange_time"),
        F.to_date("ts").alias("data_date"),
        F.when(quote, "Quote").otherwise("Trade").alias("type"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        F.when(quote, F.col("value") - 0.05).alias("bid_price"),
        F.when(quote, F.col("value") + 0.05).alias("ask_price"),
        F.when(F.col("user_id") % 7 != 0, F.col("value") / 10).alias("yield_value"),
    )


def trades_from_lineitem(lineitem: DataFrame) -> DataFrame:
    exchange = (
        F.when(F.col("l_returnflag") == "A", "LSE").when(F.col("l_returnflag") == "N", "CME").otherwise("NYQ")
    )
    return lineitem.select(
        exchange.alias("exchange"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.to_date("l_shipdate").alias("data_date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.col("l_extendedprice").alias("turnover"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    )


def load_log_from_orders(orders: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "started")
        .otherwise("failed")
    )
    seconds = lambda n: F.make_dt_interval(secs=n.cast("decimal(18,6)"))
    failed = F.col("status") == "failed"
    return (
        orders.withColumn("status", status)
        .withColumn("start_time", F.col("o_orderdate") + seconds(F.col("o_orderkey") % 86400))
        .select(
            F.col("o_orderkey").alias("id"),
            _pick(F.col("o_custkey") % 3, "LSE", "CME", "NYQ").alias("exchange"),
            F.to_date("o_orderdate").alias("data_date"),
            "status",
            "start_time",
            F.when(
                F.col("status") != "started", F.col("start_time") + seconds(F.col("o_custkey") % 600 + 1)
            ).alias("end_time"),
            F.when(F.col("status") == "completed", F.floor("o_totalprice").cast("bigint"))
            .otherwise(F.lit(0).cast("bigint"))
            .alias("records_loaded"),
            (F.col("o_orderkey") % 17).alias("records_rejected"),
            F.floor(F.col("o_totalprice") * 1000).cast("bigint").alias("file_size_bytes"),
            F.when(failed, F.col("o_orderpriority")).alias("error_type"),
            F.when(failed, F.concat(F.lit("err "), F.col("o_orderpriority"))).alias("error_message"),
            (F.col("o_orderkey") % 2 == 0).alias("resolved"),
        )
    )


_SCHEMAS: dict[tuple[str, str], StructType] = {}


class Tables:
    """Lazily bound inputs of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        """A table by name; its schema is read from the files once per session."""
        path = self.path(name)
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[key]).parquet(path)

    @cached_property
    def ticks(self) -> DataFrame:
        return ticks_from_events(self.read("events"))

    @cached_property
    def trades(self) -> DataFrame:
        return trades_from_lineitem(self.read("lineitem"))

    @cached_property
    def load_log(self) -> DataFrame:
        return load_log_from_orders(self.read("orders"))


ORACLE_VIEWS = {
    "ticks": """
SELECT event_id,
       ['LSE','CME','NYQ'][event_id % 3 + 1] AS exchange,
       ['BTC','MBT','ETE','HTE','MTE'][user_id % 5 + 1]
         || substring('FGHJKMNQUVXZ', CAST(floor(user_id / 5) AS INT) % 12 + 1, 1) || '25' AS symbol,
       ts, ts AS exchange_time, CAST(ts AS DATE) AS data_date,
       CASE WHEN event_type IN ('view','signup') THEN 'Quote' ELSE 'Trade' END AS type,
       CASE WHEN event_type <> 'error' THEN value END AS price,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume,
       CASE WHEN event_type IN ('view','signup') THEN value - CAST(0.05 AS DOUBLE) END AS bid_price,
       CASE WHEN event_type IN ('view','signup') THEN value + CAST(0.05 AS DOUBLE) END AS ask_price,
       CASE WHEN user_id % 7 <> 0 THEN value / 10 END AS yield_value
FROM events""",
    "trades": """
SELECT CASE l_returnflag WHEN 'A' THEN 'LSE' WHEN 'N' THEN 'CME' ELSE 'NYQ' END AS exchange,
       'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
       CAST(l_shipdate AS DATE) AS data_date,
       l_extendedprice / l_quantity AS price,
       CAST(l_quantity AS BIGINT) AS volume,
       l_extendedprice AS turnover,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM lineitem""",
    "load_log": """
SELECT id, exchange, data_date, status, start_time,
       CASE WHEN status <> 'started' THEN start_time + to_seconds(CAST(o_custkey % 600 + 1 AS BIGINT)) END AS end_time,
       CASE WHEN status = 'completed' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END AS records_loaded,
       id % 17 AS records_rejected,
       CAST(floor(o_totalprice * 1000) AS BIGINT) AS file_size_bytes,
       CASE WHEN status = 'failed' THEN o_orderpriority END AS error_type,
       CASE WHEN status = 'failed' THEN 'err ' || o_orderpriority END AS error_message,
       id % 2 = 0 AS resolved
FROM (SELECT o_orderkey AS id, ['LSE','CME','NYQ'][o_custkey % 3 + 1] AS exchange,
             CAST(o_orderdate AS DATE) AS data_date,
             CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'started' ELSE 'failed' END AS status,
             o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS start_time,
             o_custkey, o_totalprice, o_orderpriority
      FROM orders)""",
}


def oracle_query(sql: str) -> str:
    """Prefix ``sql`` with the bound views it mentions."""
    used = [f"{name} AS ({body})" for name, body in ORACLE_VIEWS.items() if re.search(rf"\b{name}\b", sql)]
    if not used:
        return sql
    body = sql.strip()
    if re.match(r"(?i)with\s+recursive\b", body):
        return "WITH RECURSIVE " + ",\n".join(used) + ",\n" + body[len("with recursive"):]
    if re.match(r"(?i)with\b", body):
        return "WITH " + ",\n".join(used) + ",\n" + body[len("with"):]
    return "WITH " + ",\n".join(used) + "\n" + body
