"""SQL functions for people who write SQL: paths and table freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwell.operators import quality


def register_path_functions(spark: SparkSession, root: str = "lake") -> None:
    """``source_data_path`` and ``source_report_path`` with a default stage."""
    for name, kind in (("source_data_path", "Data"), ("source_report_path", "Report")):
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {name}(exchange STRING, day DATE, stage STRING DEFAULT 'ingestion')
            RETURNS STRING
            RETURN concat('{root}/LSEG/TRTH/', upper(exchange), '/', stage, '/', cast(day AS STRING), '/data/merged/',
                          upper(exchange), '-', cast(day AS STRING), '-NORMALIZEDMP-{kind}-1-of-1.csv.gz')""")


def register_freshness(spark: SparkSession, name: str, table: str) -> None:
    """A table function ``name(as_of)`` over a table or view: newest day, age, rows."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(as_of DATE)
        RETURNS TABLE (latest_date DATE, age_days INT, record_count BIGINT)
        RETURN SELECT max(data_date), datediff(as_of, max(data_date)), count(*) FROM {table}""")


def register_table_stats(spark: SparkSession, name: str, table: str) -> None:
    """A table function ``name()`` over a table or view: rows, columns, null cells, duplicate rows of all its columns."""
    columns = [f"`{c.replace('`', '``')}`" for c in spark.table(table).columns]
    nulls = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in columns)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}()
        RETURNS TABLE (row_count BIGINT, column_count INT, null_count BIGINT, duplicate_count BIGINT)
        RETURN SELECT coalesce(sum(copies), 0), {len(columns)}, coalesce(sum(copies * nulls), 0), coalesce(sum(copies - 1), 0)
          FROM (SELECT {nulls} AS nulls, count(*) AS copies FROM {table} GROUP BY {', '.join(columns)})""")


def data_freshness(spark: SparkSession, table: str, as_of=None) -> DataFrame:
    return quality.freshness(spark.table(table), as_of)


def table_stats(spark: SparkSession, table: str) -> DataFrame:
    return quality.table_stats(spark.table(table))
