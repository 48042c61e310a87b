"""Catalog reads: schemas, previews, table overviews, guarded SQL, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_LIMIT = 1000


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def run_select(spark: SparkSession, query: str, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """A read-only statement with a row limit put on the result, not the text."""
    head = query.lstrip().split(None, 1)[0].lower() if query.strip() else ""
    if head not in {"select", "with", "from", "values", "table", "describe", "show"}:
        raise ValueError(f"only read statements are accepted, not {head!r}")
    out = spark.sql(query)
    return out if limit is None else out.limit(limit)


def table_schema(spark: SparkSession, table: str) -> DataFrame:
    """(column_name, data_type, nullable, position) of a table or view."""
    return schema_frame(spark.table(table))


def schema_frame(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString(), f.nullable, i) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, nullable boolean, position int"
    )


def list_tables(spark: SparkSession, databases: list[str] | None = None) -> DataFrame:
    """Tables of the given databases; catalog metadata only, no data is read."""
    names = databases or [d.name for d in spark.catalog.listDatabases()]
    rows = [
        (db, t.name, t.tableType) for db in names
        for t in spark.catalog.listTables(db) if not t.isTemporary
    ]
    return spark.createDataFrame(rows, "table_schema string, table_name string, table_type string")


def list_datasets(spark: SparkSession, databases: list[str] | None = None, stats: bool = False) -> DataFrame:
    """Tables per schema, with count and first and last day where they have a day."""
    tables = list_tables(spark, databases)
    if not stats:
        return tables
    out = None
    for row in tables.toLocalIterator():
        full = f"`{row.table_schema}`.`{row.table_name}`"
        df = spark.table(full)
        dated = "data_date" in df.columns
        day = F.col("data_date").cast("date") if dated else F.lit(None).cast("date")
        one = df.agg(
            F.count("*").alias("record_count"),
            F.min(day).alias("earliest_date"),
            F.max(day).alias("latest_date"),
        ).select(F.lit(row.table_schema).alias("table_schema"), F.lit(row.table_name).alias("table_name"),
                 F.lit(row.table_type).alias("table_type"), "*")
        out = one if out is None else out.unionByName(one)
    if out is None:
        schema = "record_count bigint, earliest_date date, latest_date date"
        empty = spark.createDataFrame([], schema)
        return tables.join(empty, F.lit(False), "left")
    return out


def database_overview(spark: SparkSession, databases: list[str] | None = None, stats: bool = False) -> DataFrame:
    """Tables per schema and overall; with ``stats`` their rows too."""
    tables = list_datasets(spark, databases, stats)
    counts = [F.count("*").alias("table_count")]
    if stats:
        counts.append(F.sum("record_count").alias("record_count"))
    rolled = tables.rollup("table_schema").agg(F.grouping("table_schema").alias("_g"), *counts)
    label = F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("table_schema"))
    return rolled.withColumn("table_schema", label).drop("_g")


def table_info(spark: SparkSession, table: str) -> DataFrame:
    """Existence, columns, rows and three sample rows as JSON."""
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame(
            [(table, False, None, None, None)],
            "table_name string, table_exists boolean, column_count int, record_count bigint, samples array<string>",
        )
    df = spark.table(table)
    sample = df.limit(3).select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("j")).agg(
        F.collect_list("j").alias("samples")
    )
    return df.agg(F.count("*").alias("record_count")).select(
        F.lit(table).alias("table_name"),
        F.lit(True).alias("table_exists"),
        F.lit(len(df.columns)).alias("column_count"),
        "record_count",
        sample.scalar().alias("samples"),
    )


def layer_schemas(spark: SparkSession, database: str) -> DataFrame:
    """Columns of every table of a layer."""
    rows = [
        (t.name, f.name, f.dataType.simpleString(), i)
        for t in spark.catalog.listTables(database) if not t.isTemporary
        for i, f in enumerate(spark.table(f"`{database}`.`{t.name}`").schema)
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, position int"
    )


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: str | None = None, upper: str | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """Control tables from a database; a partition column splits the read over tasks."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        reader = reader.options(partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
                                numPartitions=str(partitions))
    return reader.load()
