"""Lake tables as partitioned Parquet: append, overwrite by partition, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.functions.scalar import null_safe_join
from tickwell.session import remove_path, scratch_path
from tickwell.sources.files import LINEAGE

PARTITIONS = ("data_date", "exchange", "processing_stage")
SORT = ("symbol", "ts")


def with_lineage(df: DataFrame, data_date=None, exchange=None, stage=None, source_file=None) -> DataFrame:
    """The five load columns; given values win over columns already there."""
    values = {"data_date": data_date, "exchange": exchange, "processing_stage": stage, "source_file": source_file}
    cols = {}
    for name, kind in LINEAGE.items():
        if name == "ingestion_timestamp":
            cols[name] = F.current_timestamp()
        elif values[name] is not None:
            cols[name] = F.lit(values[name]).cast(kind)
        elif name not in df.columns:
            cols[name] = F.lit(None).cast(kind)
    return df.withColumns(cols)


def laid_out(df: DataFrame, partitions: tuple[str, ...] = PARTITIONS, sort: tuple[str, ...] = SORT) -> DataFrame:
    """Rows gathered per partition and sorted inside each file.

    ``rebalance`` lets adaptive execution split a partition that is too big
    and merge small ones, so a hot exchange-day becomes several files instead
    of one slow task.
    """
    by = [c for c in partitions if c in df.columns]
    inner = [c for c in sort if c in df.columns]
    out = df.hint("rebalance", *[F.col(c) for c in by]) if by else df
    return out.sortWithinPartitions(*by, *inner) if by or inner else out


LOOKUP = ("symbol",)  # columns that queries pick values of


def lookup_options(df: DataFrame, lookup: tuple[str, ...] = LOOKUP, values: int = 100_000) -> dict[str, str]:
    """Writer options for Bloom filters of ``lookup`` columns, so that a list of values skips row groups without them.

    Sorted files skip by smallest and largest value as well; the filters help
    where a row group spans many values.  ``values`` are the distinct ones
    expected in a row group.
    """
    return {k: v for c in lookup if c in df.columns for k, v in (
        (f"parquet.bloom.filter.enabled#{c}", "true"), (f"parquet.bloom.filter.expected.ndv#{c}", str(values)))}


def write_partitions(df: DataFrame, path: str, partitions: tuple[str, ...] = PARTITIONS,
                     sort: tuple[str, ...] = SORT, mode: str = "overwrite", lookup: tuple[str, ...] = LOOKUP) -> None:
    """Write by partition, sorted inside each file; overwriting replaces only the partitions in ``df``.

    Folders are replaced one by one as the job commits, so a crash during the
    commit can leave some old and some new; repeating the job mends that, and
    ``versioned`` tables have no such moment.
    """
    by = [c for c in partitions if c in df.columns]
    (
        laid_out(df, partitions, sort).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .options(**lookup_options(df, lookup)).partitionBy(*by).parquet(path)
    )


def append(df: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written: the folder holds more than job markers."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(hadoop))


def read_table(spark: SparkSession, path: str, defaults: dict | None = None) -> DataFrame:
    """A lake table; ``defaults`` adds columns that older files lack (name -> (type, value))."""
    df = spark.read.option("mergeSchema", "true").parquet(path) if defaults else spark.read.parquet(path)
    cols = {}
    for name, (kind, value) in (defaults or {}).items():
        default = F.lit(value).cast(kind)
        cols[name] = F.coalesce(F.col(name), default) if name in df.columns else default
    return df.withColumns(cols) if cols else df


def replace_table(df: DataFrame, name: str, partitions: tuple[str, ...] = (), path: str | None = None) -> None:
    """Create or replace a catalog table from a query, in the warehouse or at ``path``."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)


def create_empty_table(sample: DataFrame, path: str) -> bool:
    """An empty table with the sample's columns and the load columns; False when it exists."""
    spark = sample.sparkSession
    if exists(spark, path):
        return False
    with_lineage(sample).limit(0).write.parquet(path)
    return True


def partition_exists(spark: SparkSession, path: str, exchange: str, data_date: str, stage: str) -> bool:
    """Whether a load key has rows; the filter prunes to one partition."""
    if not exists(spark, path):
        return False
    key = (
        (F.col("data_date") == F.lit(data_date).cast("date")) & (F.col("exchange") == exchange)
        & (F.col("processing_stage") == stage)
    )
    return not spark.read.parquet(path).where(key).isEmpty()


def partition_path(path: str, partitions: tuple[str, ...], values) -> str:
    """Folder of one partition, spelled as Spark spells it."""
    def spelled(value) -> str:
        if value is None or value == "":
            return "__HIVE_DEFAULT_PARTITION__"
        return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\\x7f{[]^" or ord(c) < 32 else c for c in str(value))
    return "/".join([path.rstrip("/"), *[f"{name}={spelled(v)}" for name, v in zip(partitions, values, strict=True)]])


def remove_partitions(spark: SparkSession, path: str, partitions: tuple[str, ...], gone: DataFrame) -> int:
    """Delete the folders of the partitions listed in ``gone``; only names come to the driver, one at a time."""
    removed = 0
    for row in gone.select(*partitions).distinct().toLocalIterator():
        remove_path(spark, partition_path(path, partitions, row))
        removed += 1
    return removed


def upsert(new: DataFrame, path: str, keys: list[str], partitions: tuple[str, ...]) -> None:
    """Replace rows with the same key, keep the others.  Null keys are equal.

    Only partitions that ``new`` touches, or that hold a key of ``new`` (it may
    have moved), are read and written again; to find the latter, the key
    columns of the table are read unless the keys name the partition.  ``new``
    is written to a staging table first, so it is computed once.
    """
    spark = new.sparkSession
    if not exists(spark, path):
        write_partitions(new, path, partitions, ())
        return
    staging = scratch_path(spark, "upsert")
    new.write.parquet(staging)
    staged = spark.read.schema(new.schema).parquet(staging)
    old = spark.read.parquet(path)
    at = list(partitions)
    touched = staged.select(*at).distinct()
    if not set(at) <= set(keys):
        touched = touched.unionByName(null_safe_join(old.select(*dict.fromkeys([*keys, *at])), staged.select(*keys), keys, "left_semi").select(*at)).distinct()
    touched_at = scratch_path(spark, "touched")
    touched.write.parquet(touched_at)
    touched = spark.read.schema(touched.schema).parquet(touched_at)
    kept = null_safe_join(null_safe_join(old, touched, at, "left_semi"), staged.select(*keys), keys, "left_anti")
    result_at = scratch_path(spark, "merged")
    kept.unionByName(staged, allowMissingColumns=True).write.parquet(result_at)
    result = spark.read.parquet(result_at)
    write_partitions(result, path, partitions, ())
    remove_partitions(spark, path, partitions, null_safe_join(touched, result.select(*at).distinct(), at, "left_anti"))
    for used in (staging, touched_at, result_at):
        remove_path(spark, used)


def rewrite(df: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> None:
    """Replace a whole table by a query over itself, through a written copy."""
    spark = df.sparkSession
    staging = scratch_path(spark, "staging")
    df.write.parquet(staging)
    writer = spark.read.parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    remove_path(spark, staging)


def drop_older(spark: SparkSession, path: str, days: int = 90, as_of=None, column: str = "data_date",
               partitions: tuple[str, ...] = ()) -> None:
    """Retention: keep rows not older than ``days`` before ``as_of``; rows without a date stay.

    A table partitioned by the date loses whole folders, and no row is read.
    """
    from tickwell.operators.filters import last_days
    table = spark.read.parquet(path)
    if column in partitions:
        undated = F.col(column).isNull()
        names = table.select(*partitions).distinct()  # partition columns alone: answered from the folder names
        recent = last_days(names, days, as_of, column).unionByName(names.where(undated))
        remove_partitions(spark, path, partitions, null_safe_join(names, recent, list(partitions), "left_anti"))
        return
    rewrite(last_days(table, days, as_of, column).unionByName(table.where(F.col(column).isNull())), path, partitions)


def widen_columns(spark: SparkSession, path: str, types: dict[str, str], partitions: tuple[str, ...] = ()) -> None:
    """Rebuild a table with wider column types."""
    df = spark.read.parquet(path)
    rewrite(df.withColumns({c: F.col(c).cast(t) for c, t in types.items()}), path, partitions)
