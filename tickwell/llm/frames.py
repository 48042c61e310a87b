"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwell.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut, safe when executors go."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column | str, of: int) -> Column:
    """``crc32`` of the id as text, modulo ``of``; a null id counts as remainder 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % of, F.lit(0).cast("bigint")).cast("int")


def bounded_sample(rows: DataFrame, limit: int, per: str | None = None) -> DataFrame:
    """At most ``limit`` rows, the smallest by a hash of all their columns.

    Which rows these are depends on the rows alone, not on files, order or
    lost executors; of equal rows any will do.  A first pass counts the rows,
    so that the second sorts little more than it keeps.  With ``per`` every
    value of that column has the same limit, a share of ``limit``.
    """
    columns = rows.columns
    placed = rows.withColumn("_place", F.xxhash64(*[F.col(f"`{c}`") for c in columns], F.lit(17)))
    position = F.pmod("_place", F.lit(PLACES))

    def near(wanted: int, total) -> Column:
        """Positions that hold more than ``wanted`` of ``total`` rows; the smallest come first, so none of them is lost."""
        return position <= F.lit(PLACES * (1.5 * wanted + 10 * wanted ** 0.5)) / total

    if per is None:
        total = rows.select(F.lit(1)).count()
        return placed.where(near(limit, F.lit(max(total, 1)))).orderBy(position, "_place").limit(limit).select(*columns)
    counts = rows.groupBy(per).agg(F.count("*").alias("_count"))
    each = max(1, limit // max(counts.count(), 1))
    common = F.broadcast(counts.orderBy(F.desc("_count"), per).limit(COMMON))  # rows of rarer values all come
    rank = F.row_number().over(Window.partitionBy(per).orderBy(position, "_place"))
    few = placed.join(common, per, "left").where(F.col("_count").isNull() | near(each, F.col("_count"))).withColumn("_rank", rank).where(F.col("_rank") <= each)
    return few.orderBy("_rank", "_place").limit(limit).select(*columns)


PLACES = 1_000_000_007  # positions of a sample's order
COMMON = 1_000  # values whose counts are sent to all executors


def as_ids(values) -> list:
    """Ids that came as texts, since pandas would turn a column of numbers and nulls into doubles."""
    return [None if v is None or v != v else int(v) for v in values]


def whole_numbers(values: list):
    """A nullable column of 64-bit numbers, without a detour over doubles."""
    import numpy as np
    import pandas as pd
    missing = np.array([v is None for v in values], bool)
    return pd.arrays.IntegerArray(np.array([0 if v is None else v for v in values], np.int64), missing)


def fitted(sample: DataFrame, fit) -> bytes:
    """Run ``fit(pandas frame) -> bytes`` over a bounded sample in one task; the model comes back to the driver."""
    import pandas as pd

    def train(batches):
        rows = [b for b in batches if len(b)]
        if rows:
            yield pd.DataFrame({"model": [fit(pd.concat(rows, ignore_index=True))]})

    found = sample.repartition(1).mapInPandas(train, "model binary").first()
    return bytes(found["model"]) if found else fit(pd.DataFrame({c: [] for c in sample.columns}))
