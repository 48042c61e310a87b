"""A corpus from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and gives the documents it keeps; the
last one gives the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwell.llm import jaccard, packing, pii, queries, toxicity
from tickwell.llm.frames import table
from tickwell.session import clear_scratch, scratch_mark, scratch_path

ORACLE_SQL = None  # the toxicity model has no counterpart in SQL; tests compare the stages with plain versions


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays."""
    return jaccard.first_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return pii.without_personal_data(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document of a scarce source comes once per epoch."""
    return queries.mixed(docs, added=())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("pii", redact),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it, and its scratch tables go."""
    docs, mark = table(spark, sf_dir, "documents"), scratch_mark(spark)
    for name, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"stage-{name}")
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        clear_scratch(spark, mark, keep=(path,))
    return STAGES[-1][1](spark, docs, sf_dir)
