"""Whole-table cleaning rules driven by column names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that make a column a price or a volume.
PRICE_WORDS = ("price", "open", "high", "low", "close")
VOLUME_WORD = "volume"


def standard_names(df: DataFrame) -> DataFrame:
    """Lower case, with spaces and dashes as underscores."""
    return df.toDF(*[re.sub("[ -]", "_", name.lower()) for name in df.columns])


def handle_missing(df: DataFrame) -> DataFrame:
    """Drop rows without a price in exactly-named columns; missing volume is 0."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    required = [c for c in numeric if c.lower() in PRICE_WORDS]
    filled = [c for c in numeric if c.lower() == VOLUME_WORD]
    out = df.dropna(subset=required) if required else df
    return out.fillna(0, subset=filled) if filled else out


def valid_ranges(df: DataFrame) -> DataFrame:
    """Price-like columns above 0, volume-like at least 0; nulls fail.

    The test is on the name *containing* the word, so ``open_interest`` counts
    as price-like.
    """
    out = df
    for name in df.columns:
        low = name.lower()
        col = F.col(f"`{name}`")
        if any(word in low for word in PRICE_WORDS):
            out = out.where(col > 0)
        if VOLUME_WORD in low:
            out = out.where(col >= 0)
    return out


def clean_market_data(df: DataFrame, seen: Observation | None = None, kept: Observation | None = None) -> DataFrame:
    """Dedupe, missing values, ranges and names.

    Pass observations to learn the row counts before and after from the same
    job that writes the result.
    """
    source = df.observe(seen, F.count(F.lit(1)).alias("rows")) if seen else df
    out = standard_names(valid_ranges(handle_missing(source.dropDuplicates())))
    return out.observe(kept, F.count(F.lit(1)).alias("rows")) if kept else out


def cleaning_counts(df: DataFrame) -> DataFrame:
    """Rows before and after cleaning, and the difference, as one row."""
    after = clean_market_data(df).agg(F.count("*").alias("n"))
    return df.agg(F.count("*").alias("original_count")).withColumn(
        "cleaned_count", after.scalar()
    ).withColumn("removed_count", F.col("original_count") - F.col("cleaned_count"))
