"""Data checks: null profile and duplicate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(campo, cantidad_total, cantidad_nulos), one row per column, from a single scan."""
    columns = columns or df.columns
    counts = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count(c).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("campo"),
                              F.col("__total").alias("cantidad_total"),
                              (F.col("__total") - F.col(c)).alias("cantidad_nulos")) for c in columns])
    return counts.select(F.inline(rows))


def null_percentages(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Share of nulls in percent, only for columns that have any."""
    profile = null_profile(df, columns)
    share = F.col("cantidad_nulos") * 100 / F.col("cantidad_total")
    return profile.where(F.col("cantidad_nulos") > 0).select("campo", share.alias("pct_nulos"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("conteo")).where(F.col("conteo") > 1)


def rows_with_duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(duplicate_keys(df, keys).drop("conteo"), keys, "left_semi")
