"""Hourly series published as chart pages: find the chart, read its literal leniently, list the points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
CHART_CALL = r"(?s)Highcharts\.chart\('container',\s*(\{.*\})\);"
CHART_SCHEMA = "xAxis struct<categories: array<string>>, series array<struct<data: array<double>>>"
# --- end of fixed values ----------------------------------------------------


# What the JSON reader accepts of a script's object literal by itself, and the one thing it does not: a comma
# before a closing bracket, with nothing but blanks and comments between.
LENIENT = {"allowComments": "true", "allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}
_DANGLING_COMMA = r"(?s),(?=(?:\s|//[^\n]*\n|/\*.*?\*/)*[}\]])"


def chart_config(page: Column) -> Column:
    """Object literal of a page's chart; '' when the page has no chart."""
    return F.regexp_replace(F.regexp_extract(page, CHART_CALL, 1), _DANGLING_COMMA, "")


def extract_chart_series(pages: DataFrame, page: str, time: str = "READING_DATETIME",
                         value: str = "value") -> DataFrame:
    """One row per point of the page's first series; a broken chart yields no rows."""
    chart = F.from_json(chart_config(F.col(page)), CHART_SCHEMA, LENIENT)
    zipped = F.arrays_zip(F.col("__chart.xAxis.categories").alias("time"),
                          F.get(F.col("__chart.series"), F.lit(0))["data"].alias("value"))
    return (pages.withColumn("__chart", chart).withColumn("__points", zipped).drop(page, "__chart")
            .select("*", F.explode("__points").alias("__p"))
            .select("*", F.col("__p.time").alias(time), F.col("__p.value").alias(value))
            .drop("__points", "__p"))


def wide_readings(series: DataFrame, keys: list[str], variable: str, value: str, variables: list[str]) -> DataFrame:
    """One row per key with a column per variable; a repeated point keeps its largest value."""
    return series.groupBy(*keys).pivot(variable, variables).agg(F.max(value))
