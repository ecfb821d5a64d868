"""Reading and writing tables, reports and artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import reading_time


def read_projected(spark: SparkSession, path: str, columns: list[str], filters: list[Column] = (),
                   schema: T.StructType | None = None) -> DataFrame:
    """Filtered, projected scan; both reach the Parquet reader."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    for condition in filters:
        df = df.where(condition)
    return df.select(*columns)


def read_period(df: DataFrame, time: str, start, end, columns: list[str], text_format: bool = False) -> DataFrame:
    """Readings of a window, rows with nulls dropped.

    Times written as text are parsed before they are compared: 'dd/mm/yyyy' does not
    sort as text.
    """
    if text_format:
        df = df.withColumn(time, reading_time(F.col(time)))
    return df.where(F.col(time).between(start, end)).select(*columns, time).na.drop()


def query_source(spark: SparkSession, sql: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with named parameters (:name) and frames by {name}."""
    return spark.sql(sql, args=args or {}, **frames)


def json_records(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """Typed columns from a column of JSON records."""
    return df.withColumn("__r", F.from_json(column, schema)).select("*", "__r.*").drop("__r", column)


def append(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace the whole table; the partition overwrite mode is set per write."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def report_export(df: DataFrame, path: str, period: str) -> str:
    """CSV report of a period, in a folder named by it."""
    folder = f"{path}/alertas_{period}"
    df.write.mode("overwrite").option("header", True).csv(folder)
    return folder


def save_metrics(spark: SparkSession, metrics: list[dict], path: str, version: str) -> str:
    """One JSON artifact per model version: fold metrics and importances."""
    folder = f"{path}/{version}/metrics"
    spark.createDataFrame(metrics).coalesce(1).write.mode("overwrite").json(folder)
    return folder


def serving_lookup(df: DataFrame, **equal) -> DataFrame:
    """First stored row with these values, in the order of its columns; an empty frame when there is none."""
    for name, value in equal.items():
        df = df.where(F.col(name) == value)
    return df.orderBy(*df.columns).limit(1)


def compare_window(predictions: DataFrame, observations: DataFrame, keys: list[str], time: str,
                   predicted: str, observed: str, lower, upper) -> DataFrame:
    """Prediction against observation within a window of time."""
    inside = F.col(time).between(lower, upper)
    joined = predictions.where(inside).join(observations.where(inside), [*keys, time])
    return joined.select(*keys, time, predicted, observed,
                         F.abs(F.col(predicted) - F.col(observed)).alias("abs_error"))


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """One page of an ordered listing, pages counted from 1."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def is_empty(df: DataFrame) -> DataFrame:
    """One row: whether the frame has no rows; only the first row is looked for."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("empty"))
