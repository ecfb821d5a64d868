"""Named queries over the shared tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of one folder, read on first use: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = read_table(self.spark, self.folder, name)
        setattr(self, name, table)  # one frame per table, so its columns can be named
        return table


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under a name, with its SQL when SQL can say it."""
    def add(fn: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# Doubles are compared after rounding to six decimals.  Means of cents often end in an
# exact 5 at the seventh place, where two engines may round either way; both sides add
# the same small amount first.
NUDGE = 3.7e-8


def r6(col: Column | str) -> Column:
    return F.round((F.col(col) if isinstance(col, str) else col) + F.lit(NUDGE), 6)


def sql_r6(expression: str) -> str:
    return f"round({expression} + {NUDGE}, 6)"


def r6_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})
