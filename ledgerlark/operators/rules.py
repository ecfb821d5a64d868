"""Audit rules as data: flags, alert rows and the state of each invoice."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import attach_group

OK_MESSAGE = "Factura OK"
OK_STATES = [OK_MESSAGE, "Factura ya registrada en RS"]


@dataclass(frozen=True)
class Rule:
    """Fires when ``condition`` is true; a null condition does not fire."""

    name: str
    condition: Column
    message: Column | str


def rule_flags(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One 0/1 column per rule, in one projection."""
    return df.select("*", *[F.when(c, 1).otherwise(0).alias(n) for n, c in conditions.items()])


def _any_fired(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(r.condition, F.lit(False)) for r in rules], F.lit(False))


def _alerts(rules: list[Rule], ok: Column, ok_message: str) -> Column:
    """An array with a message for each fired rule and for OK, null in the other places; a fired rule's own message may be null."""
    messages = [F.when(r.condition, F.struct(F.lit(r.message).alias("m") if isinstance(r.message, str) else r.message.alias("m"))) for r in rules]
    return F.array(*messages, F.when(ok, F.struct(F.lit(ok_message).alias("m"))))


def explode_rules(df: DataFrame, key: str, rules: list[Rule], keep: list[str], ok_message: str = OK_MESSAGE,
                  unique_key: bool = True) -> DataFrame:
    """One row per fired rule, one OK row per key without any, and the state.

    With one row per key the OK row is decided inside the row: no join, no shuffle.
    Otherwise a row earns its OK only when no row of the same key fired.
    """
    fired = df.withColumn("__any", _any_fired(rules))
    if not unique_key:
        fired = attach_group(fired, [key], __some=F.max("__any")).withColumn("__any", F.col("__some"))
    clean = ~F.col("__any") | F.col(key).isNull()
    rows = fired.select(*keep, F.explode(_alerts(rules, clean, ok_message)).alias("__alert")).where(F.col("__alert").isNotNull())
    return with_state(rows.select(*keep, F.col("__alert.m").alias("reglas_mensaje")))


def with_state(df: DataFrame, message: str = "reglas_mensaje") -> DataFrame:
    return df.withColumn("estado", F.when(F.col(message).isin(OK_STATES), "OK").otherwise("OBSERVADA"))
