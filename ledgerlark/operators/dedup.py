"""Keeping one row per key.

``row_number() = 1`` is planned by Spark with a partial limit before the shuffle,
so each map task sends at most one row per key and a key holding a third of the
table costs one row per task, not a third of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the given order.

    The order must end in something unique, otherwise ties are not repeatable.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK)


def latest_per_key(df: DataFrame, keys: list[str], by: list[str], tie_breakers: list[str] = ()) -> DataFrame:
    """Newest row per key, nulls counting as oldest."""
    return top_per_key(df, keys, [F.desc_nulls_last(c) for c in (*by, *tie_breakers)])


def earliest_per_key(df: DataFrame, keys: list[str], by: list[str], tie_breakers: list[str] = ()) -> DataFrame:
    """Oldest row per key, nulls counting as newest."""
    return top_per_key(df, keys, [F.asc_nulls_last(c) for c in (*by, *tie_breakers)])


def by_priority(df: DataFrame, keys: list[str], priorities: list[Column], order: list[Column]) -> DataFrame:
    """First row per key whose condition comes earliest in ``priorities``, then by ``order``."""
    rank = F.lit(len(priorities) + 1)
    for i in range(len(priorities), 0, -1):
        rank = F.when(priorities[i - 1], i).otherwise(rank)
    return top_per_key(df, keys, [rank.asc(), *order])


def latest_batch(df: DataFrame, keys: list[str], batch: str, tie_breakers: list[str]) -> DataFrame:
    """Newest lot per key; the lot is compared as text."""
    return latest_per_key(df, keys, [batch], tie_breakers)


def newest_batch_then_earliest(df: DataFrame, keys: list[str], batch: str, date: str,
                               tie_breakers: list[str]) -> DataFrame:
    """Newest lot per key, and among what is left the earliest service date.

    The first step leaves one row per key, so both steps rank on one shuffle.
    """
    return top_per_key(df, keys, [F.desc_nulls_last(batch), F.asc_nulls_last(date),
                                  *[F.desc_nulls_last(c) for c in tie_breakers]])


def latest_document(headers: DataFrame, entities: DataFrame, key: str, order: list[str], period_column: str,
                    period: str | Column | None, keep: str | None = "last",
                    header_id: str = "id", entity_id: str = "documento_id",
                    tie_breakers: list[str] = ()) -> DataFrame:
    """Uploads of one period, one per invoice, joined to the pages read from them.

    keep: 'last' newest upload, 'first' oldest upload, None every upload.
    """
    if period is not None:
        headers = headers.where(F.col(period_column) == period)
    ties = [*tie_breakers, header_id]
    if keep == "last":
        headers = latest_per_key(headers, [key], order, ties)
    elif keep == "first":
        headers = earliest_per_key(headers, [key], order, ties)
    return headers.join(entities, headers[header_id] == entities[entity_id], "inner")
