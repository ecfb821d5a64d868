"""Row positions, running values and row-based look-back without one task per key.

The order axis is cut into chunks (a day of readings, a thousand turns).  Work that
needs neighbours happens inside (key, chunk); what a chunk needs from the chunks
before it is one number, carried over a table with one row per key and chunk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _carry_join(df: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    renamed = carry.select(*[F.col(k).alias(f"__c_{k}") for k in keys],
                           *[c for c in carry.columns if c not in keys])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in keys])
    return df.join(renamed, condition, "left").drop(*[f"__c_{k}" for k in keys])


def row_position(df: DataFrame, keys: list[str], order: list[Column], chunk: Column,
                 name: str = "position") -> DataFrame:
    """1-based position of each row within its key.

    ``chunk`` must not decrease along ``order``; with no keys the position is global.
    """
    df = df.withColumn("__chunk", chunk)
    where = [*keys, "__chunk"]
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (df.groupBy(*where).agg(F.count(F.lit(1)).alias("__size"))
             .withColumn("__offset", F.coalesce(F.sum("__size").over(before), F.lit(0))).drop("__size"))
    inside = Window.partitionBy(*where).orderBy(*order)
    return (_carry_join(df, sizes, where)
            .withColumn(name, (F.col("__offset") + F.row_number().over(inside)).cast("bigint"))
            .drop("__chunk", "__offset"))


def running_max(df: DataFrame, keys: list[str], order: list[Column], chunk: Column,
                **values: Column) -> DataFrame:
    """Prefix maximum per key; rows that tie on the order see each other."""
    df = df.withColumn("__chunk", chunk)
    where = [*keys, "__chunk"]
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = df.groupBy(*where).agg(*[F.max(c).alias(f"__m_{n}") for n, c in values.items()])
    carry = tops.select(*where, *[F.max(f"__m_{n}").over(before).alias(f"__p_{n}") for n in values])
    inside = Window.partitionBy(*where).orderBy(*order).rangeBetween(Window.unboundedPreceding, 0)
    if len(order) > 1:
        inside = Window.partitionBy(*where).orderBy(*order)
    out = _carry_join(df, carry, where)
    for n, c in values.items():
        out = out.withColumn(n, F.greatest(F.max(c).over(inside), F.col(f"__p_{n}")))
    return out.drop("__chunk", *[f"__p_{n}" for n in values])


def with_neighbours(df: DataFrame, keys: list[str], position: str, reach: int, rows_per_chunk: int = 4096,
                    **values) -> DataFrame:
    """Evaluate window functions that look back at most ``reach`` rows.

    ``position`` is a dense row number per key.  Each chunk of rows also receives the
    last ``reach`` rows of the chunk before it, so a window over (key, chunk) sees all
    it needs and no key is held by a single task.  ``values`` maps a name to a function
    taking the window (ordered by position) and returning a Column.
    """
    if reach > rows_per_chunk:
        raise ValueError(f"a chunk of {rows_per_chunk} rows cannot look back {reach} rows")
    chunk = F.floor(F.col(position) / rows_per_chunk)
    offset = F.pmod(F.col(position), F.lit(rows_per_chunk))
    copies = F.when(offset >= rows_per_chunk - reach, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    spread = df.withColumn("__home", chunk).withColumn("__chunk", F.explode(copies))
    window = Window.partitionBy(*keys, "__chunk").orderBy(position)
    built = spread.select("*", *[make(window).alias(n) for n, make in values.items()])
    return built.where(F.col("__home") == F.col("__chunk")).drop("__home", "__chunk")
