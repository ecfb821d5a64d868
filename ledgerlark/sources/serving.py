"""Stored tables laid out for the way they are read: by period, by key, by page.

* Readings and predictions lie in one partition per day, made at ingest; a day's rows are sorted by key and time, with Parquet bloom filters on the keys.
  A period reads its days, a point lookup reads the row groups of one day that can hold its key.
* A listing is sorted once; its rows are numbered and lie in slabs of consecutive numbers.  A page reads the slab it is in,
  whichever page it is.

All are committed tables, so readers see a whole write or nothing of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import reading_time
from .commits import CommittedTables, partition_value
from .incremental import written

TABLE, DAY, PLACE, SLAB = "rows", "day", "place", "slab"
#: Rows of a slab, and different keys that a bloom filter of a row group expects.
SLAB_ROWS, BLOOM_KEYS = 10_000, 100_000


def write_by_day(df: DataFrame, path: str, time: str, keys: list[str], text_format: bool = False, row_group_bytes: int | None = None) -> None:
    """Append rows to a table by day.  Times written as text are parsed here, once; rows whose time cannot be read are left out."""
    if text_format:
        df = df.withColumn(time, reading_time(F.col(time)))
    options = {f"parquet.bloom.filter.{what}#{key}": value for key in keys for what, value in (("enabled", "true"), ("expected.ndv", str(BLOOM_KEYS)))}
    if row_group_bytes:
        options |= {"parquet.block.size": str(row_group_bytes), "parquet.page.size": str(min(row_group_bytes, 1 << 20))}
    tables = CommittedTables(df.sparkSession, path)
    rows = df.where(F.col(time).isNotNull()).withColumn(DAY, F.to_date(time))
    tables.append(TABLE, tables.stage(TABLE, rows, [DAY], [*keys, time], options))


def _days(spark: SparkSession, path: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    inside = lambda key: start.date() <= dt.date.fromisoformat(partition_value(key, DAY)) <= end.date()
    return CommittedTables(spark, path).read(TABLE, inside).where(F.col(DAY).between(F.lit(start.date()), F.lit(end.date())))


def _instant(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def read_period(spark: SparkSession, path: str, time: str, start: dt.datetime, end: dt.datetime, columns: list[str]) -> DataFrame:
    """Readings of a window, rows with nulls dropped; only the window's days are looked up and read."""
    return _days(spark, path, start, end).where(F.col(time).between(_instant(start), _instant(end))).select(*columns, time).na.drop()


def lookup(spark: SparkSession, path: str, time: str, at: dt.datetime, **equal) -> DataFrame:
    """First stored row of an instant with these key values, in the order of its columns; an empty frame when there is none."""
    rows = _days(spark, path, at, at).where(F.col(time) == _instant(at))
    for name, value in equal.items():
        rows = rows.where(F.col(name) == value)
    rows = rows.drop(DAY)
    return rows.orderBy(*rows.columns).limit(1)


def write_listing(df: DataFrame, path: str, order: list[Column], slab_rows: int = SLAB_ROWS) -> None:
    """Store ``df`` in an order, the remaining columns breaking ties, with each row's ``place`` from 0; an earlier listing is replaced."""
    order = [*order, *[F.col(c) for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]]
    ranged = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()), "listing")
    part = F.shiftright("__id", 33)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    sizes = sizes.select("__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    placed = ranged.withColumn("__part", part).join(F.broadcast(sizes), "__part").withColumn(PLACE, F.col("__id") + F.col("__shift")).drop("__id", "__part", "__shift")
    tables = CommittedTables(df.sparkSession, path)
    state = tables.state().copy()
    state.notes["slab_rows"] = slab_rows
    state.members[TABLE] = tables.stage(TABLE, placed.withColumn(SLAB, F.floor(F.col(PLACE) / slab_rows)), [SLAB], spread="not")
    tables.commit(state)


def page(spark: SparkSession, path: str, number: int, size: int) -> DataFrame:
    """One page of a stored listing in its order, pages counted from 1; only the slabs that hold it are looked up and read."""
    tables, first, past = CommittedTables(spark, path), (number - 1) * size, number * size
    state = tables.state()
    slabs = range(first // state.notes["slab_rows"], (past - 1) // state.notes["slab_rows"] + 1)
    rows = tables.read(TABLE, lambda key: int(partition_value(key, SLAB)) in slabs, state)
    return rows.where((F.col(PLACE) >= first) & (F.col(PLACE) < past)).orderBy(PLACE).limit(size).drop(PLACE, SLAB)
