"""Writes that can be repeated: period replacement, watermark appends, in-place updates.

Periods and updates are committed: readers (``read_committed``) see all of a write or nothing of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .commits import CommittedTables, Member, partition_value

TABLE = "rows"
#: How a partition without a value is named.
NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"


def shared_folder(spark: SparkSession, name: str) -> str:
    """New folder for a written table, inside the cluster's shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: plans that use it several times start from its files."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``written`` made; no plan may read them any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_committed(spark: SparkSession, path: str, periods: list[str] | None = None) -> DataFrame:
    """The rows of the newest commit, or those of some periods, whose files alone are read."""
    wanted = None if periods is None else lambda key: _unescaped(key.partition("=")[2]) in periods
    return CommittedTables(spark, path).read(TABLE, wanted)


def replace_period(df: DataFrame, path: str, periods: list[str], period_column: str = "processed_date") -> None:
    """Delete the run's periods and insert the rows of ``df``, which must belong to them; other periods stay.

    A period that yields no rows is left empty, so a rerun never keeps what an earlier one wrote.  ``df`` runs once, and the old
    rows stay until all new ones are written.
    """
    tables = CommittedTables(df.sparkSession, path)
    state = tables.state().copy()
    inside = F.col(period_column).cast("string").isin(periods)
    checked = df.where(F.when(inside, True).otherwise(F.raise_error(F.concat(F.lit("row outside the run's periods: "), F.coalesce(F.col(period_column).cast("string"), F.lit("null"))))))
    new = tables.stage(TABLE, checked, [period_column])
    old = state.members.get(TABLE, Member(new.schema, [period_column]))
    kept = {key: parts for key, parts in old.partitions.items() if _unescaped(partition_value(key, period_column)) not in periods}
    state.members[TABLE] = Member(new.schema, [period_column], {**kept, **new.partitions})
    tables.commit(state)


def update_period_rows(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], columns: list[str], period_column: str = "processed_date") -> list[str]:
    """UPDATE … FROM on a committed table: rows that ``updates`` matches on ``keys`` take its ``columns``, nulls included.

    ``updates`` has one row per key.  Only periods that hold a matched row are written anew; their names are returned.
    """
    tables = CommittedTables(spark, path)
    state = tables.state().copy()
    member = state.members[TABLE]
    stored = tables.read(TABLE, state=state)
    changes = updates.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *columns)
    meets = lambda rows, found: [rows[k] == found[f"__k_{k}"] for k in keys]
    touched = {r[0] for r in stored.join(changes, meets(stored, changes), "left_semi").select(F.coalesce(F.col(period_column).cast("string"), F.lit(NO_PERIOD))).distinct().collect()}
    if not touched:
        return []
    inside = lambda key: _unescaped(partition_value(key, period_column)) in touched
    rows = tables.read(TABLE, inside, state)
    on = meets(rows, changes)
    new = tables.stage(TABLE, update_from(rows, changes, on, columns), [period_column])
    kept = {key: parts for key, parts in member.partitions.items() if not inside(key)}
    state.members[TABLE] = Member(member.schema, [period_column], {**kept, **new.partitions})
    tables.commit(state)
    return sorted(touched)


def _unescaped(value: str) -> str:
    """A partition's value from its folder name, where special characters stand as %XX."""
    from urllib.parse import unquote
    return unquote(value)


def newer_than_watermark(source: DataFrame, target: DataFrame, instant: str, same: dict[str, str],
                         key: str) -> DataFrame:
    """Source rows at or after the newest target row of the same kind, without repeats.

    The comparison includes the last instant, whose rows are read again; those whose key
    is already in the target are left out.
    """
    have = target
    for column, value in same.items():
        have = have.where(F.col(column) == value)
    latest = have.agg(F.max(instant).alias("m")).scalar()
    fresh = source.where(F.col(instant) >= F.coalesce(latest, F.lit("1900-01-01").cast("timestamp_ntz")))
    return fresh.join(have.select(key).distinct(), key, "left_anti")


def update_from(df: DataFrame, updates: DataFrame, on: Column | list[Column], columns: list[str]) -> DataFrame:
    """UPDATE … FROM: a matched row takes the new values, nulls included; others keep theirs."""
    marked = updates.withColumn("__hit", F.lit(True))
    joined = df.join(marked, on, "left")
    return joined.select(*[
        F.when(marked["__hit"], marked[c]).otherwise(df[c]).alias(c) if c in columns else df[c]
        for c in df.columns])
