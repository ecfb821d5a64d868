"""Joins beyond the plain equi-join, all of them without pair explosions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Fixed rows as a frame; how it is joined is left to the size Spark sees."""
    return spark.createDataFrame(rows, schema)


def spread_null(df: DataFrame, key: Column) -> Column:
    """A join key as text in which null is a value of its own for each row: it meets nothing, as null would, but
    rows without a key do not all go to one task."""
    return F.coalesce(key.cast("string"), F.concat(F.lit("\x00"), F.xxhash64(*[F.col(c) for c in df.columns]).cast("string")))


def attach_group(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Group aggregates on every row of the group.

    Written as aggregate plus join rather than as a window: the aggregate combines
    before the shuffle, and AQE can split a hot key of the join, whereas a window
    would hold the whole group in one task.
    """
    grouped = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    renamed = grouped.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *aggregates)
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return df.join(renamed, condition, "left").drop(*[f"__k_{k}" for k in keys])


def not_in(df: DataFrame, column: str, excluded: list[DataFrame]) -> DataFrame:
    """``column NOT IN (union of sets)`` with its null rules, as a shuffled anti join.

    One null in the sets empties the result; a null in the column never passes unless
    the sets are empty.  Spark's own null-aware anti join can only broadcast the sets.
    """
    ids = reduce(lambda a, b: a.unionAll(b), [s.select(s.columns[0]) for s in excluded]).toDF("__x")
    stats = ids.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count("__x").alias("known")).alias("s")).scalar()
    kept = df.join(ids.where(F.col("__x").isNotNull()).distinct(), F.col(column) == F.col("__x"), "left_anti")
    return kept.where((stats.getField("n") == 0)
                      | (F.col(column).isNotNull() & (stats.getField("n") == stats.getField("known"))))


def lookup_with_default(df: DataFrame, table: DataFrame, on: Column, defaults: dict[str, Column]) -> DataFrame:
    """Left join to a lookup; missing values take their default."""
    joined = df.join(table, on, "left")
    filled = {name: F.coalesce(table[name], default).alias(name) for name, default in defaults.items()}
    return joined.select(*[df[c] for c in df.columns], *filled.values())


def nearby_date_counts(left: DataFrame, right: DataFrame, keys: list[str], left_date: str, right_date: str,
                       before: int, after: int, name: str = "n_near") -> DataFrame:
    """How many right rows of the same keys lie in [date - before, date + after].

    Right rows are first counted per key and day, then each day's count is added to
    the days it is near to: (before + after + 1) rows per day, never pairs of rows.
    """
    per_day = right.groupBy(*keys, F.to_date(right_date).alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
    spread = (per_day
              .withColumn("__d", F.explode(F.sequence(F.date_sub("__d", after), F.date_add("__d", before))))
              .groupBy(*keys, "__d").agg(F.sum("__n").alias(name)))
    return _left_on(left.withColumn("__d", F.to_date(left_date)), spread, [*keys, "__d"], name).drop("__d")


def nearby_amount_counts(left: DataFrame, right: DataFrame, keys: list[str], left_amount: str, right_amount: str,
                         tolerance: int, name: str = "n_near") -> DataFrame:
    """How many right rows of the same keys have an amount within the tolerance.

    Amounts lose their decimals; they are counted per unit and grouped into bands as
    wide as the tolerance, so a left row meets three bands, each a short sorted list of
    (amount, count) of at most ``tolerance`` distinct units.
    """
    unit, band = F.col(right_amount).cast("bigint"), tolerance
    per_unit = right.groupBy(*keys, unit.alias("__u")).agg(F.count(F.lit(1)).alias("__n"))
    bands = (per_unit.groupBy(*keys, F.floor(F.col("__u") / band).alias("__b"))
             .agg(F.collect_list(F.struct("__u", "__n")).alias("__units"))
             .withColumn("__b", F.explode(F.array(*[F.col("__b") + i for i in (-1, 0, 1)])))
             .groupBy(*keys, "__b").agg(F.flatten(F.collect_list("__units")).alias("__units")))
    probe = (left.withColumn("__u", F.col(left_amount).cast("bigint"))
             .withColumn("__b", F.floor(F.col("__u") / band)))
    joined = _left_on(probe, bands, [*keys, "__b"], "__units")
    inside = F.filter("__units", lambda x: F.abs(x["__u"] - F.col("__u")) <= tolerance)
    total = F.aggregate(inside, F.lit(0).cast("bigint"), lambda acc, x: acc + x["__n"])
    return joined.withColumn(name, F.coalesce(total, F.lit(0).cast("bigint"))).drop("__u", "__b", "__units")


def same_period_counts(left: DataFrame, right: DataFrame, keys: list[str], left_date: str, right_date: str,
                       unit: str, name: str = "n_same") -> DataFrame:
    """How many right rows share the keys and the calendar month ('MM') or day ('DD')."""
    period = (lambda c: F.trunc(c, "MM")) if unit == "MM" else (lambda c: F.to_date(c))
    counts = right.groupBy(*keys, period(right_date).alias("__d")).agg(F.count(F.lit(1)).alias(name))
    return _left_on(left.withColumn("__d", period(left_date)), counts, [*keys, "__d"], name).drop("__d")


def _left_on(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Left join on equal keys; a missing count becomes 0.

    The counts spread over days or bands outgrow what Spark expects of them before it has made them, so a broadcast
    chosen from that would gather them in the driver: they are shuffled and sorted instead.
    """
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], value).hint("merge")
    condition = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__r_{k}") for k in keys])
    joined = left.join(renamed, condition, "left").drop(*[f"__r_{k}" for k in keys])
    if value.startswith("__"):
        return joined
    return joined.withColumn(value, F.coalesce(value, F.lit(0).cast("bigint")))


def inside_validity(df: DataFrame, ranges: DataFrame, on: list[str], date: str, start: str, end: str,
                    name: str) -> DataFrame:
    """Flag an event outside the [start, end] of its policy row (one row per key)."""
    joined = df.join(ranges, on, "left")
    outside = ~F.col(date).between(F.col(start), F.col(end)) & F.col(end).isNotNull() & F.col(date).isNotNull()
    return joined.withColumn(name, F.when(outside, 1).otherwise(0))


def bridge(originals: DataFrame, reprocessed: DataFrame, entities: DataFrame, path: str,
           original_id: str, reprocessed_id: str, entity_id: str) -> DataFrame:
    """Entities of reprocessed files under the id of the original file with the same path."""
    ids = (originals.select(F.col(original_id).alias("__original"), F.col(path).alias("__path"))
           .join(reprocessed.select(F.col(reprocessed_id).alias("__copy"), F.col(path).alias("__path2")),
                 F.col("__path") == F.col("__path2"))
           .select("__original", "__copy"))
    return (entities.join(ids, F.col(entity_id) == F.col("__copy"))
            .withColumn(entity_id, F.col("__original")).drop("__original", "__copy"))
