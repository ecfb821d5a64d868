"""Aggregations with a twist."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_distinct_unless(key: Column, sentinel, value: Column) -> Column:
    """Distinct values, 0 for the sentinel key (use inside agg with ``key`` grouped)."""
    return F.count_distinct(F.when(key != sentinel, value))


def max_where(condition: Column, value: Column) -> Column:
    return F.max(F.when(condition, value))


def any_flag(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)


def monthly_distinct(df: DataFrame, keys: list[str], date: str, value: str, name: str) -> DataFrame:
    """Distinct values per key and calendar month."""
    return (df.groupBy(*keys, F.trunc(date, "MM").alias("periodo"))
            .agg(F.count_distinct(value).alias(name)))


def regression_metrics(df: DataFrame, actual: str, predicted: str, keys: list[str] = ()) -> DataFrame:
    """RMSE, MAE and R2 in one pass (per key when keys are given)."""
    y, p = F.col(actual), F.col(predicted)
    total = F.var_pop(y) * F.count(y)
    return df.where(y.isNotNull() & p.isNotNull()).groupBy(*keys).agg(
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.try_divide(F.sum((y - p) * (y - p)), total)).alias("r2"),
    )


def fill_with_means(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every null takes the mean of its column over the whole frame."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m")).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), means.getField(c)) for c in columns})


def exact_percentiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float],
                      width: float) -> DataFrame:
    """Interpolated percentiles per key without gathering a group's values anywhere.

    Values are counted, then summed per band of ``width``.  The band holding each wanted
    rank is found on the band totals, and only those bands are ranked value by value.
    """
    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v"))
              .agg(F.count(F.lit(1)).alias("__n")))
    counts = counts.withColumn("__band", F.floor(F.col("__v") / F.lit(width)))
    along = Window.partitionBy(*keys).orderBy("__band")
    whole = Window.partitionBy(*keys)
    # one row per key and band of values that occur: small enough for windows per key
    bands = (counts.groupBy(*keys, "__band").agg(F.sum("__n").alias("__bn"))
             .withColumn("__before", F.coalesce(F.sum("__bn").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("__total", F.sum("__bn").over(whole)))
    wanted = []
    for name, q in points.items():
        at = F.lit(float(q)) * (F.col("__total") - 1)
        wanted += [F.struct(F.lit(name).alias("name"), at.alias("at"), edge(at).cast("bigint").alias("rank")) for edge in (F.floor, F.ceil)]
    here = F.filter(F.array(*wanted), lambda w: (w["rank"] >= F.col("__before")) & (w["rank"] < F.col("__before") + F.col("__bn")))
    chosen = (bands.withColumn("__wants", here).where(F.size("__wants") > 0)
              .select(*[F.col(k).alias(f"__c_{k}") for k in keys], F.col("__band").alias("__c_band"), "__before", "__wants"))
    on = reduce(lambda a, b: a & b, [F.col("__band") == F.col("__c_band"), *[F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in keys]])
    inside = Window.partitionBy(*keys, "__band").orderBy("__v")
    ranked = counts.join(chosen, on).withColumn("__upto", F.col("__before") + F.sum("__n").over(inside))
    mine = F.filter("__wants", lambda w: (w["rank"] < F.col("__upto")) & (w["rank"] >= F.col("__upto") - F.col("__n")))
    found = ranked.select(*keys, "__v", F.explode(mine).alias("w")).select(*keys, "__v", "w.name", "w.at")
    edges = found.groupBy(*keys, "name", "at").agg(F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    values = edges.withColumn("p", F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at")))
    return values.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, F.col("p"))).alias(n) for n in points])
