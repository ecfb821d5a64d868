"""Hourly features: spine, calendar parts, cyclic encoding, lags, rolling statistics, folds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import floor_to, instant
from .positions import row_position, with_neighbours

# --- fixed values -----------------------------------------------------------
CYCLE_PERIODS = {"hour": 24, "dayofweek": 7, "month": 12}
LAGS = (1, 2, 24)
ROLLING_WINDOWS = (6, 24)
SPINE_HOURS = (41, 5)       # default scoring window: from now-41h to now-5h
VELOCITY_OFFSET = 1e-6
FOLDS = 10
VALIDATION_SHARE = 0.2
# --- end of fixed values ----------------------------------------------------


def hour_spine(spark: SparkSession, start: dt.datetime, end: dt.datetime, stations: list[str],
               time: str = "READING_DATETIME", station: str = "STATION_ID") -> DataFrame:
    """Every hour of the window for every station; repeated station ids count once."""
    names = F.array(*[F.lit(s) for s in dict.fromkeys(stations)])
    hours = F.sequence(instant(start), instant(end),
                       F.expr("interval 1 hour"))
    return (spark.range(1).select(F.explode(hours).alias(time))
            .withColumn(time, floor_to("hour", F.col(time))).withColumn(station, F.explode(names)))


def default_window(now_utc: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    longest, shortest = SPINE_HOURS
    return now_utc - dt.timedelta(hours=longest), now_utc - dt.timedelta(hours=shortest)


def spine_of(readings: DataFrame, time: str, station: str) -> DataFrame:
    """Every hour between the first and last reading, for every station seen."""
    span = readings.agg(F.struct(F.min(time).alias("a"), F.max(time).alias("b")).alias("s")).scalar()
    return (readings.select(station).distinct()
            .withColumn(time, F.explode(F.sequence(span.getField("a"), span.getField("b"),
                                                   F.expr("interval 1 hour")))))


def time_parts(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns({
        f"hour_{time}": F.hour(time),
        f"dayofweek_{time}": F.weekday(time),
        f"month_{time}": F.month(time),
        f"dayofyear_{time}": F.dayofyear(time),
        f"year_{time}": F.year(time),
    })


def cyclic_encoding(df: DataFrame, time: str) -> DataFrame:
    """Sine and cosine of hour, weekday and month; day of year and year stay plain."""
    new = {}
    for part, period in CYCLE_PERIODS.items():
        angle = 2 * F.pi() * F.col(f"{part}_{time}") / period
        new[f"{part}_{time}_sin"] = F.sin(angle)
        new[f"{part}_{time}_cos"] = F.cos(angle)
    return df.withColumns(new)


def kinematic(df: DataFrame, velocity: str) -> DataFrame:
    v = F.col(velocity)
    return df.withColumns({f"{velocity}_SQ": v * v, f"{velocity}_INV": 1 / (v + F.lit(VELOCITY_OFFSET))})


def lag_and_rolling(df: DataFrame, station: str, position: str, columns: list[str], lags=LAGS,
                    windows=ROLLING_WINDOWS, rows_per_chunk: int = 4096) -> DataFrame:
    """Lags and rolling mean / sample deviation per station, current row included.

    A rolling value needs a full window of non-null rows, otherwise it is null.
    ``position`` is the dense row number per station (see row_position).
    """
    values = {}
    for c in columns:
        for k in lags:
            values[f"{c}_lag_{k}"] = _lag(c, k)
        for w in windows:
            values[f"{c}_rolling_mean_{w}"] = _rolling(F.avg, c, w)
            values[f"{c}_rolling_std_{w}"] = _rolling(F.stddev_samp, c, w)
    reach = max([*lags, *windows])
    return with_neighbours(df, [station], position, reach, rows_per_chunk, **values)


def _lag(column: str, k: int):
    return lambda window: F.lag(column, k).over(window)


def _rolling(function, column: str, width: int):
    def make(window):
        frame = window.rowsBetween(-(width - 1), 0)
        return F.when(F.count(column).over(frame) == width, function(column).over(frame))
    return make


def hour_position(time: str) -> Column:
    """Dense position on a complete hourly spine: hours since 1970."""
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / 3_600_000_000).cast("bigint")


def reading_position(df: DataFrame, station: str, time: str, name: str = "position") -> DataFrame:
    """Dense position per station for readings with gaps, chunked by day."""
    return row_position(df, [station], [F.col(time)], F.to_date(time), name)


def one_hot(df: DataFrame, column: str, values: list[str], prefix: str | None = None) -> DataFrame:
    """0/1 column per fixed value; the list is fixed so that scoring sees every column."""
    prefix = prefix or f"LABEL_{column}"
    return df.withColumns({f"{prefix}_{v}": (F.col(column) == v).cast("int") for v in values}).drop(column)


def from_one_hot(df: DataFrame, column: str, values: list[str], prefix: str | None = None) -> DataFrame:
    """Inverse of one_hot: the value with the largest flag, the first one on a tie."""
    prefix = prefix or f"LABEL_{column}"
    ranked = F.array(*[F.struct(F.col(f"{prefix}_{v}").alias("flag"), F.lit(-i).alias("place"),
                                F.lit(v).alias("value")) for i, v in enumerate(values)])
    return df.withColumn(column, F.array_max(ranked)["value"])


def with_folds(df: DataFrame, time: str, ties: list[str], splits: int = FOLDS,
               validation_share: float = VALIDATION_SHARE) -> DataFrame:
    """Global time-ordered position and, per fold, the part a row belongs to.

    Fold i tests a block of n // (splits + 1) rows and trains on everything before it;
    the last share of the training rows is kept for validation.  Adds ``position`` and
    ``n_rows``; see fold_part.
    """
    placed = row_position(df, [], [F.col(time), *[F.col(c) for c in ties]], floor_to("hour", F.col(time)))
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return placed.withColumn("n_rows", n)


def fold_bounds(fold: Column | int, n_rows: Column, splits: int = FOLDS,
                validation_share: float = VALIDATION_SHARE) -> tuple[Column, Column, Column]:
    """(first validation row, first test row, first row past the test), 0-based."""
    size = F.floor(n_rows / (splits + 1))
    test = n_rows - (splits - (fold if isinstance(fold, Column) else F.lit(fold))) * size
    return F.floor(test * F.lit(1 - validation_share)), test, test + size


def fold_part(fold: Column | int, position: Column, n_rows: Column, splits: int = FOLDS,
              validation_share: float = VALIDATION_SHARE) -> Column:
    """'train', 'validation', 'test' or null for a 1-based position in a 0-based fold."""
    valid, test, past = fold_bounds(fold, n_rows, splits, validation_share)
    place = position - 1
    return (F.when(place < valid, "train").when(place < test, "validation").when(place < past, "test"))


