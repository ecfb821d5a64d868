"""Chunked positions, running values, look-back windows and percentiles against pandas."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlark.operators import timeseries as ts
from ledgerlark.operators.aggregates import exact_percentiles, fill_with_means
from ledgerlark.operators.joins import attach_group, nearby_amount_counts, not_in
from ledgerlark.operators.positions import row_position, running_max


def readings(spark, seed=1):
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for station in ("a", "b"):
        for h in range(120):
            if r.random() < 0.85:
                rows.append((station, start + dt.timedelta(hours=h), None if r.random() < 0.05 else round(r.random() * 9, 2)))
    return spark.createDataFrame(rows, "STATION_ID string, t timestamp_ntz, v double")


def test_lags_and_rolling_match_pandas(spark):
    df = readings(spark)
    placed = ts.reading_position(df, "STATION_ID", "t")
    got = ts.lag_and_rolling(placed, "STATION_ID", "position", ["v"], rows_per_chunk=30).toPandas().sort_values(["STATION_ID", "t"]).reset_index(drop=True)
    pdf = df.toPandas().sort_values(["STATION_ID", "t"]).reset_index(drop=True)
    for station in ("a", "b"):
        expected, mine = pdf[pdf.STATION_ID == station], got[got.STATION_ID == station]
        assert len(expected) == len(mine)
        for k in ts.LAGS:
            np.testing.assert_allclose(mine[f"v_lag_{k}"].to_numpy(float), expected.v.shift(k).to_numpy(float))
        for w in ts.ROLLING_WINDOWS:
            np.testing.assert_allclose(mine[f"v_rolling_mean_{w}"].to_numpy(float), expected.v.rolling(w).mean().to_numpy(float))
            np.testing.assert_allclose(mine[f"v_rolling_std_{w}"].to_numpy(float), expected.v.rolling(w).std().to_numpy(float))


def test_row_position_and_running_max(spark):
    df = readings(spark, 2)
    placed = row_position(df, ["STATION_ID"], [F.col("t")], F.to_date("t"), "p")
    plain = placed.withColumn("q", F.row_number().over(Window.partitionBy("STATION_ID").orderBy("t")))
    assert plain.where("p <> q").count() == 0
    ran = running_max(df, ["STATION_ID"], [F.col("t")], F.to_date("t"), m=F.col("v"))
    check = ran.withColumn("n", F.max("v").over(Window.partitionBy("STATION_ID").orderBy("t")))
    assert check.where("not (m <=> n)").count() == 0


def test_spine_drops_repeated_stations(spark):
    spine = ts.hour_spine(spark, dt.datetime(2024, 1, 1, 0, 20), dt.datetime(2024, 1, 1, 3, 20), ["x", "y", "x"])
    assert spine.count() == 8
    assert spine.agg(F.min("READING_DATETIME")).first()[0] == dt.datetime(2024, 1, 1)


def test_percentiles_of_a_skewed_key(spark):
    r = random.Random(5)
    values = [("hot", r.randrange(10**6)) for _ in range(3000)] + [("cold", 7), ("one", 1), ("one", 2)]
    df = spark.createDataFrame(values, "k string, v int")
    got = {x["k"]: (x["p50"], x["p95"]) for x in exact_percentiles(df, ["k"], "v", {"p50": 0.5, "p95": 0.95}, 50_000.0).collect()}
    for key in ("hot", "cold", "one"):
        data = [v for k, v in values if k == key]
        np.testing.assert_allclose(got[key], np.percentile(data, [50, 95]))


def test_mean_imputation(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,)], "v double")
    assert sorted(r[0] for r in fill_with_means(df, ["v"]).collect()) == [1.0, 2.5, 4.0]


def test_group_columns_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert sorted(r["m"] for r in attach_group(df, ["k"], m=F.max("v")).collect()) == [2, 2, 3]


def test_not_in_null_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    ids = lambda *v: spark.createDataFrame([(i,) for i in v], "id string")
    assert [r[0] for r in not_in(df, "x", [ids("a")]).collect()] == ["b"]
    assert not_in(df, "x", [ids("a"), ids(None)]).count() == 0
    assert not_in(df, "x", [ids()]).count() == 3


def test_nearby_amounts_with_negative_values(spark):
    values = [-105, -100, -1, 0, 3, 49, 50, 51, 101]
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    got = {r["v"]: r["n_near"] for r in nearby_amount_counts(df, df, ["k"], "v", "v", 50).collect()}
    assert got == {float(v): sum(abs(v - w) <= 50 for w in values) for v in values}


def test_one_hot_round_trip(spark):
    df = spark.createDataFrame([("a",), ("b",)], "STATION_ID string")
    again = ts.from_one_hot(ts.one_hot(df, "STATION_ID", ["a", "b"]), "STATION_ID", ["a", "b"])
    assert sorted(r["STATION_ID"] for r in again.collect()) == ["a", "b"]


def test_fold_bounds_match_the_usual_split(spark):
    n, splits = 107, 10
    df = spark.range(1, n + 1).withColumn("n_rows", F.lit(n))
    size = n // (splits + 1)
    for fold, start in enumerate(range(n - splits * size, n, size)):
        parts = {r["part"]: r["c"] for r in df.groupBy(ts.fold_part(fold, F.col("id"), F.col("n_rows"), splits).alias("part")).agg(F.count("*").alias("c")).collect()}
        assert parts["train"] == int(start * 0.8)
        assert parts["train"] + parts["validation"] == start
        assert parts["test"] == size
