"""Hourly readings, features, folds and scores; event types stand in for stations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import floor_to
from ..operators import aggregates as agg
from ..operators import timeseries as ts
from ..plans import forecast as model
from ..sources import io
from ..sources.incremental import shared_folder, written
from .registry import Tables, query, r6, r6_columns, sql_r6

TIME, STATION = "READING_DATETIME", "STATION_ID"
VARIABLES = ["VELO", "HUME", "TEMP", "N_PM25"]


def hourly_readings(t: Tables) -> DataFrame:
    return (t.events.groupBy(F.col("event_type").alias(STATION), floor_to("hour", F.col("ts")).alias(TIME))
            .agg(F.avg("value").alias("VELO"), F.max("value").alias("HUME"),
                 F.min("value").alias("TEMP"), F.sum("value").alias("N_PM25")))


HOURLY = """hourly AS (
  SELECT event_type AS STATION_ID, date_trunc('hour', ts) AS READING_DATETIME, avg(value) AS VELO,
         max(value) AS HUME, min(value) AS TEMP, sum(value) AS N_PM25
  FROM events GROUP BY 1, 2)"""
SPINE = """spine AS (
  SELECT s.STATION_ID, h.READING_DATETIME
  FROM (SELECT DISTINCT event_type AS STATION_ID FROM events) s,
       (SELECT unnest(generate_series((SELECT min(READING_DATETIME) FROM hourly),
                                      (SELECT max(READING_DATETIME) FROM hourly), INTERVAL 1 HOUR))
               AS READING_DATETIME) h)"""
FILLED = """filled AS (
  SELECT s.STATION_ID, s.READING_DATETIME,
         coalesce(VELO, (SELECT avg(VELO) FROM joined)) AS VELO,
         coalesce(HUME, (SELECT avg(HUME) FROM joined)) AS HUME,
         coalesce(TEMP, (SELECT avg(TEMP) FROM joined)) AS TEMP,
         coalesce(N_PM25, (SELECT avg(N_PM25) FROM joined)) AS N_PM25
  FROM joined s)"""
JOINED = "joined AS (SELECT * FROM spine LEFT JOIN hourly USING (STATION_ID, READING_DATETIME))"


def filled_readings(t: Tables) -> DataFrame:
    readings = written(hourly_readings(t), "hourly")
    spine = ts.spine_of(readings, TIME, STATION)
    return agg.fill_with_means(spine.join(readings, [STATION, TIME], "left"), VARIABLES)


def hourly_features(t: Tables) -> DataFrame:
    df = filled_readings(t)
    df = ts.kinematic(ts.cyclic_encoding(ts.time_parts(df, TIME), TIME), "VELO")
    df = df.withColumn("position", ts.hour_position(TIME))
    df = ts.lag_and_rolling(df, STATION, "position", VARIABLES, rows_per_chunk=240)
    return df.drop("position").na.drop()


def _lag_sql() -> str:
    parts = []
    for c in VARIABLES:
        for k in ts.LAGS:
            parts.append(f"lag({c}, {k}) OVER w AS {c}_lag_{k}")
        for k in ts.ROLLING_WINDOWS:
            frame = f"(PARTITION BY STATION_ID ORDER BY READING_DATETIME ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
            parts.append(f"CASE WHEN count({c}) OVER {frame} = {k} THEN avg({c}) OVER {frame} END AS {c}_rolling_mean_{k}")
            parts.append(f"CASE WHEN count({c}) OVER {frame} = {k} THEN stddev_samp({c}) OVER {frame} END AS {c}_rolling_std_{k}")
    return ",\n  ".join(parts)


TIME_PARTS = f"""hour({TIME})::INTEGER AS hour_{TIME}, (isodow({TIME}) - 1)::INTEGER AS dayofweek_{TIME},
  month({TIME})::INTEGER AS month_{TIME}, dayofyear({TIME})::INTEGER AS dayofyear_{TIME},
  year({TIME})::INTEGER AS year_{TIME}"""
FEATURE_DOUBLES = (
    VARIABLES + ["VELO_SQ", "VELO_INV"]
    + [f"{p}_{TIME}_{f}" for p in ts.CYCLE_PERIODS for f in ("sin", "cos")]
    + [f"{c}_lag_{k}" for c in VARIABLES for k in ts.LAGS]
    + [f"{c}_rolling_{s}_{k}" for c in VARIABLES for k in ts.ROLLING_WINDOWS for s in ("mean", "std")])


def _cyclic_sql() -> str:
    return ", ".join(f"sin(2 * pi() * {p}_{TIME} / {n}) AS {p}_{TIME}_sin, cos(2 * pi() * {p}_{TIME} / {n}) AS {p}_{TIME}_cos"
                     for p, n in ts.CYCLE_PERIODS.items())


FLAGSHIP_SQL = f"""
WITH {HOURLY}, {SPINE}, {JOINED}, {FILLED},
parts AS (SELECT *, {TIME_PARTS} FROM filled),
lagged AS (
  SELECT *, {_cyclic_sql()}, VELO * VELO AS VELO_SQ, 1 / (VELO + 1e-6) AS VELO_INV,
  {_lag_sql()}
  FROM parts WINDOW w AS (PARTITION BY STATION_ID ORDER BY READING_DATETIME))
SELECT STATION_ID, {TIME}, hour_{TIME}, dayofweek_{TIME}, month_{TIME}, dayofyear_{TIME}, year_{TIME},
  {", ".join(f"{sql_r6(c)} AS {c}" for c in FEATURE_DOUBLES)}
FROM lagged WHERE VELO_lag_24 IS NOT NULL
"""


@query("flagship_hourly_features", FLAGSHIP_SQL)
def _flagship(t):
    return r6_columns(hourly_features(t), FEATURE_DOUBLES)


@query("m1_time_parts", f"SELECT event_id, {TIME_PARTS} FROM (SELECT event_id, ts AS {TIME} FROM events)")
def _(t):
    return ts.time_parts(t.events.select("event_id", F.col("ts").alias(TIME)), TIME).drop(TIME)


_CYCLES = [f"{p}_{TIME}_{f}" for p in ts.CYCLE_PERIODS for f in ("sin", "cos")]


@query("m2_cyclic_encoding", f"""
SELECT event_id, {", ".join(f"{sql_r6(c)} AS {c}" for c in _CYCLES)} FROM (SELECT *, {_cyclic_sql()} FROM (SELECT event_id, {TIME_PARTS} FROM (SELECT event_id, ts AS {TIME} FROM events)))""")
def _(t):
    parts = ts.time_parts(t.events.select("event_id", F.col("ts").alias(TIME)), TIME)
    return r6_columns(ts.cyclic_encoding(parts, TIME).select("event_id", *_CYCLES), _CYCLES)


@query("m3_kinematic", f"SELECT event_id, {sql_r6('value * value')} AS VELO_SQ, {sql_r6('1 / (value + 1e-6)')} AS VELO_INV FROM events")
def _(t):
    df = ts.kinematic(t.events.select("event_id", F.col("value").alias("VELO")), "VELO")
    return r6_columns(df.select("event_id", "VELO_SQ", "VELO_INV"), ["VELO_SQ", "VELO_INV"])


KINDS = ["click", "error", "purchase", "signup", "view"]


@query("m4_one_hot", "SELECT event_id, " + ", ".join(f"CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END AS LABEL_STATION_ID_{k}" for k in KINDS) + " FROM events")
def _(t):
    return ts.one_hot(t.events.select("event_id", F.col("event_type").alias("STATION_ID")), "STATION_ID", KINDS)


@query("m6_spine", f"WITH {HOURLY}, {SPINE} SELECT * FROM spine")
def _(t):
    return ts.spine_of(hourly_readings(t), TIME, STATION)


@query("m7_scoring_source", f"WITH {HOURLY}, {SPINE}, {JOINED}, {FILLED} SELECT STATION_ID, {TIME}, {', '.join(f'{sql_r6(c)} AS {c}' for c in VARIABLES)} FROM filled")
def _(t):
    return r6_columns(filled_readings(t), VARIABLES)


_FLAGS = [f"LABEL_{STATION}_{k}" for k in KINDS]
_FEATURE_LIST = f"""{TIME}, hour_{TIME}, dayofweek_{TIME}, month_{TIME}, dayofyear_{TIME}, year_{TIME}, STATION_ID AS station,
  {", ".join(f"CASE WHEN STATION_ID = '{k}' THEN 1 ELSE 0 END AS LABEL_STATION_ID_{k}" for k in KINDS)}, {", ".join(f"{sql_r6(c)} AS {c}" for c in FEATURE_DOUBLES)}"""


def _features_sql(source: str, where: str = "") -> str:
    return f"""parts AS (SELECT *, {TIME_PARTS} FROM {source}),
lagged AS (SELECT *, {_cyclic_sql()}, VELO * VELO AS VELO_SQ, 1 / (VELO + 1e-6) AS VELO_INV, {_lag_sql()} FROM parts WINDOW w AS (PARTITION BY STATION_ID ORDER BY READING_DATETIME))
SELECT {_FEATURE_LIST} FROM lagged {where}"""


def _sources(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Readings, their features and their target, as the two jobs take them."""
    readings = written(hourly_readings(t), "hourly")
    return readings, readings.select(TIME, STATION, *model.FEATURES), readings.select(TIME, STATION, model.TARGET)


@query("m7_scoring_frame", f"WITH {HOURLY}, {SPINE}, {JOINED}, {FILLED}, {_features_sql('filled')}")
def _(t):
    readings, features, target = _sources(t)
    return r6_columns(model.scoring_frame(ts.spine_of(readings, TIME, STATION), features, target, KINDS), FEATURE_DOUBLES)


@query("m9_training_frame", f"WITH {HOURLY}, {_features_sql('hourly', 'WHERE VELO_lag_24 IS NOT NULL')}")
def _(t):
    _, features, target = _sources(t)
    return r6_columns(model.training_frame(features, target, KINDS), FEATURE_DOUBLES)


@query("m12_latest_hour", f"WITH {HOURLY} SELECT STATION_ID, {TIME}, {sql_r6('N_PM25')} AS prediction FROM hourly WHERE {TIME} = (SELECT max({TIME}) FROM hourly)")
def _(t):
    readings = written(hourly_readings(t), "hourly")
    newest = readings.agg(F.max(TIME)).first()[0]
    stored = readings.select(STATION, TIME, F.col("N_PM25").alias("prediction"))
    return r6_columns(model.latest_hour(stored, newest + dt.timedelta(hours=5, minutes=59)), ["prediction"])


@query("m6_default_window", """SELECT READING_DATETIME, STATION_ID FROM (SELECT unnest(generate_series(date_trunc('hour', max(ts)) - INTERVAL 41 HOUR, date_trunc('hour', max(ts)) - INTERVAL 5 HOUR, INTERVAL 1 HOUR))::TIMESTAMP AS READING_DATETIME FROM events),
  (SELECT DISTINCT event_type AS STATION_ID FROM events)""")
def _(t):
    now = t.events.agg(F.max(floor_to("hour", F.col("ts")))).first()[0]
    return ts.hour_spine(t.spark, *ts.default_window(now), [*KINDS, KINDS[0]])


_FOLDS_SQL = f"""WITH {HOURLY}, placed AS (SELECT *, row_number() OVER (ORDER BY {TIME}, STATION_ID) - 1 AS place, count(*) OVER () AS n FROM hourly),
bounds AS (SELECT *, fold, n - (10 - fold) * (n // 11) AS test, n // 11 AS size FROM placed, (SELECT unnest(range(10))::INTEGER AS fold)),
parts AS (SELECT fold, CASE WHEN place < floor(test * 0.8) THEN 'train' WHEN place < test THEN 'validation' WHEN place < test + size THEN 'test' END AS part FROM bounds)
SELECT fold, part, count(*) AS n FROM parts WHERE part IS NOT NULL GROUP BY 1, 2"""


@query("m8_fold_sizes", _FOLDS_SQL)
def _(t):
    placed = ts.with_folds(hourly_readings(t), TIME, [STATION])
    folds = placed.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(ts.FOLDS)])))
    parts = folds.withColumn("part", ts.fold_part(F.col("fold"), F.col("position"), F.col("n_rows")))
    return parts.where(F.col("part").isNotNull()).groupBy("fold", "part").agg(F.count(F.lit(1)).alias("n"))


_TRAINED: dict[tuple[str, str], tuple[str, model.Trained]] = {}
VERSION = "1_0_0"


def _trained(t: Tables) -> tuple[str, model.Trained]:
    """The model of the whole training frame with the default parameters and folds, saved; one session trains it once for all queries."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _TRAINED:
        _, features, target = _sources(t)
        df = ts.with_folds(written(model.training_frame(features, target, KINDS), "training-frame"), TIME, ["station"])
        result = model.train(df, model.feature_columns(df, [model.TARGET], ["station", "position", "n_rows"]), model.TARGET)
        path = shared_folder(t.spark, "artifacts")
        model.save(t.spark, result.model, path, VERSION)
        _TRAINED[key] = path, result
    return _TRAINED[key]


_FULL = f"complete AS (SELECT *, row_number() OVER (ORDER BY {TIME}, STATION_ID) - 1 AS place, count(*) OVER () AS n FROM (SELECT *, lag(VELO, 24) OVER (PARTITION BY STATION_ID ORDER BY {TIME}) AS earlier FROM hourly) WHERE earlier IS NOT NULL)"
_TESTED = f"tested AS (SELECT fold + 1 AS fold, STATION_ID, {TIME}, N_PM25 FROM complete, (SELECT unnest(range(10))::INTEGER AS fold) WHERE place >= n - (10 - fold) * (n // 11) AND place < n - (9 - fold) * (n // 11))"


@query("m9_boosted_trees", f"WITH {HOURLY}, {_FULL}, {_TESTED} SELECT fold, STATION_ID AS station, {TIME}, {sql_r6('N_PM25')} AS N_PM25, TRUE AS predicted FROM tested")
def _(t):
    rows = _trained(t)[1].predictions
    predicted = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return rows.select("fold", "station", TIME, r6("N_PM25").alias("N_PM25"), predicted.alias("predicted"))


@query("m9_fold_predictions")
def _(t):
    return _trained(t)[1].predictions.select("fold", "station", TIME, "N_PM25", "prediction")


@query("m11_importances")
def _(t):
    return model.importances(t.spark, _trained(t)[1].model)


@query("m11_importance_facts", "SELECT 20::BIGINT AS features, TRUE AS descending, TRUE AS shares")
def _(t):
    top = model.importances(t.spark, _trained(t)[1].model)
    listed = top.agg(F.count_distinct("feature").alias("features"), F.sort_array(F.collect_list("importance"), False).alias("sorted"), F.sum("importance").alias("sum"))
    ordered = F.forall(F.transform("sorted", lambda x, i: x >= F.coalesce(F.get("sorted", i + 1), F.lit(0.0))), lambda x: x)
    return listed.select("features", ordered.alias("descending"), ((F.col("sum") > 0.3) & (F.col("sum") <= 1 + 1e-9)).alias("shares"))


def _scored(t: Tables) -> DataFrame:
    """The scoring frame of every complete hour through the saved model."""
    readings, features, target = _sources(t)
    frame = written(model.scoring_frame(ts.spine_of(readings, TIME, STATION), features, target, KINDS).na.drop(), "scoring-frame")
    return model.score(frame, _trained(t)[0], VERSION)


@query("m12_batch_score")
def _(t):
    return _scored(t)


@query("m12_scored_rows", f"WITH {HOURLY}, {SPINE} SELECT STATION_ID, {TIME}, TRUE AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY STATION_ID ORDER BY {TIME}) AS place FROM spine) WHERE place > 24")
def _(t):
    return _scored(t).select(STATION, TIME, (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("predicted"))


@query("s10_saved_metrics")
def _(t):
    path, result = _trained(t)
    return t.spark.read.json(io.save_metrics(t.spark, result.metrics, path, VERSION))


@query("s10_metric_facts", f"""WITH {HOURLY}, {_FULL}, {_TESTED}
SELECT fold, count(*) AS rows, {sql_r6('avg(N_PM25)')} AS mean, TRUE AS rmse_agrees, TRUE AS mae_agrees, TRUE AS r2_agrees FROM tested GROUP BY fold""")
def _(t):
    """Saved metrics against sums over the stored predictions."""
    path, result = _trained(t)
    saved = t.spark.read.json(io.save_metrics(t.spark, result.metrics, path, VERSION))
    error, y = F.col("N_PM25") - F.col("prediction"), F.col("N_PM25")
    sums = result.predictions.groupBy(F.col("fold").cast("bigint").alias("fold")).agg(
        F.count(F.lit(1)).alias("rows"), r6(F.avg(y)).alias("mean"), F.sum(error * error).alias("sse"), F.sum(F.abs(error)).alias("sae"), F.sum(y * y).alias("syy"), F.sum(y).alias("sy"))
    near = lambda a, b: F.abs(a - b) <= 1e-6 * (1 + F.abs(b))
    n = F.col("rows")
    return sums.join(saved, "fold").select(
        F.col("fold").cast("int").alias("fold"), "rows", "mean", near(F.col("rmse"), F.sqrt(F.col("sse") / n)).alias("rmse_agrees"),
        near(F.col("mae"), F.col("sae") / n).alias("mae_agrees"), near(F.col("r2"), 1 - F.col("sse") / (F.col("syy") - F.col("sy") * F.col("sy") / n)).alias("r2_agrees"))
