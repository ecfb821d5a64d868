"""Training and scoring of the hourly forecast with gradient-boosted trees."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting
from ..operators import timeseries as ts
from ..operators.aggregates import fill_with_means, regression_metrics
from ..operators.boosting import BoostedModel, BoostParameters
from ..sources.incremental import written

# --- fixed values -----------------------------------------------------------
TOP_FEATURES = 20
STATIONS = ["111286", "111287", "112193", "112233", "112265"]
FEATURES, TARGET = ["VELO", "HUME", "TEMP"], "N_PM25"
TIME, STATION = "READING_DATETIME", "STATION_ID"
PARAMETERS = BoostParameters(
    trees=2590, step=0.035648277949081186, depth=9, row_share=0.9733121035675474, column_share=0.8497416192535173,
    min_gain=0.295633685837714, l1=0.4368808744336672, l2=2.182549739351831, seed=39)
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Trained:
    """The last fold's model, the metrics of each fold and their means, and the predictions of every fold's test rows."""

    model: BoostedModel
    metrics: list[dict]
    averages: dict
    predictions: DataFrame


def training_frame(features: DataFrame, target: DataFrame, stations: list[str] = STATIONS) -> DataFrame:
    """Readings with their target, then every feature; rows without a full history are dropped."""
    return add_features(features.join(target, [TIME, STATION]), False, stations).na.drop()


def scoring_frame(spine: DataFrame, features: DataFrame, target: DataFrame, stations: list[str] = STATIONS) -> DataFrame:
    """Complete hours with means in the gaps, then every feature."""
    joined = spine.join(features, [TIME, STATION], "left").join(target, [TIME, STATION], "left")
    return add_features(fill_with_means(joined.select(TIME, STATION, *FEATURES, TARGET), [*FEATURES, TARGET]), True, stations)


def add_features(df: DataFrame, spine: bool, stations: list[str] = STATIONS) -> DataFrame:
    """Calendar, cyclic, lag, rolling and kinematic features and station flags."""
    df = ts.kinematic(ts.cyclic_encoding(ts.time_parts(df, TIME), TIME), "VELO")
    df = df.withColumn("position", ts.hour_position(TIME)) if spine else ts.reading_position(df, STATION, TIME)
    df = ts.lag_and_rolling(df, STATION, "position", [*FEATURES, TARGET]).drop("position")
    return ts.one_hot(df.withColumn("station", F.col(STATION)), STATION, stations)


def feature_columns(df: DataFrame, targets: list[str], other: list[str]) -> list[str]:
    return [c for c in df.columns if c not in targets and c not in other and not c.startswith((TIME, STATION))]


def fit(df: DataFrame, columns: list[str], target: str, parameters: BoostParameters = PARAMETERS, row: str = "position") -> BoostedModel:
    """One model over all rows of ``df``; ``row`` numbers them."""
    return boosting.fit_boosted(df, columns, target, row, parameters).model()


def train(df: DataFrame, columns: list[str], target: str, parameters: BoostParameters = PARAMETERS, splits: int = ts.FOLDS) -> Trained:
    """Expanding folds in time order, all grown at once; the last fold's model is kept.

    ``df`` comes from with_folds.  The training rows of a fold exclude its validation
    share, so the metrics describe the model as it is validated.
    """
    df = written(df, "fold-features")
    n = df.select("n_rows").first()[0]
    starts = {fold: n - (splits - fold) * (n // (splits + 1)) for fold in range(splits)}
    fitted = boosting.fit_boosted(df, columns, target, "position", parameters,
                                  {fold: f"position <= {math.floor(start * (1 - ts.VALIDATION_SHARE))}" for fold, start in starts.items()})
    scored, model = [], None
    for fold in range(splits):
        model = fitted.model(fold)
        part = ts.fold_part(fold, F.col("position"), F.col("n_rows"), splits)
        scored.append(boosting.predict(df.where(part == "test").withColumn("fold", F.lit(fold + 1)), model))
    predictions = written(reduce(DataFrame.unionByName, scored), "fold-predictions")
    rows = regression_metrics(predictions, target, "prediction", ["fold"]).orderBy("fold").collect()
    metrics = [r.asDict() for r in rows]
    averages = {k: sum(m[k] for m in metrics) / len(metrics) for k in ("rmse", "mae", "r2")}
    return Trained(model, metrics, averages, predictions)


def importances(spark: SparkSession, model: BoostedModel, top: int = TOP_FEATURES) -> DataFrame:
    """Largest feature importances (mean gain of a feature's cuts, as shares), by name."""
    rows = [(name, float(share)) for name, share in model.importances().items()]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature").limit(top))


def save(spark: SparkSession, model: BoostedModel, path: str, version: str) -> str:
    folder = f"{path}/{version}/model"
    boosting.as_table(spark, model).write.mode("overwrite").parquet(folder)
    return folder


def load(spark: SparkSession, path: str, version: str) -> BoostedModel:
    return boosting.from_table(spark.read.parquet(f"{path}/{version}/model"))


def model_columns(df: DataFrame, model: BoostedModel, *keys) -> DataFrame:
    """``keys``, then exactly the columns a model was trained with, in its order; a missing one is an error."""
    return df.select(*keys, *model.columns)


def score(df: DataFrame, path: str, version: str, time: str = TIME, station: str = "station") -> DataFrame:
    """Predictions of a saved model; its columns are taken by name, whatever their order or what else there is."""
    model = load(df.sparkSession, path, version)
    rows = model_columns(df, model, F.col(time).alias("__time"), F.col(station).alias("__station"))
    return boosting.predict(rows, model).select(F.col("__time").alias(time), F.col("__station").alias(STATION), "prediction")


def latest_hour(predictions: DataFrame, now_utc, time: str = TIME) -> DataFrame:
    """Rows of the current local hour only (UTC-5)."""
    local = F.lit(str(now_utc)).cast("timestamp_ntz") - F.expr("interval 5 hours")
    return predictions.where(F.col(time) == ts.floor_to("hour", local))
