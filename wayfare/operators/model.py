"""Demand forecasting: training, tuning, evaluation, scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from wayfare.functions.times import calendar_parts, slot_start_seconds
from wayfare.operators.features import FEATURES, SLOT, TARGET, cast_numeric, history_at

SEED = 42
DEPTHS = (5, 7)
FOLDS = 3


def build_pipeline(simple: bool = False, rounds: int | None = None, label: str = TARGET) -> Pipeline:
    """Assembler, scaler and boosted trees (50 rounds); the simple form has no scaler (10 rounds)."""
    if simple:
        return Pipeline(stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="features"),
            GBTRegressor(featuresCol="features", labelCol=label, maxIter=rounds or 10)])
    return Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        GBTRegressor(featuresCol="features", labelCol=label, maxIter=rounds or 50, seed=SEED)])


def train(features: DataFrame, simple: bool = False, rounds: int | None = None,
          label: str = TARGET) -> PipelineModel:
    """Fit on the feature matrix; it is small next to the trips it sums up, and read many times."""
    rows = cast_numeric(features.dropna(subset=[label]), [*FEATURES, label]).persist()
    try:
        return build_pipeline(simple, rounds, label).fit(rows)
    finally:
        rows.unpersist()


def tune(features: DataFrame, depths: tuple[int, ...] = DEPTHS, folds: int = FOLDS,
         rounds: int | None = None, parallelism: int = 2) -> CrossValidatorModel:
    """Choose the tree depth by cross-validation on RMSE."""
    pipeline = build_pipeline(rounds=rounds)
    grid = ParamGridBuilder().addGrid(pipeline.getStages()[-1].maxDepth, list(depths)).build()
    search = CrossValidator(
        estimator=pipeline, estimatorParamMaps=grid, numFolds=folds, parallelism=parallelism,
        seed=SEED, evaluator=RegressionEvaluator(
            labelCol=TARGET, predictionCol="prediction", metricName="rmse"))
    rows = cast_numeric(features.dropna(subset=[TARGET])).persist()
    try:
        return search.fit(rows)
    finally:
        rows.unpersist()


def best_depth(search: CrossValidatorModel) -> int:
    return search.bestModel.stages[-1].getOrDefault("maxDepth")


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Predictions beside the numeric features."""
    return model.transform(cast_numeric(features)).drop("raw_features", "features")


def evaluate(predictions: DataFrame) -> DataFrame:
    """RMSE and MAE in one pass."""
    error = F.col("prediction") - F.col(TARGET)
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"),
                           F.avg(F.abs(error)).alias("mae"), F.count("*").alias("n"))


def compare(model: DataFrame, naive: DataFrame) -> DataFrame:
    """Model against baseline, one row per metric."""
    both = evaluate(model).withColumn("who", F.lit("model")).unionAll(
        evaluate(naive).withColumn("who", F.lit("naive")))
    long = both.unpivot("who", ["rmse", "mae"], "metric", "value")
    return long.groupBy("metric").agg(
        F.max(F.when(F.col("who") == "model", F.col("value"))).alias("model"),
        F.max(F.when(F.col("who") == "naive", F.col("value"))).alias("naive"),
    ).withColumn("model_is_better", F.col("model") < F.col("naive"))


def importances(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Feature importances, greatest first."""
    weights = model.stages[-1].featureImportances.toArray()
    return features.sparkSession.createDataFrame(
        [(name, float(weight)) for name, weight in zip(FEATURES, weights)],
        "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests that can be answered, and the others with the ``reason``."""
    reason = F.when(F.col("zone_id").isNull(), "missing:zone_id").when(
        F.col("datetime").isNull(), "missing:datetime").when(
        F.col("datetime").try_cast("timestamp_ntz").isNull(), "unreadable:datetime")
    told = requests.withColumn("reason", reason)
    return told.filter("reason IS NULL").drop("reason"), told.filter("reason IS NOT NULL")


def request_features(requests: DataFrame, slots: DataFrame) -> DataFrame:
    """Features for (zone_id, datetime) rows, with lags and means looked up in the demand table.

    The calendar is the one used in training. Takes readable requests; ``split_requests`` sorts out
    the others.
    """
    asked = requests.withColumn("_at", F.col("datetime").try_cast("timestamp_ntz")).withColumn(
        "slot_ts", slot_start_seconds(F.col("_at"), SLOT))
    wanted = asked.select("zone_id", "slot_ts").distinct()
    history = history_at(wanted, slots)
    return asked.join(history, ["zone_id", "slot_ts"], "left").withColumns({
        **calendar_parts(F.col("_at")), "is_raining": F.lit(0)}).drop("_at")


def score(requests: DataFrame, model: PipelineModel, slots: DataFrame) -> DataFrame:
    """Forecasts for (zone_id, datetime) rows, never below 0; a null and the reason where there is none."""
    readable, rejected = split_requests(requests)
    rows = request_features(readable, slots)
    numeric = rows.select(
        F.col("zone_id").alias("_zone"), "datetime",
        *[F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in FEATURES])
    return model.transform(numeric).select(
        F.col("_zone").alias("zone_id"), "datetime",
        F.greatest(F.lit(0.0), "prediction").alias("predicted_demand"),
        F.lit(None).cast("string").alias("reason")).unionByName(rejected.select(
            "zone_id", "datetime", F.lit(None).cast("double").alias("predicted_demand"), "reason"))
