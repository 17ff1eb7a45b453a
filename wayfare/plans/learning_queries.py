"""Queries that train, tune and apply the demand forecast."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfare.operators import features, model
from wayfare.plans import fixtures as fx
from wayfare.plans.fixtures import with_tables
from wayfare.plans.registry import once, query
from wayfare.session import scratch_path, settle
from wayfare.sources import files


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored feature matrix, as training reads it."""
    def write(path: str) -> str:
        files.write_table(features.feature_matrix(fx.slot_trips(spark, sf_dir)), path)
        return path

    return files.read_table(spark, once(spark, sf_dir, "features", write))


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return features.temporal_split(_matrix(spark, sf_dir))


def _model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """Trained once, saved, and loaded by every query that needs it."""
    def fit(path: str) -> str:
        train, _ = _split(spark, sf_dir)
        model.save_model(model.train(train), path)
        return path

    return model.load_model(once(spark, sf_dir, "model", fit))


def _stepped(spark: SparkSession, sf_dir: str, simple: bool) -> DataFrame:
    """Train on a demand that is a step function of the hour: trees must predict it to the last row."""
    step = F.when(F.col("hour_of_day") >= 12, F.lit(11)).otherwise(F.lit(3)).cast("bigint")
    train, test = (part.withColumn("demand", step) for part in _split(spark, sf_dir))
    return model.predict(model.train(train, simple=simple), test).select(
        F.col("zone_id").cast("int").alias("zone_id"), "slot_ts", F.round("prediction", 6).alias("prediction"))


_TEST = with_tables("split_at", "").rstrip() + """,
    test AS (SELECT * FROM features, split_at WHERE slot_date >= cutoff),
    train AS (SELECT * FROM features, split_at WHERE slot_date < cutoff)"""
_STEP = f"""{_TEST}
    SELECT zone_id, slot_ts, CASE WHEN hour_of_day >= 12 THEN 11 ELSE 3 END::DOUBLE AS prediction FROM test"""


@query("ml_gbt", _STEP)
def _(spark, sf_dir):
    return _stepped(spark, sf_dir, simple=False)


@query("ml_gbt_simple", _STEP)
def _(spark, sf_dir):
    return _stepped(spark, sf_dir, simple=True)


@query("ml_predictions", f"""{_TEST}
    SELECT zone_id, count(*) AS n, 0::BIGINT AS not_finite FROM test GROUP BY zone_id""")
def _(spark, sf_dir):
    """The trained model answers every test row."""
    _, test = _split(spark, sf_dir)
    return model.predict(_model(spark, sf_dir), test).groupBy(
        F.col("zone_id").cast("int").alias("zone_id")).agg(
        F.count("*").alias("n"), F.count_if(~F.coalesce(F.abs("prediction") < float("inf"), F.lit(False)))
        .alias("not_finite"))


@query("ml_cv", "SELECT unnest([" + ", ".join(map(str, model.DEPTHS)) + """])::INTEGER AS max_depth,
    true AS chosen_if_best""")
def _(spark, sf_dir):
    """Each depth of the grid, and that the chosen one is that of the least error."""
    train, _ = _split(spark, sf_dir)
    search = model.tune(train)
    errors = [float(rmse) for rmse in search.avgMetrics]
    best = model.best_depth(search)
    rows = [(depth, (depth == best) == (rmse == min(errors))) for depth, rmse in zip(model.DEPTHS, errors)]
    return spark.createDataFrame(rows, "max_depth int, chosen_if_best boolean")


def _second_opinion(predictions: DataFrame, metric: str) -> float:
    return RegressionEvaluator(labelCol="demand", predictionCol="prediction", metricName=metric).evaluate(
        predictions.withColumn("demand", F.col("demand").cast("double")))


@query("ml_eval", f"""{_TEST}
    SELECT count(*) AS n, 0.0::DOUBLE AS rmse_off, 0.0::DOUBLE AS mae_off FROM test""")
def _(spark, sf_dir):
    """The model's errors against those of another implementation."""
    _, test = _split(spark, sf_dir)
    predictions = settle(model.predict(_model(spark, sf_dir), test).select("demand", "prediction"), "predictions")
    return model.evaluate(predictions).select("n", *[
        F.round(F.abs(F.col(m) - F.lit(_second_opinion(predictions, m))), 9).alias(f"{m}_off")
        for m in ("rmse", "mae")])


@query("ml_eval_baseline", with_tables("split_at", "").rstrip() + """,
    test AS (SELECT * FROM features, split_at WHERE slot_date >= cutoff AND demand_lag_7d > 0)
    SELECT sqrt(avg((demand_lag_7d - demand) ** 2)) AS rmse,
      avg(abs(demand_lag_7d - demand)) AS mae, count(*) AS n FROM test""")
def _(spark, sf_dir):
    _, test = _split(spark, sf_dir)
    return model.evaluate(features.baseline(test))


@query("ml_compare", f"""{_TEST}, known AS (SELECT * FROM test WHERE demand_lag_7d > 0)
    SELECT 'rmse' AS metric, round(sqrt(avg((demand_lag_7d - demand) ** 2)), 6) AS naive,
      0.0::DOUBLE AS model_off, true AS consistent FROM known
    UNION ALL SELECT 'mae', round(avg(abs(demand_lag_7d - demand)), 6), 0.0, true FROM known""")
def _(spark, sf_dir):
    _, test = _split(spark, sf_dir)
    predictions = settle(model.predict(_model(spark, sf_dir), test).select("demand", "prediction"), "predictions")
    second = F.create_map(*[F.lit(x) for m in ("rmse", "mae") for x in (m, _second_opinion(predictions, m))])
    return model.compare(predictions, features.baseline(test)).select(
        "metric", F.round("naive", 6).alias("naive"),
        F.round(F.abs(F.col("model") - second[F.col("metric")]), 9).alias("model_off"),
        (F.col("model_is_better") == (F.col("model") < F.col("naive"))).alias("consistent"))


@query("ml_compare_by_zone", f"""{_TEST},
    a AS (SELECT zone_id, count(*) AS n_slots FROM test GROUP BY zone_id),
    b AS (SELECT zone_id, round(sqrt(avg((demand_lag_7d - demand) ** 2)), 6) AS rmse_baseline
      FROM test WHERE demand_lag_7d > 0 GROUP BY zone_id)
    SELECT zone_id, n_slots, rmse_baseline, 0.0::DOUBLE AS model_off FROM a LEFT JOIN b USING (zone_id)""")
def _(spark, sf_dir):
    """The errors by zone; the model's against their spread and mean taken apart."""
    _, test = _split(spark, sf_dir)
    predictions = settle(model.predict(_model(spark, sf_dir), test).select("zone_id", "demand", "prediction"), "predictions")
    miss = F.col("prediction") - F.col("demand")
    second = predictions.groupBy("zone_id").agg(F.sqrt(F.var_pop(miss) + F.avg(miss) * F.avg(miss)).alias("second"))
    return features.compare_by_zone(predictions, features.baseline(test)).join(second, "zone_id").select(
        F.col("zone_id").cast("int").alias("zone_id"), "n_slots", F.round("rmse_baseline", 6).alias("rmse_baseline"),
        F.round(F.abs(F.col("rmse_gbt") - F.col("second")), 6).alias("model_off"))


@query("ml_importance", "SELECT unnest([" + ", ".join(f"'{name}'" for name in features.FEATURES) + """]) AS feature,
    true AS in_range, 1.0::DOUBLE AS total""")
def _(spark, sf_dir):
    """A weight for each feature; together they make 1."""
    train, _ = _split(spark, sf_dir)
    found = model.importances(_model(spark, sf_dir), train)
    total = found.agg(F.round(F.sum("importance"), 9)).first()[0]
    return found.select("feature", F.col("importance").between(0, 1).alias("in_range"), F.lit(total).alias("total"))


@query("sink_model", f"{_TEST} SELECT count(*) AS n, 0::BIGINT AS changed FROM train")
def _(spark, sf_dir):
    """Predictions before the model was saved and after it was loaded."""
    train, _ = _split(spark, sf_dir)
    fitted = model.train(train, simple=True)
    path = scratch_path(spark, "saved-model")
    model.save_model(fitted, path)
    keys = ["zone_id", "slot_ts"]
    before, after = (model.predict(m, train).select(*keys, F.col("prediction").alias(name))
                     for m, name in ((fitted, "before"), (model.load_model(path), "after")))
    return before.join(after, keys, "full").agg(
        F.count("*").alias("n"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("changed"))


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast request for the time of every event, one week on."""
    return fx.table(spark, sf_dir, "events").select(
        (F.col("user_id") % 4 + 1).cast("int").alias("zone_id"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 7 DAYS"), "yyyy-MM-dd'T'HH:mm:ss")
        .alias("datetime"))


@query("ml_request_features", with_tables("slots", """
    SELECT zone_id, "datetime", hour("datetime"::TIMESTAMP)::INTEGER AS hour_of_day,
      (dayofweek("datetime"::TIMESTAMP) + 1)::INTEGER AS day_of_week,
      coalesce((SELECT demand FROM slots s WHERE s.zone_id = q.zone_id
        AND s.slot_ts = q.slot_ts - 86400), 0) AS demand_lag_1d,
      coalesce((SELECT demand FROM slots s WHERE s.zone_id = q.zone_id
        AND s.slot_ts = q.slot_ts - 604800), 0) AS demand_lag_7d, rolling_7d_mean
    FROM (SELECT (user_id % 4 + 1)::INTEGER AS zone_id,
        strftime(ts + INTERVAL 7 DAY, '%Y-%m-%dT%H:%M:%S') AS "datetime",
        epoch_us(ts + INTERVAL 7 DAY) // 1800000000 * 1800 AS slot_ts FROM events) q
    JOIN (SELECT w.zone_id, w.slot_ts, coalesce(avg(s.demand), 0.0) AS rolling_7d_mean
      FROM (SELECT DISTINCT zone_id, slot_ts + 604800 AS slot_ts FROM slots) w
      LEFT JOIN slots s ON s.zone_id = w.zone_id AND s.slot_ts >= w.slot_ts - 604800
        AND s.slot_ts < w.slot_ts GROUP BY ALL) r USING (zone_id, slot_ts)"""))
def _(spark, sf_dir):
    slots = features.slot_demand(fx.slot_trips(spark, sf_dir))
    return model.request_features(_asked(spark, sf_dir), slots).select(
        "zone_id", "datetime", "hour_of_day", "day_of_week", "demand_lag_1d", "demand_lag_7d",
        "rolling_7d_mean")


@query("st_forecast_batch", """
    SELECT CASE user_id % 19 WHEN 0 THEN 'unreadable:datetime' WHEN 1 THEN 'missing:zone_id' END AS reason,
      count(*) AS n, CASE WHEN user_id % 19 > 1 THEN count(*) ELSE 0 END AS answered, 0::BIGINT AS negative
    FROM events GROUP BY 1, user_id % 19 > 1""")
def _(spark, sf_dir):
    """Every request is answered with a forecast, never below 0, or with a reason."""
    slots = features.slot_demand(fx.slot_trips(spark, sf_dir))
    asked = fx.table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 19 != 1, (F.col("user_id") % 4 + 1)).cast("int").alias("zone_id"),
        F.when(F.col("user_id") % 19 == 0, "some day").otherwise(F.date_format(
            F.col("ts") + F.expr("INTERVAL 7 DAYS"), "yyyy-MM-dd'T'HH:mm:ss")).alias("datetime"))
    return model.score(asked, _model(spark, sf_dir), slots).groupBy("reason").agg(
        F.count("*").alias("n"), F.count("predicted_demand").alias("answered"),
        F.count_if(F.col("predicted_demand") < 0).alias("negative"))
