from __future__ import annotations

import datetime
import random

from pyspark.sql import functions as F

from wayfare.functions.times import event_timestamp
from wayfare.operators import demand, features, kpi, model

EVENT = "kind string, zone_id int, event_time long, entity_id string"


def windows(spark, *rows):
    df = spark.createDataFrame(list(rows), EVENT).withColumns({
        "city": F.lit("X"), "event_ts": event_timestamp(F.col("event_time"), "s")})
    out = demand.demand_windows(df).collect()
    return {(r.zone_id, r.window_start): (r.active_vehicles, r.pending_requests, r.ratio)
            for r in out}


def test_ratio_with_and_without_vehicles(spark):
    trips = [("trip", 1, 5, str(i)) for i in range(3)]
    taxis = [("vehicle", 2, 5, "a"), ("vehicle", 2, 6, "b")]
    got = windows(spark, *trips, *[("trip", 2, 5, str(i)) for i in range(3)], *taxis)
    assert got == {(1, 0): (0, 3, 3.0), (2, 0): (2, 3, 1.5)}


def test_entities_count_once_per_window(spark):
    got = windows(spark, ("vehicle", 1, 5, "a"), ("vehicle", 1, 29, "a"), ("vehicle", 1, 30, "a"),
                  ("trip", 1, 7, "a"))
    assert got == {(1, 0): (1, 1, 1.0), (1, 30_000): (1, 0, 0.0)}


def test_one_busy_zone_does_not_change_the_counts(spark):
    rows = [("vehicle", 1, i % 60, str(i % 700)) for i in range(5000)]
    rows += [("trip", 2 + i % 3, i % 60, str(i)) for i in range(100)]
    got = windows(spark, *rows)
    expected = {}
    for kind, zone, t, entity in rows:
        expected.setdefault((zone, t // 30 * 30_000), {}).setdefault(kind, set()).add(entity)
    assert {key: (value[0], value[1]) for key, value in got.items()} == {
        key: (len(sets.get("vehicle", ())), len(sets.get("trip", ())))
        for key, sets in expected.items()}


def slots_frame(spark, seed=1, days=25):
    rng = random.Random(seed)
    grid = {(z, s * 1800) for z in (1, 2, 3) for s in rng.sample(range(days * 48), 400)}
    return spark.createDataFrame(
        [(z, t, rng.randint(1, 9)) for z, t in sorted(grid)], "zone_id int, slot_ts long, demand long")


def test_history_in_blocks_equals_joins_and_whole_windows(spark):
    slots = slots_frame(spark)
    blocks = {(r.zone_id, r.slot_ts): (r.demand_lag_1d, r.demand_lag_7d, r.rolling_7d_mean)
              for r in features.add_history(slots).collect()}
    data = {(r.zone_id, r.slot_ts): r.demand for r in slots.collect()}
    assert blocks.keys() == data.keys()
    for (zone, t), (day, week, mean) in blocks.items():
        past = [d for (z, s), d in data.items() if z == zone and t - features.WEEK <= s < t]
        assert day == data.get((zone, t - features.DAY), 0)
        assert week == data.get((zone, t - features.WEEK), 0)
        assert mean == (sum(past) / len(past) if past else 0.0)
    joined = {(r.zone_id, r.slot_ts): (r.demand_lag_1d, r.demand_lag_7d)
              for r in features.add_lags(slots).collect()}
    assert joined == {key: value[:2] for key, value in blocks.items()}


def test_history_for_slots_without_trips(spark):
    slots = spark.createDataFrame([(1, 0, 4), (1, 1800, 2)], "zone_id int, slot_ts long, demand long")
    asked = spark.createDataFrame([(1, features.DAY), (1, 0), (2, 0)], "zone_id int, slot_ts long")
    got = {(r.zone_id, r.slot_ts): (r.demand_lag_1d, r.rolling_7d_mean)
           for r in features.history_at(asked, slots).collect()}
    assert got == {(1, features.DAY): (4, 3.0), (1, 0): (0, 0.0), (2, 0): (0, 0.0)}


def test_half_hour_slots(spark):
    at = [datetime.datetime(2013, 7, 1, 8, 47), datetime.datetime(2013, 7, 1, 9, 15)]
    df = spark.createDataFrame([(1, t) for t in at], "zone_id int, trip_start timestamp_ntz")
    assert sorted(r.slot_start for r in features.slot_demand(df).collect()) == [
        datetime.datetime(2013, 7, 1, 8, 30), datetime.datetime(2013, 7, 1, 9, 0)]


def test_weekday_and_week(spark):
    sunday = datetime.datetime(2013, 7, 7, 10)
    df = spark.createDataFrame([(1, 5, sunday)], "zone_id int, taxi_id int, trip_start timestamp_ntz")
    row = features.add_temporal(df, "trip_start").first()
    assert (row.day_of_week, row.is_weekend, row.is_friday) == (1, 1, 0)
    assert kpi.weekly_trips(df).first().week_start == datetime.datetime(2013, 7, 1)


def test_split_dates(spark):
    def cutoff(low, high):
        df = spark.createDataFrame([(low,), (high,)], "slot_date date")
        return features.cutoff_date(df)

    d = datetime.date
    assert cutoff(d(2013, 8, 31), d(2014, 8, 30)) == d(2014, 6, 30)
    assert cutoff(d(2013, 4, 30), d(2014, 4, 30)) == d(2014, 2, 28)
    assert cutoff(d(2024, 1, 1), d(2024, 1, 30)) == d(2024, 1, 15)
    assert cutoff(d(2024, 1, 1), d(2024, 1, 1)) == d(2024, 1, 2)


def test_baseline_falls_back_to_all_rows(spark):
    df = spark.createDataFrame([(1, 3, 0), (2, 4, 0)], "zone_id int, demand long, demand_lag_7d long")
    assert features.baseline(df).count() == 2
    more = df.unionAll(spark.createDataFrame([(3, 5, 2)], df.schema))
    assert [r.prediction for r in features.baseline(more).collect()] == [2.0]


def test_serving_rows(spark):
    cells = spark.createDataFrame([("8839a54a2bfffff", 3), ("7", 2)], "pickup_hex string, total_trips long")
    got = {(r.zone_id, r.active_vehicles, r.pending_requests, r.ratio)
           for r in kpi.to_demand_rows(cells, "X", 5).collect()}
    assert got == {(None, 3, 0, 1.0), (7, 2, 0, 1.0)}


def test_training_scoring_and_storage(spark, tmp_path):
    slots = slots_frame(spark).withColumn(
        "slot_start", F.timestamp_seconds("slot_ts").cast("timestamp_ntz"))
    matrix = features.add_history(features.add_weather(features.add_temporal(slots))).persist()
    train, test = features.temporal_split(matrix)
    fitted = model.train(train, rounds=3)
    naive = features.baseline(test)
    table = {r.metric: r for r in model.compare(model.predict(fitted, test), naive).collect()}
    assert table.keys() == {"rmse", "mae"} and table["rmse"].model > 0
    weights = model.importances(fitted, train).collect()
    assert {r.feature for r in weights} == set(features.FEATURES)
    assert [r.importance for r in weights] == sorted((r.importance for r in weights), reverse=True)
    model.save_model(fitted, str(tmp_path / "m"))
    loaded = model.load_model(str(tmp_path / "m"))
    one, two = (sorted(r.prediction for r in model.predict(m, test).collect())
                for m in (fitted, loaded))
    assert one == two
    asked = spark.createDataFrame([(1, "1970-01-20T10:00:00"), (9, "1970-01-20T10:00:00"),
                                   (1, "soon")], "zone_id int, datetime string")
    got = model.score(asked, loaded, slots).collect()
    assert sorted((r.zone_id, r.datetime, r.reason) for r in got if r.reason) == [
        (1, "soon", "unreadable:datetime")]
    assert len(got) == 3 and all(r.predicted_demand >= 0 for r in got if r.reason is None)
    assert by_zone_rows(matrix, fitted, test, naive)
    search = model.tune(train, depths=(2, 3), folds=2, rounds=2)
    assert model.best_depth(search) in (2, 3)
    matrix.unpersist()


def by_zone_rows(matrix, fitted, test, naive):
    rows = features.compare_by_zone(model.predict(fitted, test), naive).collect()
    return [r.zone_id for r in rows] == sorted(r.zone_id for r in rows)
