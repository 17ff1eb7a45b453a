"""The physical plans are the ones meant: pushed filters, partial aggregates, no pair joins."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wayfare.operators import demand, features, kpi, matching, quality
from wayfare.plans import catalog, fixtures as fx

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# The remaining ones write, stream or train before they return, and read a table after.
DIRECT = [name for name in sorted(catalog.QUERIES) if not name.startswith(
    ("sink_", "src_stream", "st_", "ml_gbt", "ml_cv", "ml_eval", "ml_compare", "ml_imp", "route_"))]


@pytest.mark.parametrize("name", DIRECT)
def test_no_cross_or_nested_loop_joins(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_ping_job_is_one_stage_without_python(spark):
    text = plan(fx.zone_pings(spark, SF_DIR))
    assert "Exchange" not in text and "Python" not in text


def test_filters_and_columns_reach_the_scan(spark):
    pushed = plan(fx.table(spark, SF_DIR, "events").filter(
        (F.col("event_type") == "purchase") & (F.col("value") > 5)).select("event_id"))
    assert "EqualTo(event_type,purchase)" in pushed and "GreaterThan(value,5.0)" in pushed
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in pushed


def test_cleaning_rules_reach_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    fx.nyc_trips(spark, SF_DIR).write.parquet(str(tmp_path / "nyc"))
    text = plan(quality.clean_nyc(spark.read.parquet(str(tmp_path / "nyc"))))
    for rule in ("GreaterThanOrEqual(tpep_pickup_datetime", "LessThan(fare_amount,500.0)",
                 "IsNotNull(PULocationID)"):
        assert rule in text
    assert "airport_fee" not in text


def test_month_filter_prunes_partitions(spark, tmp_path):
    fx.trips_curated(spark, SF_DIR).write.partitionBy("year_month").parquet(str(tmp_path / "t"))
    text = plan(spark.read.parquet(str(tmp_path / "t")).filter(
        F.col("year_month") == "2024-01").select("trip_id"))
    assert "PartitionFilters: [isnotnull(year_month" in text


def test_demand_counts_are_preaggregated(spark):
    text = plan(demand.demand_windows(fx.supply_and_demand(spark, SF_DIR)))
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_count" in text and "collect_set" not in text


def test_weekly_distinct_is_spread_over_taxis(spark):
    text = plan(kpi.weekly_trips(fx.trips_curated(spark, SF_DIR)))
    assert "Expand" not in text
    assert any("taxi_id" in line for line in text.splitlines()
               if "Exchange hashpartitioning" in line)


def test_dedupe_needs_no_ranking(spark):
    text = plan(quality.dedupe(fx.trip_history(spark, SF_DIR), ["TRIP_ID"]))
    assert "Window" not in text and "partial_min" in text


def test_peak_hours_stop_early(spark):
    assert "WindowGroupLimit" in plan(kpi.weekly_peak_hours(fx.trips_curated(spark, SF_DIR)))


def test_feature_matrix_shuffles_twice(spark):
    text = plan(features.feature_matrix(fx.slot_trips(spark, SF_DIR)))
    assert text.count("Exchange") == 2 and "Join" not in text


def test_candidates_meet_one_summed_row_per_level(spark):
    pings = fx.zone_pings(spark, SF_DIR).drop("event_id", "zone_name").withColumn("city", F.lit("X"))
    trips = fx.trip_requests(spark, SF_DIR).withColumn("city", F.lit("X"))
    text = plan(matching.candidates(trips, pings))
    join = next(line for line in text.splitlines() if "Join" in line)
    assert "level" in join and "node" in join and "partial_min(taxi_id" in text


@pytest.mark.parametrize("name", ["ml_split", "ml_baseline", "agg_zone_rmse", "join_zone_metrics", "join_lag"])
def test_trips_are_read_once(spark, name):
    """The slots or the matrix are stored; what follows reads the stored table."""
    plan = catalog.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "events.parquet" not in plan and "wayfare" in plan


def test_pairs_that_cannot_meet_are_set_aside(spark):
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(30)] + [(100, 101, 1.0)],
                                  "src long, dst long, length double")
    pairs = spark.createDataFrame([(0, 1), (0, 101), (5, 500), (7, 7)], "origin long, destination long")
    from wayfare.operators import routes
    assert sorted(map(tuple, routes.connected(pairs, edges).collect())) == [(0, 1), (7, 7)]
    found = routes.routes(pairs, edges).collect()
    assert sorted((r.origin, r.destination, r.length) for r in found) == [(0, 1, 1.0), (7, 7, 0.0)]
