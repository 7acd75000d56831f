"""The boundary rules of motion, speed filter and trips, worked by hand."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trekspark.functions import geo
from trekspark.operators import features, trips

T0 = datetime(2024, 1, 1)
STEP = 100 / 111_194.926644  # degrees of latitude for about 100 m


def rows(spark, *points):
    return spark.createDataFrame([(u, T0 + timedelta(seconds=s), lat, lon, i) for i, (u, s, lat, lon) in enumerate(points)], "user_id string, timestamp timestamp, lat double, lon double, event_id long")


def by_event(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("event_id").collect()]


def test_first_row_and_still_time(spark):
    df = trips.with_motion(rows(spark, ("a", 0, 0.0, 0.0), ("a", 0, STEP, 0.0), ("a", 10, STEP, 0.0)))
    out = by_event(df, "dist_m", "dt_s", "speed_kmh")
    assert out[0] == (0.0, 0.0, None)
    assert out[1][0] == pytest.approx(100, abs=0.01) and out[1][1:] == (0.0, None)
    assert out[2] == (0.0, 10.0, 0.0)


def test_missing_coordinates_give_no_distance(spark):
    out = by_event(trips.with_motion(rows(spark, ("a", 0, 0.0, 0.0), ("a", 10, None, 0.0))), "dist_m", "dt_s")
    assert out[1] == (0.0, 10.0)


def test_cap_is_inclusive_and_keeps_unknown_speed(spark):
    df = spark.createDataFrame([(1, 200.0), (2, 200.0001), (3, None)], "event_id int, speed_kmh double")
    assert [r[0] for r in trips.drop_fast(df, 200.0).orderBy("event_id").collect()] == [1, 3]
    assert trips.drop_fast(df, None).count() == 3


def test_gap_must_be_longer_than_the_threshold(spark):
    df = trips.number_trips(trips.with_motion(rows(spark, ("a", 0, 0.0, 0.0), ("a", 1800, 0.0, 0.0), ("a", 3601, 0.0, 0.0), ("b", 0, 0.0, 0.0))), 30)
    assert by_event(df, "trip_id") == [("a-0",), ("a-0",), ("a-1",), ("b-0",)]


def test_short_trips_go_and_numbers_stay(spark):
    moved = trips.with_motion(rows(spark, ("a", 0, 0.0, 0.0), ("a", 10_000, 0.0, 0.0), ("a", 10_100, 2 * STEP, 0.0)))
    kept, table = trips.segment_trips(moved, 30, 100)
    assert [(r.trip_id, r.points) for r in table.collect()] == [("a-1", 2)]
    assert {r.event_id for r in kept.collect()} == {1, 2}


def test_step_into_a_trip_counts_nothing_and_single_point_has_no_speed(spark):
    _, table = trips.segment_trips(trips.with_motion(rows(spark, ("a", 0, 0.0, 0.0), ("a", 10_000, 1.0, 0.0))), 30, 0)
    assert [(r.trip_seq, r.distance_m, r.duration_s, r.avg_speed_kmh) for r in table.orderBy("trip_seq").collect()] == [(0, 0.0, 0.0, 0.0), (1, 0.0, 0.0, 0.0)]


def test_distances_sum_to_the_steps_inside(spark, sf):
    from trekspark.queries import moved

    numbered = trips.number_trips(moved(spark, sf), 720)
    inside = numbered.filter("_begins = 0").agg(F.sum("dist_m")).first()[0]
    assert trips.trip_table(numbered).agg(F.sum("distance_m")).first()[0] == pytest.approx(inside)


def test_empty_table(spark):
    kept, table = trips.segment_trips(trips.with_motion(rows(spark, ("a", 0, 0.0, 0.0)).limit(0)))
    assert kept.count() == table.count() == 0


def test_acceleration_is_capped_and_null_at_the_start(spark):
    df = rows(spark, ("a", 0, 0.0, 0.0), ("a", 10, STEP, 0.0), ("a", 11, 3 * STEP, 0.0))
    out = [r[0] for r in by_event(features.with_acceleration(trips.with_motion(df)), "accel_mps2")]
    assert out == [None, None, 5.0]


def test_heading_wraps(spark):
    df = spark.createDataFrame([(350.0, 10.0), (10.0, 350.0), (0.0, 180.0)], "a double, b double")
    assert [r[0] for r in df.select(geo.bearing_change(F.col("a"), F.col("b"))).collect()] == [20.0, 20.0, 180.0]


def test_geohash_cells_and_prefixes(spark):
    df = spark.createDataFrame([(57.64911, 10.40744), (90.0, 180.0), (0.0, 0.0), (None, 1.0)], "lat double, lon double")
    out = df.select(geo.geohash(F.col("lat"), F.col("lon"), 8), geo.geohash(F.col("lat"), F.col("lon"), 5)).collect()
    assert out[0][0] == "u4pruydq" and out[1][0] == "zzzzzzzz" and out[2][0] == "s0000000" and out[3][0] is None
    assert all(a is None or a.startswith(b) for a, b in out)


def test_split_users_give_the_same_trips(spark, sf):
    from trekspark.queries import points

    def flow(split_s):
        moved = trips.drop_fast(trips.with_motion(points(spark, sf), split_s))
        kept, table = trips.segment_trips(moved, 720, 100, split_s=split_s)
        return sorted((r.event_id, r.trip_id, r.dist_m, r.speed_kmh is None) for r in kept.collect()), sorted((r.trip_id, r.points) for r in table.collect())

    assert flow(None) == flow(86_400)
