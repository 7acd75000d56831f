"""The flows that join the operators: ingestion, stays, profiles, modelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import features, modes, profile, stays, trips
from ..operators.graph import written
from ..sources.readers import read_plt
from ..sources.sinks import save_artifact
from .settings import Settings


def clean_trips(points: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Motion, speed filter and trips; one shuffle on the user."""
    moved = trips.drop_fast(trips.with_motion(points, s.split_s), s.max_speed_kmh)
    return trips.segment_trips(moved, s.gap_min, s.min_trip_m, s.min_points, s.split_s)


def ingest(spark: SparkSession, s: Settings) -> tuple[str, str]:
    """Reads the raw files, writes the points and trips artifacts in folders by user bucket and day, and returns their paths."""
    points = read_plt(spark, s.raw_dir, list(s.user_ids) if s.user_ids else None)
    kept, table = clean_trips(points, s)
    return save_artifact(kept, s.processed_dir, "points", s.user_buckets), save_artifact(table, s.processed_dir, "trips", s.user_buckets)


def point_features(points: DataFrame, s: Settings) -> DataFrame:
    """All point features: acceleration, calendar, geohash, stop density, spread of acceleration."""
    df = features.with_geohash(features.with_calendar(features.with_acceleration(points, split_s=s.split_s)), s.geohash_precision)
    return features.with_accel_spread(features.with_stop_density(df, s.stop_window_s, split_s=s.split_s), s.accel_window_s, s.split_s)


def profiles(points: DataFrame, table: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(stays, user features with home and work shares)."""
    found = written(stays.detect_stays_dbscan(points, s.eps_m, s.min_samples))
    return found, profile.user_features(points, table, found, stays.home_work(found))


def mode_model(table: DataFrame, points: DataFrame | None = None, found: DataFrame | None = None, matched: DataFrame | None = None):
    """(model, used features, report on the latest fifth of the trips)."""
    data = modes.split_by_time(modes.trip_dataset(table, points, found, matched)).cache()
    model, used = modes.train_classifier(data.filter("split = 'train'"))
    return model, used, modes.evaluate(model, used, data.filter("split = 'test'"))
