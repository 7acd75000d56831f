"""Sinks: artifacts as Parquet, reports as one CSV or JSON, configuration snapshots."""

from __future__ import annotations

import json
import os
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readers import BUCKET, DAY, TIMES, read_config
from .schema import SCHEMAS

# The one registry of artifact names.
NAMES = {"points": "01_trajectories_cleaned.parquet", "trips": "02_trips.parquet", "stays": "03_stay_points.parquet", "stays_hdbscan": "03_stay_points_hdbscan.parquet", "matched": "04_matched_points.parquet", "user_features": "05_user_features.parquet", "segments": "06_user_segments.parquet", "paths": "07_frequent_paths.parquet", "modes": "08_trip_modes.parquet"}


def save_artifact(df: DataFrame, folder: str, name: str, buckets: int | None = None) -> str:
    """Writes a table under its registered name, the schema's columns first.

    With `buckets`, its files lie in folders by a bucket of the user (crc32 of the id modulo that number, which stands in the folders' name) and day
    (of the first time column), so that a reader of some users and days lists and opens only theirs. Rows are rebalanced over the
    folders before they are written: a small folder gets one file, one that holds a large share of all rows is written by many tasks.
    """
    own = [c.split(" ")[0] for c in SCHEMAS.get(name, "").split(", ") if c]
    first = [c for c in own if c in df.columns]
    path = f"{folder}/{NAMES[name]}"
    table = df.select(*first, *[c for c in df.columns if c not in first])
    time = next((c for c in TIMES if c in df.columns), None)
    if buckets is None or time is None or "user_id" not in df.columns:
        table.write.mode("overwrite").parquet(path)
        return path
    bucket = f"{BUCKET}{buckets}"
    placed = table.withColumns({bucket: F.pmod(F.crc32(F.col("user_id").cast("string").cast("binary")), F.lit(buckets)).cast("int"), DAY: F.to_date(F.col(time).cast("timestamp"))})
    placed.hint("rebalance", bucket, DAY).write.mode("overwrite").partitionBy(bucket, DAY).parquet(path)
    return path


def save_csv(df: DataFrame, path: str) -> str:
    """One CSV with a header; for reports, which are small."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return path


def save_json(report: dict, path: str) -> str:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(report, f, indent=2, default=str)
    return path


def save_model(model: PipelineModel, metrics: dict, folder: str) -> str:
    model.write().overwrite().save(f"{folder}/mode_model")
    return save_json(metrics, f"{folder}/mode_metrics.json")


def snapshot_config(config_path: str, path: str) -> str:
    """The configuration with the time at which it was taken (UTC)."""
    return save_json({"taken_at": datetime.now(UTC).isoformat(), "config": read_config(config_path)}, path)


def describe(df: DataFrame) -> DataFrame:
    return df.summary()
