"""Artifact schemas, and conform(): any table brought to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of each artifact.
SCHEMAS = {
    "points": "user_id string, timestamp timestamp, lat double, lon double, alt_ft double, alt_m double, date_num double, date string, time string, source_file string, dist_m double, dt_s double, speed_kmh double, trip_seq int, trip_id string",
    "trips": "user_id string, trip_seq int, trip_id string, start_time timestamp, end_time timestamp, points long, distance_m double, duration_s double, avg_speed_kmh double",
    "stays": "user_id string, stay_id string, center_lat double, center_lon double, start_time timestamp, end_time timestamp, dwell_minutes double, point_count long",
    "assignments": "user_id string, home_stay_id string, work_stay_id string",
    "matched": "user_id string, trip_id string, seq int, snapped_lat double, snapped_lon double, snapped_time timestamp, confidence double, matched boolean, lateral_offset_m double",
}

# Names under which a column may arrive; the first that is there wins.
ALIASES = {
    "user_id": "user_id uid user userid",
    "timestamp": "timestamp ts datetime time dt snapped_time",
    "lat": "lat latitude y",
    "lon": "lon longitude lng x",
    "trip_id": "trip_id trip segment_id",
    "start_time": "start_time start_ts start",
    "end_time": "end_time end_ts end",
    "center_lat": "center_lat lat latitude",
    "center_lon": "center_lon lon longitude lng",
    "dwell_minutes": "dwell_minutes dwell_min dwell duration_min",
    "snapped_lat": "snapped_lat matched_lat mlat",
    "snapped_lon": "snapped_lon matched_lon mlon matched_lng",
    "snapped_time": "snapped_time ts timestamp datetime time dt",
    "confidence": "confidence match_confidence matched_confidence",
    "lateral_offset_m": "lateral_offset_m snap_distance_m snap_offset_m",
    "speed_kmh": "speed_kmh speed_km_h speed",
    "accel_mps2": "accel_mps2 acceleration accel acc_mps2 acc_ms2",
    "source_file": "source_file file source",
}


def pick(df: DataFrame, name: str, aliases: dict[str, str] = ALIASES) -> str | None:
    """The column of df that stands for `name`, whatever its case."""
    there = {c.lower(): c for c in reversed(df.columns)}
    return next((there[a] for a in aliases.get(name, name).split() if a in there), None)


def conform(df: DataFrame, schema: str, extra: bool = False) -> DataFrame:
    """The artifact's columns in order: found by alias, cast where possible, null where absent. NaN becomes null.

    `extra` keeps the columns that no artifact column took.
    """
    out, used = [], set()
    for item in SCHEMAS[schema].split(", "):
        name, kind = item.split(" ")
        source = pick(df, name)
        if source is None and name == "speed_kmh" and (mps := pick(df, "speed_mps", {})):
            out.append((F.col(f"`{mps}`").try_cast("double") * 3.6).alias(name))
            continue
        if source is None and name == "dwell_minutes" and pick(df, "start_time") and pick(df, "end_time"):
            start, end = (F.col(f"`{pick(df, c)}`").cast("timestamp") for c in ("start_time", "end_time"))
            out.append(((F.unix_micros(end) - F.unix_micros(start)) / 60e6).alias(name))
            continue
        if source is None:
            out.append(F.lit(None).cast(kind).alias(name))
            continue
        used.add(source)
        value = F.col(f"`{source}`").try_cast(kind)
        out.append((F.nanvl(value, F.lit(None).cast("double")) if kind == "double" else value).alias(name))
    names = {item.split(" ")[0] for item in SCHEMAS[schema].split(", ")}
    rest = [F.col(f"`{c}`") for c in df.columns if c not in used and c not in names] if extra else []
    return df.select(*out, *rest)
