"""Sources: trajectory files, label files, artifacts with fallbacks, configuration."""

from __future__ import annotations

import json
import re
import zlib

import yaml
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import FEET, serial_day, tolerant_double
from .schema import SCHEMAS, conform

INVALID_ALT_FT = -777.0


def read_plt(spark: SparkSession, root: str, users: list[str] | None = None, floor: str = "1990-01-01") -> DataFrame:
    """Points of every <root>/<user>/{Trajectory,trajectory}/*.plt in one scan.

    A line counts if it has seven fields, parsable coordinates and a time: date and time fields first, else the day
    number. Times before `floor` are dropped, so that no header line passes for a point. alt_m is null for the
    invalid mark. `users` keeps some users; only their folders are listed and read.
    """
    own = "*" if users is None or not all(re.fullmatch(r"[\w.-]+", u) for u in users) else f"{{{','.join(users)}}}"
    files = spark.read.option("pathGlobFilter", "*.plt")
    try:
        lines = files.text(f"{root}/{own}/[Tt]rajectory")
    except AnalysisException:
        if own == "*":
            raise
        lines = files.text(f"{root}/*/[Tt]rajectory")  # none of the users has a folder
    lines = lines.select("value", F.col("_metadata.file_path").alias("source_file")).withColumn("user_id", F.regexp_extract("source_file", r"([^/]+)/[Tt]rajectory/[^/]+$", 1))
    if users is not None:
        lines = lines.filter(F.col("user_id").isin(users))
    f = F.split(F.trim("value"), ",")
    at = lambda i: F.get(f, F.lit(i))
    written = F.try_to_timestamp(F.concat_ws(" ", F.trim(at(5)), F.trim(at(6))), F.lit("yyyy-MM-dd HH:mm:ss"))
    points = lines.filter(F.size(f) >= 7).select("user_id", tolerant_double(at(0)).alias("lat"), tolerant_double(at(1)).alias("lon"), tolerant_double(at(3)).alias("alt_ft"), tolerant_double(at(4)).alias("date_num"), F.trim(at(5)).alias("date"), F.trim(at(6)).alias("time"), "source_file", written.alias("written"))
    points = points.withColumn("timestamp", F.coalesce("written", serial_day(F.col("date_num"))))
    points = points.withColumn("alt_m", F.when(F.col("alt_ft") != INVALID_ALT_FT, F.col("alt_ft") * FEET))
    kept = points.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.col("timestamp") >= F.lit(floor).cast("timestamp")))
    return kept.select("user_id", "timestamp", "lat", "lon", "alt_ft", "alt_m", "date_num", "date", "time", "source_file")


def read_labels(spark: SparkSession, root: str) -> DataFrame:
    """user_id, start_time, end_time, mode of every <root>/<user>/labels.txt; comma or tab between fields."""
    lines = spark.read.option("pathGlobFilter", "labels.txt").text(f"{root}/*").select("value", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/labels\.txt$", 1).alias("user_id"))
    f = F.split(F.trim("value"), "[,\t]")
    time = lambda i: F.try_to_timestamp(F.translate(F.trim(F.get(f, F.lit(i))), "/", "-"), F.lit("yyyy-MM-dd HH:mm:ss"))
    rows = lines.filter(F.size(f) >= 3).select("user_id", time(0).alias("start_time"), time(1).alias("end_time"), F.lower(F.trim(F.get(f, F.lit(2)))).alias("mode"))
    return rows.filter("start_time IS NOT NULL AND end_time IS NOT NULL AND mode <> ''")


def first_users(points: DataFrame, k: int = 3) -> list[str]:
    """The first k user ids in order."""
    return [r[0] for r in points.select("user_id").distinct().orderBy("user_id").limit(k).collect()]


#: Folder columns of a partitioned artifact (the first ends in the number of buckets), and the columns that can give a row its day.
BUCKET, DAY = "user_bucket_of_", "row_day"
TIMES = ("timestamp", "snapped_time", "start_time")


def read_artifact(spark: SparkSession, schema: str, *paths: str, users: list[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """The first of the paths that can be read (Parquet, or CSV by its ending), conformed; an empty table if none can.

    `users` keeps some users, `start` and `end` the days from one up to and with the other. Of a table that save_artifact wrote by user
    bucket and day, only the folders of these users' buckets and these days are read; any other table is filtered.
    """
    for path in paths:
        try:
            df = spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
            return conform(_pruned(df, users, start, end), schema, extra=True)
        except AnalysisException:
            continue
    return spark.createDataFrame([], SCHEMAS[schema])


def _pruned(df: DataFrame, users: list[str] | None, start: str | None, end: str | None) -> DataFrame:
    time = next((c for c in TIMES if c in df.columns), None)
    bucket = next((c for c in df.columns if re.fullmatch(BUCKET + r"\d+", c)), None)
    if bucket and DAY in df.columns:
        if users is not None:
            buckets = int(bucket.removeprefix(BUCKET))
            df = df.filter(F.col(bucket).isin(sorted({zlib.crc32(str(u).encode()) % buckets for u in users})))
        day = F.col(DAY).cast("date")
        df = df.filter(day >= F.lit(start).cast("date")) if start else df
        df = df.filter(day <= F.lit(end).cast("date")) if end else df
        df = df.drop(bucket, DAY)
    elif time:
        at = F.to_date(F.col(time).cast("timestamp"))
        df = df.filter(at >= F.lit(start).cast("date")) if start else df
        df = df.filter(at <= F.lit(end).cast("date")) if end else df
    return df.filter(F.col("user_id").isin([str(u) for u in users])) if users is not None and "user_id" in df.columns else df


def read_config(path: str) -> dict:
    """A YAML file as nested maps; empty if there's none."""
    try:
        with open(path, encoding="utf-8") as f:
            return yaml.safe_load(f) or {}
    except FileNotFoundError:
        return {}


def read_report(path: str) -> dict | None:
    """A JSON report, null if it's missing or broken."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (FileNotFoundError, ValueError):
        return None
