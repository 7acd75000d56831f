"""Kinematics, speed filter and trip segmentation.

Windows are partitioned by user and ordered by time and a tie key, so all of them and the trip aggregate below share one
shuffle on the user. Where one user may hold a large share of all points, `split_s` cuts users into spans of that many
seconds: each span is worked by itself, with the row before it carried over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.geo import haversine_m
from ..functions.scalar import seconds_between, speed_kmh
from .ranks import running_sums


def order_of(df: DataFrame, key: str = "user_id") -> WindowSpec:
    """A user's points in time order; ties by the first of event_id, source_file, lat that is there."""
    return Window.partitionBy(key).orderBy("timestamp", *_ties(df))


def _ties(df: DataFrame) -> list[str]:
    return [c for c in ("event_id", "source_file", "lat", "lon") if c in df.columns]


def with_before(points: DataFrame, split_s: int | None = None, columns: tuple[str, ...] = ("timestamp", "lat", "lon")) -> DataFrame:
    """points with `_before` (these columns of the user's row before; null on the first)."""
    own = F.struct(*columns)
    if split_s is None:
        return points.withColumn("_before", F.lag(own).over(order_of(points)))
    df = points.withColumn("_span", F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / (split_s * 1_000_000)))
    ties = _ties(df)
    last = df.groupBy("user_id", "_span").agg(F.max_by(own, F.struct("timestamp", *ties)).alias("_last"))  # a row per user and span
    carried = last.withColumn("_carried", F.lag("_last").over(Window.partitionBy("user_id").orderBy("_span"))).drop("_last")
    inside = Window.partitionBy("user_id", "_span").orderBy("timestamp", *ties)
    df = df.join(carried, ["user_id", "_span"]).withColumns({"_lag": F.lag(own).over(inside), "_place": F.row_number().over(inside)})
    return df.withColumn("_before", F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col("_lag"))).select(*points.columns, "_before")


def with_motion(points: DataFrame, split_s: int | None = None) -> DataFrame:
    """dist_m, dt_s and speed_kmh from the point before: 0, 0 and null on a user's first; null speed where time stands still."""
    df = with_before(points, split_s)
    df = df.withColumns({"_lat": F.col("_before.lat"), "_lon": F.col("_before.lon"), "_ts": F.col("_before.timestamp")})
    dist = F.coalesce(haversine_m(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon")), F.lit(0.0))
    dt = F.coalesce(seconds_between(F.col("_ts"), F.col("timestamp")), F.lit(0.0))
    df = df.withColumns({"dist_m": dist, "dt_s": dt})
    return df.withColumn("speed_kmh", speed_kmh(F.col("dist_m"), F.col("dt_s"))).drop("_lat", "_lon", "_ts", "_before")


def drop_fast(points: DataFrame, max_speed_kmh: float | None = 200.0) -> DataFrame:
    """Points without a speed or with at most this one; all of them without a cap."""
    return points if max_speed_kmh is None else points.filter(F.col("speed_kmh").isNull() | (F.col("speed_kmh") <= max_speed_kmh))


def number_trips(points: DataFrame, gap_min: float = 30.0, split_s: int | None = None) -> DataFrame:
    """trip_seq (from 0) and trip_id: a new trip begins where the gap to the user's point before is strictly longer.

    dist_m is taken as it stands; it is computed only if it isn't there.
    """
    points = points if "dist_m" in points.columns else with_motion(points, split_s)
    gap = seconds_between(F.col("_before.timestamp"), F.col("timestamp"))
    begins = F.when(gap.isNull() | (gap > gap_min * 60.0), 1).otherwise(0)
    df = with_before(points, split_s).withColumn("_begins", begins).drop("_before")
    if split_s is None:
        df = df.withColumn("_n", F.sum("_begins").over(order_of(df).rowsBetween(Window.unboundedPreceding, 0)))
    else:
        df = running_sums(df, ["user_id"], ["timestamp", *_ties(df)], {"_n": F.col("_begins")})
    df = df.withColumn("trip_seq", (F.col("_n") - 1).cast("int")).drop("_n")
    return df.withColumn("trip_id", F.concat_ws("-", "user_id", F.col("trip_seq").cast("string")))


def trip_table(numbered: DataFrame) -> DataFrame:
    """A row per trip: times, points, distance (the step into the trip counts nothing), duration, mean speed, and both ends' coordinates."""
    df = numbered.withColumn("_step", F.when(F.col("_begins") == 1, 0.0).otherwise(F.col("dist_m")))
    ties = [c for c in ("event_id", "source_file") if c in df.columns]
    order = F.struct("timestamp", *ties)
    trips = df.groupBy("user_id", "trip_seq", "trip_id").agg(
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"), F.count(F.lit(1)).alias("points"), F.sum("_step").alias("distance_m"),
        *[f(c, order).alias(f"{end}_{c}") for end, f in (("start", F.min_by), ("end", F.max_by)) for c in ("lat", "lon")],
    )
    trips = trips.withColumn("duration_s", seconds_between(F.col("start_time"), F.col("end_time")))
    mean = F.when(F.col("duration_s") > 0, F.col("distance_m") / F.col("duration_s") * 3.6).otherwise(0.0)
    return trips.withColumn("avg_speed_kmh", mean).select("user_id", "trip_seq", "trip_id", "start_time", "end_time", "points", "distance_m", "duration_s", "avg_speed_kmh", "start_lat", "start_lon", "end_lat", "end_lon")


def segment_trips(points: DataFrame, gap_min: float = 30.0, min_distance_m: float = 100.0, min_points: int | None = None, split_s: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(points of kept trips, trips): trips of at least the distance, and of at least `min_points` if that is given. Numbers stay as they were."""
    numbered = number_trips(points, gap_min, split_s)
    trips = trip_table(numbered).filter(F.col("distance_m") >= min_distance_m)
    if min_points is not None:
        trips = trips.filter(F.col("points") >= min_points)
    kept = numbered.drop("_begins").join(trips.select("user_id", "trip_seq"), ["user_id", "trip_seq"], "left_semi")
    return kept, trips
