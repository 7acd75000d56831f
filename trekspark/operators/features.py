"""Point and trip features: acceleration, calendar, geohash, rolling windows, dwell, matched points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import bearing_change, geohash, haversine_m, pair_text
from ..functions.scalar import calendar, seconds_between
from ..sources.schema import pick
from .joins import interval_join
from .trips import with_before, with_motion


def with_acceleration(points: DataFrame, cap: float = 5.0, split_s: int | None = None) -> DataFrame:
    """accel_mps2: change of speed over time, held within +-cap; null on a user's first row and where a speed or the time is missing.

    `split_s` works users in spans of so many seconds, as in trips.py.
    """
    df = points if {"speed_kmh", "dt_s"} <= set(points.columns) else with_motion(points, split_s)
    df = with_before(df, split_s, ("timestamp", "speed_kmh"))
    rate = F.when(F.col("dt_s") > 0, (F.col("speed_kmh") - F.col("_before.speed_kmh")) / 3.6 / F.col("dt_s"))
    return df.withColumn("accel_mps2", F.when(rate.isNotNull(), F.greatest(F.least(rate, F.lit(cap)), F.lit(-cap)))).drop("_before")


def with_calendar(points: DataFrame) -> DataFrame:
    return points.withColumns(calendar(F.col("timestamp")))


def with_geohash(points: DataFrame, precision: int = 7) -> DataFrame:
    """geohash, or the coordinates rounded to three decimals if the precision isn't positive."""
    value = geohash(F.col("lat"), F.col("lon"), precision) if precision > 0 else pair_text(F.col("lat"), F.col("lon"), 3)
    return points.withColumn("geohash", value)


def _trailing(points: DataFrame, window_s: float, split_s: int | None, name: str, value) -> DataFrame:
    """points with `name`, the aggregate `value` over the user's rows in (t - window, t]; rows of one time see each other.

    With `split_s` a user's rows are worked in spans of so many seconds, or of the window if that is longer. Each span also
    gets copies of the rows of the span before that its windows reach, which are dropped again.
    """
    width = int(window_s * 1_000_000)
    df = points.withColumn("_us", F.unix_micros(F.col("timestamp").cast("timestamp")))
    keys = ["user_id"]
    if split_s is not None:
        span = max(split_s * 1_000_000, width)
        own = F.floor(F.col("_us") / span)
        df = df.withColumn("_span", F.explode(F.when(F.col("_us") > (own + 1) * span - width, F.array(own, own + 1)).otherwise(F.array(own))))
        keys.append("_span")
    window = Window.partitionBy(*keys).orderBy("_us").rangeBetween(-width + 1, 0)
    df = df.withColumn(name, value.over(window))
    if split_s is not None:
        df = df.filter(F.floor(F.col("_us") / span) == F.col("_span")).drop("_span")
    return df.drop("_us")


def with_stop_density(points: DataFrame, window_s: float = 300, stop_speed_kmh: float = 1.0, split_s: int | None = None) -> DataFrame:
    """stop_density_per_min: stops (speed at most `stop_speed_kmh`) in the trailing window, over the window's minutes."""
    stop = F.when(F.col("speed_kmh") <= stop_speed_kmh, 1.0).otherwise(0.0)
    df = _trailing(points, window_s, split_s, "stop_density_per_min", F.sum(stop))
    return df.withColumn("stop_density_per_min", F.col("stop_density_per_min") / (window_s / 60.0))


def with_accel_spread(points: DataFrame, window_s: float = 60, split_s: int | None = None) -> DataFrame:
    """accel_roll_std: sample deviation of acceleration in the trailing window; null for one value."""
    df = points if "accel_mps2" in points.columns else with_acceleration(points, split_s=split_s)
    return _trailing(df, window_s, split_s, "accel_roll_std", F.stddev_samp("accel_mps2"))


def accel_by_trip(points: DataFrame) -> DataFrame:
    """trip_id, accel_std (population), accel_iqr (linear quartiles)."""
    df = points if "accel_mps2" in points.columns else with_acceleration(points)
    quart = lambda q: F.percentile("accel_mps2", F.lit(q))
    return df.groupBy("trip_id").agg(F.stddev_pop("accel_mps2").alias("accel_std"), (quart(0.75) - quart(0.25)).alias("accel_iqr"))


def dwell_ratio(trips: DataFrame, stays: DataFrame) -> DataFrame:
    """trips with dwell_ratio: time inside the user's stays over the trip's duration; overlaps add up, 0 without stays, null without duration."""
    pairs = interval_join(trips.select("user_id", "trip_id", "start_time", "end_time"), stays.select("user_id", F.col("start_time").alias("stay_start"), F.col("end_time").alias("stay_end")), "user_id", ("start_time", "end_time"), ("stay_start", "stay_end"))
    inside = seconds_between(F.greatest("start_time", "stay_start"), F.least("end_time", "stay_end"))
    dwell = pairs.groupBy("user_id", "trip_id").agg(F.sum(F.greatest(inside, F.lit(0.0))).alias("_dwell"))
    ratio = F.when(F.col("duration_s") > 0, F.coalesce("_dwell", F.lit(0.0)) / F.col("duration_s"))
    return trips.join(dwell, ["user_id", "trip_id"], "left").withColumn("dwell_ratio", ratio).drop("_dwell")


def stop_density_by_trip(points: DataFrame, trips: DataFrame) -> DataFrame:
    """trip_id, mean_stop_density over the user's points within the trip's times (both ends in)."""
    rated = points if "stop_density_per_min" in points.columns else with_stop_density(points)
    p = rated.select("user_id", F.col("timestamp").alias("at"), F.col("timestamp").alias("at_end"), "stop_density_per_min")
    pairs = interval_join(trips.select("user_id", "trip_id", "start_time", "end_time"), p, "user_id", ("start_time", "end_time"), ("at", "at_end"))
    return pairs.groupBy("trip_id").agg(F.avg("stop_density_per_min").alias("mean_stop_density"))


def matched_by_trip(matched: DataFrame) -> DataFrame:
    """Per trip: mean and max lateral offset and confidence, and heading change per km."""
    w = Window.partitionBy("trip_id").orderBy("seq")
    name = lambda want: pick(matched, want)
    col = lambda c: F.col(c) if c else F.lit(None).cast("double")
    heading = pick(matched, "heading_deg", {})
    df = matched.withColumns({
        "_off": col(name("lateral_offset_m")), "_conf": col(name("confidence")),
        "_turn": bearing_change(F.col(heading), F.lag(heading).over(w)) if heading else F.lit(None).cast("double"),
        "_step": haversine_m(F.lag("snapped_lat").over(w), F.lag("snapped_lon").over(w), F.col("snapped_lat"), F.col("snapped_lon")),
    })
    km = F.sum("_step") / 1000.0
    return df.groupBy("trip_id").agg(
        F.avg("_off").alias("lateral_offset_mean_m"), F.max("_off").alias("lateral_offset_max_m"), F.avg("_conf").alias("matched_confidence_mean"), F.max("_conf").alias("matched_confidence_max"),
        F.when(km > 0, F.sum("_turn") / km).alias("curvature_heading_change_per_km"),
    )


