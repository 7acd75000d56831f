"""User profiles and segments."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_m
from .graph import written

FEATURES = ["total_trips", "median_trip_distance_km", "median_trip_duration_min", "radius_of_gyration_km", "fraction_time_home", "fraction_time_work", "routine_index", "average_daily_distance_km"]


def gyration(points: DataFrame) -> DataFrame:
    """user_id, radius_of_gyration_km: root mean square distance to the mean place."""
    df = points.filter("lat IS NOT NULL AND lon IS NOT NULL")
    df = df.join(df.groupBy("user_id").agg(F.avg("lat").alias("_a"), F.avg("lon").alias("_o")), "user_id")
    d = haversine_m(F.col("lat"), F.col("lon"), F.col("_a"), F.col("_o"))
    return df.groupBy("user_id").agg((F.sqrt(F.avg(d * d)) / 1000.0).alias("radius_of_gyration_km"))


def routine(points: DataFrame) -> DataFrame:
    """user_id, routine_index: entropy of the points' weekdays over the log of seven."""
    days = points.groupBy("user_id", F.weekday(F.col("timestamp").cast("timestamp")).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy("user_id"))
    return days.withColumn("p", p).groupBy("user_id").agg((-F.sum(F.col("p") * F.log("p")) / math.log(7.0)).alias("routine_index"))


def stay_shares(stays: DataFrame, assignments: DataFrame) -> DataFrame:
    """user_id, fraction_time_home, fraction_time_work: dwell at the assigned stay over all dwell."""
    both = stays.join(assignments, "user_id", "left")
    total = F.sum("dwell_minutes")
    at = lambda c: F.sum(F.when(F.col("stay_id") == F.col(c), F.col("dwell_minutes")).otherwise(0.0))
    share = lambda c: F.when((total > 0) & F.max(F.col(c)).isNotNull(), at(c) / total)
    return both.groupBy("user_id").agg(share("home_stay_id").alias("fraction_time_home"), share("work_stay_id").alias("fraction_time_work"))


def user_features(points: DataFrame, trips: DataFrame, stays: DataFrame | None = None, assignments: DataFrame | None = None) -> DataFrame:
    """A row per user of any of the tables: trips, medians, radius of gyration, home and work shares, routine, mean of the daily distances.

    Points and trips are written once: each is read by several branches, whose windows and joins would all sort in one task at a time.
    """
    points, trips = written(points.select("user_id", "timestamp", "lat", "lon")), written(trips.select("user_id", "start_time", "distance_m", "duration_s"))
    users = points.select("user_id").union(trips.select("user_id")).distinct()
    per_trip = trips.groupBy("user_id").agg(F.count(F.lit(1)).cast("int").alias("total_trips"), (F.median("distance_m") / 1000.0).alias("median_trip_distance_km"), (F.median("duration_s") / 60.0).alias("median_trip_duration_min"))
    daily = trips.groupBy("user_id", F.to_date(F.col("start_time").cast("timestamp")).alias("day")).agg(F.sum("distance_m").alias("d")).groupBy("user_id").agg((F.avg("d") / 1000.0).alias("average_daily_distance_km"))
    out = users.join(per_trip, "user_id", "left").join(gyration(points), "user_id", "left")
    if stays is not None and assignments is not None:
        out = out.join(stay_shares(stays, assignments), "user_id", "left")
    else:
        out = out.withColumns({"fraction_time_home": F.lit(None).cast("double"), "fraction_time_work": F.lit(None).cast("double")})
    out = out.join(routine(points), "user_id", "left").join(daily, "user_id", "left")
    return out.withColumn("total_trips", F.coalesce("total_trips", F.lit(0))).select("user_id", *FEATURES)


def segment_users(features: DataFrame, k: int = 4, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(features with segment, centres in the features' units): k-means on standardised features, nulls by the median.

    Columns that are null throughout are left out. Segments are numbered by their centres in ascending order. The features, a row
    per user, are written first, for every step of the fit reads them.
    """
    features = written(features)
    counts = features.agg(*[F.count(c).alias(c) for c in FEATURES]).first()
    used = [c for c in FEATURES if counts[c]]
    df = features.withColumns({c: F.col(c).cast("double") for c in used})
    stages = [Imputer(strategy="median", inputCols=used, outputCols=[f"{c}_f" for c in used]), VectorAssembler(inputCols=[f"{c}_f" for c in used], outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True), KMeans(k=k, seed=seed, featuresCol="_scaled", predictionCol="_segment")]
    model = Pipeline(stages=stages).fit(df)
    scaler, means = model.stages[2], model.stages[3]
    centres = [[c * s + m for c, s, m in zip(centre, scaler.std, scaler.mean)] for centre in means.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    spark = features.sparkSession
    names = spark.createDataFrame([(old, new) for new, old in enumerate(order)], "_segment int, segment int")
    table = spark.createDataFrame([(new, *map(float, centres[old])) for new, old in enumerate(order)], "segment int, " + ", ".join(f"{c} double" for c in used))
    done = model.transform(df).select("user_id", "_segment").join(F.broadcast(names), "_segment").select("user_id", "segment")
    return features.join(done, "user_id"), table
