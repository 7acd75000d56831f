"""Stay places: tables of the clusters of each user's points, and the comparison of two stay tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_m
from .dbscan import dbscan_labels
from .hdbscan import hdbscan_labels
from .graph import written
from .joins import interval_join
from .ranks import whole_quantiles


def stay_table(labelled: DataFrame, mark: str = "stay") -> DataFrame:
    """A row per user and cluster: stay_id, centre, first and last time, dwell_minutes, point_count."""
    stays = labelled.filter("cluster >= 0").groupBy("user_id", "cluster").agg(F.avg("lat").alias("center_lat"), F.avg("lon").alias("center_lon"), F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"), F.count(F.lit(1)).alias("point_count"))
    dwell = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 60e6
    stay = F.concat(F.col("user_id"), F.lit(f"-{mark}-"), F.col("cluster").cast("string"))
    return stays.select("user_id", stay.alias("stay_id"), "center_lat", "center_lon", "start_time", "end_time", dwell.alias("dwell_minutes"), "point_count")


def detect_stays_dbscan(points: DataFrame, eps_m: float = 150.0, min_samples: int = 5) -> DataFrame:
    return stay_table(dbscan_labels(points, eps_m, min_samples))


def detect_stays_hdbscan(points: DataFrame, min_cluster_size: int = 5, min_samples: int | None = None, epsilon_m: float = 0.0) -> DataFrame:
    return stay_table(hdbscan_labels(points, min_cluster_size, min_samples, epsilon_m), "hdbstay")


def stay_candidates(a: DataFrame, b: DataFrame, radius_m: float = 100.0, overlap_min: float = 5.0) -> DataFrame:
    """Pairs of stays of one user, at most `radius_m` apart and overlapping for at least `overlap_min` minutes: user_id, a_stay, b_stay."""
    side = lambda df, m: df.select("user_id", *[F.col(c).alias(f"{m}_{c}") for c in ("stay_id", "center_lat", "center_lon", "start_time", "end_time")])
    pairs = interval_join(side(a, "a"), side(b, "b"), "user_id", ("a_start_time", "a_end_time"), ("b_start_time", "b_end_time"))
    apart = haversine_m(F.col("a_center_lat"), F.col("a_center_lon"), F.col("b_center_lat"), F.col("b_center_lon"))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    shared = (micros(F.least("a_end_time", "b_end_time")) - micros(F.greatest("a_start_time", "b_start_time"))) / 60e6
    return pairs.filter((apart <= radius_m) & (shared >= overlap_min)).select("user_id", F.col("a_stay_id").alias("a_stay"), F.col("b_stay_id").alias("b_stay"))


def first_matching(pairs: DataFrame) -> DataFrame:
    """The pairs (user_id, i, j) that a loop over a user's pairs in order takes, each i and j once.

    A pair that is the first of both its i and its j is taken by the loop whatever comes before, so all such pairs are taken at once, and
    their i and j leave with all their pairs; rounds go on until none is left. Each round is grouped by i and by j, never by user.
    """
    left, taken = written(pairs.select("user_id", "i", "j").distinct()), None
    while not left.isEmpty():
        first = left.groupBy("user_id", "i").agg(F.min("j").alias("j")).join(left.groupBy("user_id", "j").agg(F.min("i").alias("i")), ["user_id", "i", "j"])
        first = written(first)
        taken = first if taken is None else taken.unionByName(first)
        left = written(left.join(first.select("user_id", "i"), ["user_id", "i"], "left_anti").join(first.select("user_id", "j"), ["user_id", "j"], "left_anti"))
    return left if taken is None else taken


def match_stays(a: DataFrame, b: DataFrame, radius_m: float = 100.0, overlap_min: float = 5.0) -> DataFrame:
    """user_id, n_a, n_b, matched, overlap: greedy one-to-one matching in order of the stay numbers, and matched / (a + b - matched)."""
    number = lambda c: F.regexp_extract(c, r"(\d+)$", 1).cast("int")
    pairs = stay_candidates(a, b, radius_m, overlap_min).select("user_id", number("a_stay").alias("i"), number("b_stay").alias("j"))

    hits = first_matching(pairs).groupBy("user_id").agg(F.count(F.lit(1)).alias("matched"))
    counts = lambda df, m: df.groupBy("user_id").agg(F.count(F.lit(1)).alias(f"n_{m}"))
    both = counts(a, "a").join(counts(b, "b"), "user_id", "full").join(hits, "user_id", "left").na.fill(0)
    total = F.col("n_a") + F.col("n_b") - F.col("matched")
    return both.withColumn("overlap", F.when((F.col("n_a") > 0) & (F.col("n_b") > 0), F.col("matched") / total).otherwise(0.0))


def dispersion(stays: DataFrame, *keys: str, few: bool = False) -> DataFrame:
    """keys, dispersion_m: mean distance of the stays' centres to their mean centre; `few` keys (a parameter grid, or none) are sent to all tasks, so that none is gathered."""
    if not keys:
        return dispersion(stays.withColumn("_all", F.lit(1)), "_all", few=True).agg(F.first("dispersion_m").alias("dispersion_m"))
    middle = stays.groupBy(*keys).agg(F.avg("center_lat").alias("_a"), F.avg("center_lon").alias("_o"))
    d = haversine_m(F.col("center_lat"), F.col("center_lon"), F.col("_a"), F.col("_o"))
    return stays.join(F.broadcast(middle) if few else middle, list(keys)).groupBy(*keys).agg(F.avg(d).alias("dispersion_m"))


def stay_stats(stays: DataFrame) -> DataFrame:
    """Number, median dwell and population deviation of the centres of a stay table."""
    row = stays.agg(F.count(F.lit(1)).alias("stays"), F.stddev_pop("center_lat").alias("lat_std"), F.stddev_pop("center_lon").alias("lon_std"))
    return row.crossJoin(whole_quantiles(stays, "dwell_minutes")).select("stays", F.col("q")[0].alias("median_dwell_min"), "lat_std", "lon_std")  # one row each


def compare_by_user(first: DataFrame, second: DataFrame, radius_m: float = 100.0, overlap_min: float = 5.0) -> DataFrame:
    """Per user and for the two tables: stays, median dwell, dispersion, their differences (second less first), and overlap; `_all_` stands for everyone if a side is empty."""
    def side(df: DataFrame, m: str) -> DataFrame:
        base = df.groupBy("user_id").agg(F.count(F.lit(1)).alias(f"{m}_stays"), F.median("dwell_minutes").alias(f"{m}_median_dwell_min"))
        return base.join(dispersion(df, "user_id").withColumnRenamed("dispersion_m", f"{m}_dispersion_m"), "user_id", "left")

    both = side(first, "first").join(side(second, "second"), "user_id", "full").join(match_stays(first, second, radius_m, overlap_min).select("user_id", "overlap"), "user_id", "left")
    both = both.na.fill(0, ["first_stays", "second_stays"]).na.fill(0.0, ["overlap"])
    for c in ("stays", "median_dwell_min", "dispersion_m"):
        both = both.withColumn(f"delta_{c}", F.col(f"second_{c}") - F.col(f"first_{c}"))
    if first.isEmpty() or second.isEmpty():
        nobody = both.limit(0)
        extra = first.sparkSession.createDataFrame([("_all_",)], "user_id string")
        both = both.unionByName(nobody.unionByName(extra, allowMissingColumns=True))
    return both


def compare_overall(first: DataFrame, second: DataFrame, eps_m: float = 150.0, overlap_min: float = 5.0) -> DataFrame:
    """One row for two stay tables: number, median dwell and mean distance of the centres to their mean centre of each, and their overlap.

    Stays match within max(50, eps / 2) metres and for `overlap_min` minutes; the overlap is the matches of all users over the
    stays of both less the matches, 0 if a side is empty.
    """
    def side(df: DataFrame, m: str) -> DataFrame:
        counts = df.agg(F.count(F.lit(1)).alias(f"{m}_stays")).crossJoin(whole_quantiles(df, "dwell_minutes").select(F.col("q")[0].alias(f"{m}_median_dwell_min")))
        return counts.crossJoin(dispersion(df).withColumnRenamed("dispersion_m", f"{m}_dispersion_m"))

    hits = match_stays(first, second, max(50.0, eps_m / 2), overlap_min).agg(F.coalesce(F.sum("matched"), F.lit(0)).alias("_hits"))
    both = side(first, "first").crossJoin(side(second, "second")).crossJoin(hits)  # one row each
    total = F.col("first_stays") + F.col("second_stays") - F.col("_hits")
    return both.withColumn("overlap", F.when((F.col("first_stays") > 0) & (F.col("second_stays") > 0), F.col("_hits") / total).otherwise(0.0)).drop("_hits")


def home_work(stays: DataFrame) -> DataFrame:
    """user_id, home_stay_id, work_stay_id from stays (user_id, stay_id, start_time, end_time): home has the most night dwell (22 to 6), work the most midday dwell (10 to 17) on weekdays.

    A stay's time is cut at the hours' bounds of each day it touches. Ties go to the smaller stay id; null where no stay has such dwell.
    """
    df = stays.select("user_id", "stay_id", F.col("start_time").cast("timestamp").alias("s"), F.col("end_time").cast("timestamp").alias("e")).filter("s <= e")
    days = df.withColumn("day", F.explode(F.expr("sequence(to_date(s), to_date(e))")))
    start = F.unix_micros(F.col("day").cast("timestamp"))
    hour = 3_600_000_000
    inside = lambda a, b: F.greatest(F.least(F.unix_micros("e"), start + b * hour) - F.greatest(F.unix_micros("s"), start + a * hour), F.lit(0))
    night = F.sum(inside(0, 6) + inside(22, 24))
    midday = F.sum(F.when(F.weekday("day") < 5, inside(10, 17)).otherwise(0))
    per = days.groupBy("user_id", "stay_id").agg(night.alias("night"), midday.alias("midday"))
    most = lambda c: F.when(F.max(c) > 0, F.min_by("stay_id", F.struct(-F.col(c), F.col("stay_id"))))
    return per.groupBy("user_id").agg(most("night").alias("home_stay_id"), most("midday").alias("work_stay_id"))


def hotspot_grid(points: DataFrame, bins: int = 50) -> DataFrame:
    """ix, iy, points, users: bins x bins equal cells between the bounds of all points, those on an upper bound in the last one; cells without points are left out."""
    placed = points.filter("lat IS NOT NULL AND lon IS NOT NULL")
    ends = placed.agg(F.min("lat").alias("_a0"), F.max("lat").alias("_a1"), F.min("lon").alias("_o0"), F.max("lon").alias("_o1"))
    cell = lambda v, lo, hi: F.when(F.col(hi) > F.col(lo), F.least(F.floor((F.col(v) - F.col(lo)) / (F.col(hi) - F.col(lo)) * bins), F.lit(bins - 1))).otherwise(0).cast("int")
    return placed.join(F.broadcast(ends)).groupBy(cell("lon", "_o0", "_o1").alias("ix"), cell("lat", "_a0", "_a1").alias("iy")).agg(F.count(F.lit(1)).alias("points"), F.count_distinct("user_id").alias("users"))
