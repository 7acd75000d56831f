"""Robustness: parameter grids, distribution shifts over users and quarters, quality of map matching."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from ..functions.geo import EARTH_M, haversine_m
from ..functions.scalar import seconds_between
from . import dbscan, hdbscan
from .graph import written
from .ranks import running_sums, split_quantiles, whole_quantiles
from .stays import dispersion, stay_table
from .trips import drop_fast, order_of, with_before, with_motion

METRICS = ("distance_m", "duration_s", "avg_speed_kmh")


def _distance(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n_a, n_b, d from rows (keys, value, a, b) that count a value on each side."""
    totals = counts.groupBy(*keys).agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b")).filter("n_a > 0 AND n_b > 0")
    run = running_sums(counts, keys, [value], {"fa": F.col("a"), "fb": F.col("b")}).join(totals, keys)
    gap = F.abs(F.col("fa") / F.col("n_a") - F.col("fb") / F.col("n_b"))
    return run.groupBy(*keys).agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"), F.max(gap).alias("d"))


def ks_table(samples: DataFrame, keys: list[str], value: str, side: str) -> DataFrame:
    """keys, n_a, n_b, d: two-sample Kolmogorov-Smirnov distance of `value` between rows whose `side` is true and false.

    Values are counted first; the running counts are taken over ranges of values, not in one task per key.
    """
    counts = samples.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(F.col(side).cast("long")).alias("a"), F.sum((~F.col(side)).cast("long")).alias("b"))
    return _distance(counts, keys, value)


def ks_p(d: Column, n: Column, m: Column, terms: int = 60) -> Column:
    """Asymptotic p-value of a two-sample distance."""
    root = F.sqrt(n * m / (n + m)) * d
    term = lambda a, k: a + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * root * root)
    total = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), term)
    return F.when(root < 0.2, 1.0).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


#: Sizes up to which the p-value is exact.
EXACT_N = 10_000


def path_p(d: float, n: int, m: int) -> float:
    """Exact p-value of a two-sample distance: the share of all orders of n and m values whose distance is d or more.

    An order is a lattice path from (0, 0) to (n, m). The share of the paths to (i, j) that have left the band around the diagonal
    is 1 beyond the band and else the mean of that of (i - 1, j) and (i, j - 1), weighed i to j, so it is carried from one
    anti-diagonal to the next, without counts that overflow or small shares lost beside 1.
    """
    g = math.gcd(n, m)
    a, b = n // g, m // g
    h = round(d * a * m)  # the distance in steps of 1 / lcm(n, m)
    if h <= 0:
        return 1.0
    left = np.ones(n + 2)  # left[i + 1] for i on the last anti-diagonal; a border of ones
    left[1] = 0.0
    low0, high0 = 0, 0
    for s in range(1, n + m + 1):
        low = max((s * a - h) // (a + b) + 1, s - m, 0)
        high = min(-((-s * a - h) // (a + b)) - 1, n, s)
        if low > high:
            return 1.0
        i = np.arange(low, high + 1)
        own = (i * left[low : high + 1] + (s - i) * left[low + 1 : high + 2]) / s
        left[low0 + 1 : high0 + 2] = 1.0
        left[low + 1 : high + 2] = own
        low0, high0 = low, high
    return float(left[n + 1])


@F.pandas_udf(DoubleType())
def _exact_p(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([path_p(x, int(y), int(z)) for x, y, z in zip(d, n, m)])


def with_p(rows: DataFrame) -> DataFrame:
    """rows with p of their d, n_a and n_b: exact up to EXACT_N values a side, asymptotic beyond, null below two values a side.

    The rows are a report's, a few for each pair of samples, so the exact count may run in Python.
    """
    n, m = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    small = F.greatest("n_a", "n_b") <= EXACT_N
    exact = _exact_p(F.when(small, F.col("d")).otherwise(0.0), F.when(small, F.col("n_a")).otherwise(1), F.when(small, F.col("n_b")).otherwise(1))
    p = F.when(small, exact).otherwise(ks_p(F.col("d"), n, m))
    return rows.withColumn("p", F.when(F.least("n_a", "n_b") >= 2, p))


def long_metrics(trips: DataFrame, *keep: str) -> DataFrame:
    return trips.select(*keep, *METRICS).unpivot(list(keep), list(METRICS), "metric", "value")


def user_folds(trips: DataFrame, folds: int = 5, seed: int = 42) -> DataFrame:
    """user_id, fold: users in the order of a hash with the seed, dealt one by one, so folds differ by one user at most."""
    users = trips.select("user_id").distinct().withColumns({"_all": F.lit(1), "_hash": F.md5(F.concat("user_id", F.lit(f"-{seed}")))})
    ranked = running_sums(users, ["_all"], ["_hash", "user_id"], {"_rank": F.lit(1)})
    return ranked.select("user_id", F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int").alias("fold"))


def cross_user(trips: DataFrame, folds: int = 5, seed: int = 42) -> DataFrame:
    """fold, metric, n_a, n_b, d, p_asymptotic, p: each fold's users against all others."""
    tagged = long_metrics(trips.join(user_folds(trips, folds, seed).withColumnRenamed("fold", "own"), "user_id"), "own")
    each = tagged.groupBy("metric", "value", "own").count().filter("value IS NOT NULL")
    spread = each.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    weighted = spread.groupBy("fold", "metric", "value").agg(F.sum(F.when(F.col("own") == F.col("fold"), F.col("count")).otherwise(0)).alias("a"), F.sum(F.when(F.col("own") != F.col("fold"), F.col("count")).otherwise(0)).alias("b"))
    out = _distance(weighted, ["fold", "metric"], "value")
    return with_p(out.withColumn("p_asymptotic", ks_p(F.col("d"), F.col("n_a").cast("double"), F.col("n_b").cast("double"))))


def quarter(ts: Column) -> Column:
    t = ts.cast("timestamp")
    return F.concat(F.year(t).cast("string"), F.lit("Q"), F.quarter(t).cast("string"))


def period_stats(trips: DataFrame, period: Column | None = None) -> DataFrame:
    """period, metric, n, median, p25, p75. Few groups hold all trips, so their values are ranked over ranges."""
    df = trips.filter("start_time IS NOT NULL").withColumn("period", quarter(F.col("start_time")) if period is None else period)
    found = split_quantiles(long_metrics(df, "period"), ["period", "metric"], "value", (0.25, 0.5, 0.75))
    return found.select("period", "metric", "n", F.col("q")[1].alias("median"), F.col("q")[0].alias("p25"), F.col("q")[2].alias("p75"))


def temporal_shift(trips: DataFrame, period: Column | None = None) -> DataFrame:
    """period, next_period, metric, n_a, n_b, d, p_asymptotic, p of each period against the one after it.

    Values are counted once per period; a count then stands on both sides, as its own period's and as the one before's.
    """
    df = trips.filter("start_time IS NOT NULL").withColumn("period", quarter(F.col("start_time")) if period is None else period)
    counts = written(long_metrics(df, "period").filter("value IS NOT NULL").groupBy("period", "metric", "value").agg(F.count(F.lit(1)).alias("c")))
    periods = df.select("period").distinct()
    order = Window.orderBy("period")  # a row per period
    places = written(periods.withColumns({"before": F.lag("period").over(order), "after": F.lead("period").over(order)}))
    side = lambda p, n, a, b: F.struct(F.col(p).alias("period"), F.col(n).alias("next_period"), a.cast("long").alias("a"), b.cast("long").alias("b"))
    own, other = F.col("c"), F.lit(0)
    both = counts.join(places, "period").select("metric", "value", F.explode(F.array(side("period", "after", own, other), side("before", "period", other, own))).alias("s"))
    both = both.select("s.period", "s.next_period", "metric", "value", "s.a", "s.b").filter("period IS NOT NULL AND next_period IS NOT NULL")
    both = both.groupBy("period", "next_period", "metric", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    d = _distance(both, ["period", "next_period", "metric"], "value")
    return with_p(d.withColumn("p_asymptotic", ks_p(F.col("d"), F.col("n_a").cast("double"), F.col("n_b").cast("double"))))


def trip_grid(points: DataFrame, gaps: tuple[float, ...] = (10, 20, 30, 45), distances: tuple[float, ...] = (50, 100, 250), max_speed_kmh: float = 200.0) -> DataFrame:
    """gap_min, min_distance_m, trips, median_distance_m, median_duration_s.

    One shuffle on the user gives all gaps' trips, which are written once. Each value is counted once for a gap and metric, beside the number of
    those that each least distance keeps, so all cells' medians come from one run over ranges.
    """
    moved = drop_fast(with_motion(points), max_speed_kmh)
    pause = seconds_between(F.col("_before.timestamp"), F.col("timestamp"))
    df = with_before(moved).withColumns({f"_b{k}": F.when(pause.isNull() | (pause > g * 60.0), 1).otherwise(0) for k, g in enumerate(gaps)})
    so_far = order_of(df).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({f"_n{k}": F.sum(f"_b{k}").over(so_far) for k in range(len(gaps))})
    each = F.explode(F.array(*[F.struct(F.lit(float(g)).alias("gap_min"), F.col(f"_n{k}").alias("n"), F.when(F.col(f"_b{k}") == 1, 0.0).otherwise(F.col("dist_m")).alias("step")) for k, g in enumerate(gaps)]))
    own = df.select("user_id", "timestamp", each.alias("t")).groupBy("user_id", "t.gap_min", "t.n").agg(F.sum("t.step").alias("distance_m"), seconds_between(F.min("timestamp"), F.max("timestamp")).alias("duration_s"))
    own = written(own.select("gap_min", "distance_m", "duration_s"))
    kept = [F.when(F.col("distance_m") >= float(d), 1).otherwise(0).alias(f"_least{k}") for k, d in enumerate(distances)]
    long = own.select("gap_min", *kept, F.explode(F.create_map(F.lit("distance_m"), "distance_m", F.lit("duration_s"), "duration_s")).alias("metric", "value"))
    names = [f"_least{k}" for k in range(len(distances))]
    counts = written(long.groupBy("gap_min", "metric", "value").agg(*[F.sum(c).alias(c) for c in names]))
    totals = counts.groupBy("gap_min", "metric").agg(*[F.sum(c).alias(f"_t{c}") for c in names])
    run = running_sums(counts, ["gap_min", "metric"], ["value"], {f"_u{c}": F.col(c) for c in names}).join(F.broadcast(totals), ["gap_min", "metric"])  # a row per gap and metric
    at = lambda c, place: F.min(F.when(F.col(f"_u{c}") > place, F.col("value")))
    middle = lambda c: (at(c, F.floor((F.col(f"_t{c}") - 1) / 2)) + at(c, F.ceil((F.col(f"_t{c}") - 1) / 2))) / 2
    found = run.groupBy("gap_min", "metric", *[f"_t{c}" for c in names]).agg(*[middle(c).alias(f"_m{c}") for c in names])
    cells = F.explode(F.array(*[F.struct(F.lit(float(d)).alias("min_distance_m"), F.col(f"_t{c}").alias("trips"), F.col(f"_m{c}").alias("middle")) for d, c in zip(distances, names)]))
    of = lambda m: F.max(F.when(F.col("metric") == m, F.col("c.middle")))
    return found.select("gap_min", "metric", cells.alias("c")).filter("c.trips > 0").groupBy("gap_min", "c.min_distance_m").agg(F.max("c.trips").alias("trips"), of("distance_m").alias("median_distance_m"), of("duration_s").alias("median_duration_s"))


def _stay_rows(cells: list[tuple[dict, DataFrame]]) -> DataFrame:
    """For each cell of a grid its parameters, stays, users, median dwell, the dispersion of all its stays' centres and the median of the users' own; all cells are written, ranked and spread together.

    A cell without stays has 0 and nulls.
    """
    names = list(cells[0][0])
    stays = written(_union([df.select(*[F.lit(v).alias(k) for k, v in params.items()], "user_id", "dwell_minutes", "center_lat", "center_lon") for params, df in cells]))
    counts = stays.groupBy(*names).agg(F.count(F.lit(1)).alias("stays"), F.count_distinct("user_id").alias("users"))
    dwell = split_quantiles(stays, names, "dwell_minutes", (0.5,)).select(*names, F.col("q")[0].alias("median_dwell_min"))
    grid = stays.sparkSession.createDataFrame([tuple(params.values()) for params, _ in cells], stays.select(*names).schema)
    out = grid
    own = split_quantiles(written(dispersion(stays, *names, "user_id")), names, "dispersion_m", (0.5,)).select(*names, F.col("q")[0].alias("median_dispersion_m"))
    for part in (counts, dwell, dispersion(stays, *names, few=True), own):
        out = out.join(part, names, "left")
    return out.na.fill(0, ["stays", "users"])


def dbscan_grid(points: DataFrame, eps: tuple[float, ...] = (100, 150, 200), samples: tuple[int, ...] = (3, 5, 8)) -> DataFrame:
    """eps_m, min_samples and a summary of the stays they give; points are placed, and their neighbours counted, once for all."""
    cells = [{"eps_m": float(e), "min_samples": m} for e in eps for m in samples]
    return _stay_rows([(cell, stay_table(rows)) for cell, rows in zip(cells, dbscan.cluster_grid(written(dbscan.projected(points)), tuple(eps), tuple(samples)))])


def hdbscan_grid(points: DataFrame, sizes: tuple[int, ...] = (5, 8, 12), samples: tuple[int | None, ...] = (None, 5, 8), epsilons: tuple[float, ...] = (0.0, 25.0, 50.0)) -> DataFrame:
    """min_cluster_size, min_samples (-1 for none), epsilon_m and a summary of the stays they give; points are placed once, and trees are made once for each number of samples."""
    cells = [(c, m, float(e)) for c in sizes for m in samples for e in epsilons]
    found = hdbscan.cluster_grid(written(dbscan.projected(points)), [(c, m or c, e) for c, m, e in cells])
    return _stay_rows([({"min_cluster_size": c, "min_samples": -1 if m is None else m, "epsilon_m": e}, stay_table(rows, "hdbstay")) for (c, m, e), rows in zip(cells, found)])


def _union(rows: list[DataFrame]) -> DataFrame:
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def matching_pairs(points: DataFrame, matched: DataFrame) -> DataFrame:
    """Raw and matched points of one trip and place in it, with their order in the trip, both steps, the offset in metres and the drift in seconds."""
    ties = [c for c in ("event_id", "source_file") if c in points.columns]
    w = Window.partitionBy("trip_id").orderBy("timestamp", *ties)
    raw = points.withColumn("seq", (F.row_number().over(w) - 1).cast("int")).select("trip_id", "seq", "timestamp", "lat", "lon")
    both = raw.join(matched.select("trip_id", "seq", "snapped_time", "snapped_lat", "snapped_lon", "matched"), ["trip_id", "seq"])
    drift = F.abs(seconds_between(F.col("timestamp"), F.col("snapped_time")))
    offset = haversine_m(F.col("lat"), F.col("lon"), F.col("snapped_lat"), F.col("snapped_lon"))
    return _stepped(both.withColumns({"drift_s": drift, "offset_m": offset}))


#: Relative difference of two steps below which the last bits of sines and cosines may tell which is longer.
TIE = 1e-9


def _metres(a: float, o: float, b: float, p: float) -> float:
    """haversine_m() by the C library, as SQL engines have it."""
    k = math.pi / 180
    h = math.pow(math.sin((b * k - a * k) / 2), 2) + math.cos(a * k) * math.cos(b * k) * math.pow(math.sin((p * k - o * k) / 2), 2)
    return 2.0 * EARTH_M * math.atan2(math.sqrt(h), math.sqrt(1 - h))


@F.pandas_udf(BooleanType())
def _no_longer(a: pd.Series, o: pd.Series, b: pd.Series, p: pd.Series, sa: pd.Series, so: pd.Series, sb: pd.Series, sp: pd.Series) -> pd.Series:
    """Whether the second of two steps is no longer than the first; null where a is."""
    out = pd.Series([None] * len(a), dtype="object")
    for i in np.flatnonzero(a.notna()):
        out[i] = _metres(sa[i], so[i], sb[i], sp[i]) <= _metres(a[i], o[i], b[i], p[i])
    return out


def _stepped(both: DataFrame) -> DataFrame:
    """Pairs with place, raw_step, snapped_step and shorter (whether the matched step is no longer than the raw one, null if either is missing).

    A trip whose two places are moved alike has steps of the same length but for the last bits, in which the JVM's sines differ from the C library's; such
    steps, some in a hundred, are compared by the latter's.
    """
    w = Window.partitionBy("trip_id").orderBy("seq")
    ends = [F.lag(c).over(w).alias(f"_{c}") for c in ("lat", "lon", "snapped_lat", "snapped_lon")]
    df = both.select("*", (F.row_number().over(w) - 1).alias("place"), *ends)
    step = lambda a, o: haversine_m(F.col(f"_{a}"), F.col(f"_{o}"), F.col(a), F.col(o))
    df = df.withColumns({"raw_step": step("lat", "lon"), "snapped_step": step("snapped_lat", "snapped_lon")})
    close = F.abs(F.col("snapped_step") - F.col("raw_step")) <= TIE * F.col("raw_step")
    sides = [F.when(close, F.col(f"{m}{c}")) for s in ("", "snapped_") for m in ("_", "") for c in (f"{s}lat", f"{s}lon")]
    df = df.withColumn("shorter", F.coalesce(_no_longer(*sides), F.col("snapped_step") <= F.col("raw_step")))
    return df.drop("_lat", "_lon", "_snapped_lat", "_snapped_lon")


def _better() -> Column:
    """Whether a matched step is no longer than the raw one, not so if either is missing; null for a trip's first point."""
    return F.when(F.col("place") > 0, F.coalesce("shorter", F.lit(False)).cast("double"))


def matching_by_trip(pairs: DataFrame) -> DataFrame:
    """trip_id, points, mean_offset_m, improved_share, median_drift_s, failed (no point matched)."""
    return pairs.groupBy("trip_id").agg(F.count(F.lit(1)).alias("points"), F.avg("offset_m").alias("mean_offset_m"), F.avg(_better()).alias("improved_share"), F.median("drift_s").alias("median_drift_s"), F.bool_and(~F.coalesce("matched", F.lit(False))).alias("failed"))


def matching_quality(pairs: DataFrame, matched: DataFrame, thinned: tuple[int, ...] = (2, 3)) -> DataFrame:
    """One row: mean_offset_m, improved_share, median_drift_s of all pairs, failed_share of the matched table's trips, and for every k of `thinned` delta_{k}_offset_m and delta_{k}_improved.

    A delta is what is left with every k-th point of each trip, as the mean over trips of two such points at least, less the value over
    all pairs. The median is taken over ranges.
    """
    pairs = written(pairs)
    out = pairs.agg(F.avg("offset_m").alias("mean_offset_m"), F.avg(_better()).alias("improved_share"))
    out = out.crossJoin(whole_quantiles(pairs, "drift_s").select(F.col("q")[0].alias("median_drift_s")))  # one row each, as all that follows
    failed = matched.groupBy("trip_id").agg(F.bool_and(~F.coalesce("matched", F.lit(False))).alias("failed"))
    out = out.crossJoin(failed.agg(F.avg(F.col("failed").cast("double")).alias("failed_share")))
    for k in thinned:
        thin = _stepped(pairs.filter(F.col("place") % k == 0).select("trip_id", "seq", "lat", "lon", "snapped_lat", "snapped_lon", "offset_m"))
        trips = thin.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n"), F.avg("offset_m").alias("o"), F.avg(_better()).alias("s")).filter("n > 1")
        out = out.crossJoin(trips.agg(F.avg("o").alias("_o"), F.avg("s").alias("_s")))
        out = out.withColumns({f"delta_{k}_offset_m": F.col("_o") - F.col("mean_offset_m"), f"delta_{k}_improved": F.col("_s") - F.col("improved_share")}).drop("_o", "_s")
    return out


def ks_p_value(d: float, n: int, m: int) -> float:
    root = math.sqrt(n * m / (n + m)) * d
    return 1.0 if root < 0.2 else min(1.0, max(0.0, sum(2 * (-1) ** (k - 1) * math.exp(-2 * k * k * root * root) for k in range(1, 61))))
