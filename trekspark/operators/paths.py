"""Paths: encoding, recurring paths, origin-destination outliers, detours of matched traces."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_M, haversine_m, pair_text
from .graph import written
from .ranks import quantiles


def encoded_paths(points: DataFrame, rounding: int = 5, step: int = 5, order: tuple[str, ...] = ("timestamp",), lat: str = "lat", lon: str = "lon", length: bool = False) -> DataFrame:
    """trip_id, encoded_path ("lat:lon;lat:lon" of every step-th point with coordinates), and length_m of the kept points if asked."""
    df = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col("trip_id").isNotNull())
    ties = [c for c in ("event_id", "source_file") if c in df.columns and c not in order]
    w = Window.partitionBy("trip_id").orderBy(*order, *ties)
    if length:
        df = df.withColumn("_step", haversine_m(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon)))
    df = df.withColumn("_n", F.row_number().over(w) - 1)
    kept = F.when(F.col("_n") % step == 0, F.struct(F.col("_n"), pair_text(F.col(lat), F.col(lon), rounding, ":").alias("code")))
    path = F.array_join(F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["code"]), ";")
    more = [F.coalesce(F.sum("_step"), F.lit(0.0)).alias("length_m")] if length else []
    return df.groupBy("trip_id").agg(path.alias("encoded_path"), *more)


def decoded(path: Column) -> Column:
    """The vertices of an encoded path as an array of (lat, lon); malformed ones are passed over."""
    pair = lambda p: F.split(p, ":")
    vertex = F.transform(F.split(path, ";"), lambda p: F.struct(F.get(pair(p), F.lit(0)).try_cast("double").alias("lat"), F.get(pair(p), F.lit(1)).try_cast("double").alias("lon")))
    return F.filter(vertex, lambda v: v["lat"].isNotNull() & v["lon"].isNotNull())


def frequent_paths(points: DataFrame, trips: DataFrame, min_occurrences: int = 3, rounding: int = 5, step: int = 5) -> DataFrame:
    """encoded_path, occurrences, unique_users, avg_distance_m, avg_duration_s, sample_trip_id, most frequent first; trips without points form the empty path."""
    coded = trips.join(encoded_paths(points, rounding, step), "trip_id", "left").withColumn("encoded_path", F.coalesce("encoded_path", F.lit("")))
    groups = coded.groupBy("encoded_path").agg(F.count(F.lit(1)).alias("occurrences"), F.count_distinct("user_id").alias("unique_users"), F.avg("distance_m").alias("avg_distance_m"), F.avg("duration_s").alias("avg_duration_s"), F.min_by("trip_id", F.struct("user_id", "trip_seq")).alias("sample_trip_id"))
    return groups.filter(F.col("occurrences") >= min_occurrences).orderBy(F.desc("occurrences"), "encoded_path")


def frequent_matched_paths(matched: DataFrame, min_support: int = 5, precision: float = 1e-4, step: int = 5) -> DataFrame:
    """path_id, support_total (trips), support_users, avg_length_km of matched traces; the empty path is dropped."""
    digits = max(1, int(-math.log10(precision)))
    paths = encoded_paths(matched, digits, step, ("seq",), "snapped_lat", "snapped_lon", length=True)
    users = matched.groupBy("trip_id").agg(F.first("user_id").alias("user_id"))
    groups = paths.join(users, "trip_id").filter("encoded_path <> ''").groupBy(F.col("encoded_path").alias("path_id")).agg(F.count(F.lit(1)).alias("support_total"), F.count_distinct("user_id").alias("support_users"), (F.avg("length_m") / 1000.0).alias("avg_length_km"))
    return groups.filter(F.col("support_total") >= min_support).orderBy(F.desc("support_total"), "path_id")


def od_bin(digits: int = 3) -> Column:
    return F.concat(pair_text(F.col("start_lat"), F.col("start_lon"), digits), F.lit("->"), pair_text(F.col("end_lat"), F.col("end_lon"), digits))


def od_outliers(trips: DataFrame, multiplier: float = 1.5, digits: int = 3, accuracy: int | None = None) -> DataFrame:
    """Trips with od_bin, is_distance_outlier, is_duration_outlier, outlier_reason: strictly outside the quartiles' fences of their bin.

    The fences are aggregated once a bin and joined back, so a hot bin isn't gathered for a window; give an accuracy where bins hold more different
    values than fit in memory.
    """
    df = trips.withColumn("od_bin", od_bin(digits))
    quart = lambda c: quantiles(c, (0.25, 0.75), accuracy)
    fences = df.groupBy("od_bin").agg(quart("distance_m").alias("_d"), quart("duration_s").alias("_t"))
    both = df.join(fences, "od_bin")

    def out(c: str, q: str) -> Column:
        spread = (F.col(q)[1] - F.col(q)[0]) * multiplier
        return F.coalesce((F.col(c) < F.col(q)[0] - spread) | (F.col(c) > F.col(q)[1] + spread), F.lit(False))

    both = both.withColumns({"is_distance_outlier": out("distance_m", "_d"), "is_duration_outlier": out("duration_s", "_t")})
    reason = F.concat_ws(",", F.when(F.col("is_distance_outlier"), "distance"), F.when(F.col("is_duration_outlier"), "duration"))
    return both.withColumn("outlier_reason", reason).drop("_d", "_t")


#: Distances that a task holds at a time, trips and paths that meet in one group, and the first reach in metres with its growth.
CELLS, TOGETHER, FIRST_M, GROWTH = 1 << 21, 2048, 500.0, 4.0
#: Farther than any two places.
WHOLE_M = math.pi * EARTH_M + 1.0


def closest_paths(matched: DataFrame, baseline: DataFrame, first_m: float = FIRST_M) -> DataFrame:
    """The matched points with path_id, the baseline path closest to their trip, and deviation_m, their distance to its nearest vertex.

    The closest path has the lowest median deviation over the trip (ties: the smaller id). A median of r or less needs a vertex within r of half of the
    trip's points, so an index of the cells around the paths' vertices tells which paths can have one; trips and paths
    meet by cell, in bounded groups, and nothing is sent to all tasks. A trip whose best median is within r is settled, for no other path
    can come closer; the others go on with a longer reach, at last the whole earth. Paths of the same vertices, in whatever order and number, are equally
    far from every point, so only the smallest id among them is compared. Points without coordinates and, where no baseline path has two
    vertices, all points are left out.
    """
    points = matched.filter("snapped_lat IS NOT NULL AND snapped_lon IS NOT NULL").select("user_id", "trip_id", "seq", "snapped_time", "snapped_lat", "snapped_lon")
    paths = baseline.select("path_id", decoded(F.col("path_id")).alias("v")).filter(F.size("v") >= 2)
    paths = written(paths.groupBy(F.array_sort(F.array_distinct("v")).alias("v")).agg(F.min("path_id").alias("path_id")))
    left = written(points.groupBy("trip_id").agg(F.collect_list(F.struct(F.col("snapped_lat").alias("lat"), F.col("snapped_lon").alias("lon"))).alias("pts")))
    found, reach = left.select("trip_id", F.lit("").alias("path_id")).limit(0), first_m
    while not (paths.isEmpty() or left.isEmpty()):
        near = written(_best_within(left, paths, reach))
        good = near.filter(F.col("m") <= reach).select("trip_id", "path_id")
        found = found.unionByName(good)
        if reach >= WHOLE_M:
            break
        left = written(left.join(good, "trip_id", "left_anti"))
        reach = min(reach * (GROWTH if left.count() > TOGETHER else GROWTH**3), WHOLE_M)  # few trips may meet many paths in vain
    own = points.join(found, "trip_id").join(paths, "path_id")
    apart = F.array_min(F.transform("v", lambda v: haversine_m(F.col("snapped_lat"), F.col("snapped_lon"), v["lat"], v["lon"])))
    return own.withColumn("deviation_m", apart).select("user_id", "trip_id", "seq", "snapped_time", "snapped_lat", "snapped_lon", "path_id", "deviation_m")


def _cell(lat: Column, lon: Column, size_m: float, step: tuple = (0, 0, 0)) -> Column:
    """A name for the cube of this size that holds a place on the globe, or the one some cubes on. Places within that distance lie in neighbouring cubes, also at the poles and where longitudes wrap."""
    a, o = F.radians(lat), F.radians(lon)
    at = (F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a))
    return F.xxhash64(*[F.floor(x * (EARTH_M / size_m)) + k for x, k in zip(at, step)])


def _best_within(trips: DataFrame, paths: DataFrame, reach: float) -> DataFrame:
    """trip_id, m, path_id: the lowest median of each trip among paths that can have one of `reach` or less; none for trips that have no such path."""
    n = F.size("pts")
    own = trips.select("trip_id", n.alias("n"), F.explode("pts").alias("p")).groupBy("trip_id", "n", _cell(F.col("p.lat"), F.col("p.lon"), reach).alias("cell")).agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("trip_id").orderBy(F.desc("c"), "cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # A path near half of the points is near one of the cells that hold more than the other half, the fullest ones first.
    anchors = written(own.withColumn("before", before).filter(F.col("before") <= F.floor(F.col("n") / 2)).select("trip_id", "cell"))
    steps = F.array(*[F.struct(*[F.lit(k).alias(c) for c, k in zip("xyz", (x, y, z))]) for x in (-1, 0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1)])
    around = paths.select("path_id", F.explode("v").alias("p")).select("path_id", F.col("p.lat").alias("a"), F.col("p.lon").alias("o")).distinct().withColumn("s", F.explode(steps))
    around = around.select("path_id", _cell(F.col("a"), F.col("o"), reach, (F.col("s.x"), F.col("s.y"), F.col("s.z"))).alias("cell")).distinct()
    around = written(around.join(anchors.select("cell").distinct(), "cell", "left_semi"))
    parts = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).cast("int").alias(name))
    both = written(parts(anchors, "lots").join(parts(around, "blocks"), "cell"))
    part = lambda key, count: F.pmod(F.xxhash64(key), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    asked = anchors.join(both, "cell").select("trip_id", "cell", part("trip_id", "lots").alias("lot"), every("blocks").alias("block")).join(trips, "trip_id")
    given = around.join(both, "cell").select("path_id", "cell", part("path_id", "blocks").alias("block"), every("lots").alias("lot")).join(paths, "path_id")
    key = ["cell", "lot", "block"]
    near = asked.groupBy(*key).cogroup(given.groupBy(*key)).applyInArrow(_medians, "trip_id string, m double, path_id string")
    return near.groupBy("trip_id").agg(F.min(F.struct("m", "path_id")).alias("b")).select("trip_id", "b.m", "b.path_id")


def _medians(trips: pa.Table, paths: pa.Table) -> pa.Table:
    """The lowest median of each trip over the paths (ties: the smaller id). Trips of one length are measured together, and vertices that paths share once."""
    if not (trips.num_rows and paths.num_rows):  # a lot or block that no id fell into
        return pa.table({"trip_id": pa.array([], pa.string()), "m": pa.array([], pa.float64()), "path_id": pa.array([], pa.string())})
    names = paths["path_id"].to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    vertices, ends = _flat(paths["v"].combine_chunks().take(pa.array(order)))
    points, stops = _flat(trips["pts"].combine_chunks())
    lengths = np.diff(stops)
    best, which = np.full(trips.num_rows, np.inf), np.zeros(trips.num_rows, np.int64)
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        for lo, hi in _slices(ends, max(1, CELLS // int(n))):
            places, at = np.unique(vertices[ends[lo] : ends[hi]], axis=0, return_inverse=True)
            at, cut = at.reshape(-1), ends[lo:hi] - ends[lo]
            room = max(1, CELLS // (int(n) * len(at)))
            for k in range(0, len(own), room):
                some = own[k : k + room]
                lat, lon = points[(stops[some][:, None] + np.arange(n)).reshape(-1)].T
                near = np.minimum.reduceat(_distances(lat, lon, places)[:, at], cut, axis=1)
                medians = np.median(near.reshape(len(some), n, hi - lo), axis=1)
                first = np.argmin(medians, axis=1)
                lowest = medians[np.arange(len(some)), first]
                closer = lowest < best[some]
                best[some[closer]], which[some[closer]] = lowest[closer], first[closer] + lo
    return pa.table({"trip_id": trips["trip_id"], "m": pa.array(best, pa.float64()), "path_id": pa.array([names[order[k]] for k in which], pa.string())})


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all lists as (lat, lon) in radians, and where each list begins and the last one ends."""
    places = lists.flatten()
    return np.radians(np.column_stack([places.field(c).to_numpy() for c in ("lat", "lon")])), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()


def _slices(ends: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of lists in order with `most` elements or fewer each, or one list."""
    out, lo = [], 0
    while lo < len(ends) - 1:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, side="right")) - 1)
        out.append((lo, hi))
        lo = hi
    return out


def _distances(lat: np.ndarray, lon: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Great-circle metres from each point (a row) to each place (a column), all in radians."""
    h = np.sin((places[:, 0] - lat[:, None]) / 2) ** 2 + np.cos(lat)[:, None] * np.cos(places[:, 0]) * np.sin((places[:, 1] - lon[:, None]) / 2) ** 2
    return 2.0 * EARTH_M * np.arctan2(np.sqrt(h), np.sqrt(1 - h))


def matched_detours(matched: DataFrame, baseline: DataFrame, threshold_m: float = 200.0, min_span_m: float = 300.0) -> DataFrame:
    """Spans of a trip that stay farther than `threshold_m` from its closest baseline path for at least `min_span_m`.

    A span's length includes the step into it.
    """
    own = closest_paths(matched, baseline)
    w = Window.partitionBy("trip_id").orderBy("snapped_time", "seq")
    step = F.coalesce(haversine_m(F.lag("snapped_lat").over(w), F.lag("snapped_lon").over(w), F.col("snapped_lat"), F.col("snapped_lon")), F.lit(0.0))
    own = own.withColumns({"step": step, "over": F.col("deviation_m") > threshold_m, "n": F.row_number().over(w)})
    island = F.col("n") - F.row_number().over(Window.partitionBy("trip_id", "over").orderBy("snapped_time", "seq"))
    spans = own.withColumn("island", island).filter("over").groupBy("user_id", "trip_id", "path_id", "island").agg(F.min("snapped_time").alias("start_time"), F.max("snapped_time").alias("end_time"), F.max("deviation_m").alias("max_deviation_m"), F.sum("step").alias("span_m"))
    return spans.filter(F.col("span_m") >= min_span_m).select("user_id", "trip_id", "start_time", "end_time", "max_deviation_m", "span_m", "path_id")


def farthest_points(points: DataFrame, matched: DataFrame, top: int = 100) -> DataFrame:
    """The points farthest from their matched place: user_id, timestamp, detour_m; a top-k report."""
    pairs = points.select("user_id", "timestamp", "lat", "lon").join(matched.select("user_id", F.col("snapped_time").alias("timestamp"), "snapped_lat", "snapped_lon"), ["user_id", "timestamp"])
    return pairs.withColumn("detour_m", haversine_m(F.col("lat"), F.col("lon"), F.col("snapped_lat"), F.col("snapped_lon"))).orderBy(F.desc("detour_m"), "user_id", "timestamp").limit(top)


def drawn_paths(points: DataFrame) -> DataFrame:
    """user_id, trip_id, path: each trip's points in order, for trips of two points at least."""
    path = F.array_sort(F.collect_list(F.struct("timestamp", "lat", "lon")))
    return points.filter("lat IS NOT NULL AND lon IS NOT NULL").groupBy("user_id", "trip_id").agg(path.alias("path")).filter(F.size("path") >= 2)
