"""One query per operator over the driver's tables, with the SQL that gives the same rows where SQL can say it.

Times leave a query as whole microseconds, other floats are rounded alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.geo import BASE32, from_plane, pair_text, to_plane
from .operators import features, matching, modes, paths, profile, report, stays, trips, validate
from .operators.joins import grid_join
from .plans import events
from .plans.events import GAP_MIN, LAT, LON
from .operators.graph import scratch_folder, written
from .sources.readers import read_artifact
from .sources.schema import conform
from .sources.sinks import save_artifact
from .streaming.trips import session_trips, trips_so_far

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def us(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp")).alias(c)


def rnd(c: str | Column, digits: int = 4, name: str | None = None) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits).alias(name or c)


def points(spark: SparkSession, sf: str) -> DataFrame:
    return events.points(spark, sf)


def moved(spark: SparkSession, sf: str) -> DataFrame:
    return trips.drop_fast(trips.with_motion(points(spark, sf)))


def cut(spark: SparkSession, sf: str, gap: float = GAP_MIN, least: float = 100.0):
    return trips.segment_trips(moved(spark, sf), gap, least)


def all_cut(spark: SparkSession, sf: str):
    """Points and trips at a gap of a day, with no trip dropped."""
    numbered = trips.number_trips(moved(spark, sf), 1440.0)
    return numbered.drop("_begins"), trips.trip_table(numbered)


# --- SQL building blocks -------------------------------------------------------------------------------------------


def hav(a: str, o: str, b: str, p: str) -> str:
    h = f"(pow(sin((radians({b}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin((radians({p}) - radians({o})) / 2), 2))"
    return f"(2.0::DOUBLE * 6371000 * atan2(sqrt({h}), sqrt(1 - {h})))"


P = f"p AS (SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS timestamp, event_id, {LAT} AS lat, {LON} AS lon FROM events)"
M = f"""{P}, l AS (SELECT *, lag(lat) OVER w AS la, lag(lon) OVER w AS lo, lag(timestamp) OVER w AS lt FROM p WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, event_id)),
m0 AS (SELECT user_id, timestamp, event_id, lat, lon, coalesce({hav('la', 'lo', 'lat', 'lon')}, 0) AS dist_m, coalesce((epoch_us(timestamp) - epoch_us(lt)) / 1e6, 0) AS dt_s FROM l),
mm AS (SELECT *, CASE WHEN dt_s > 0 THEN dist_m / dt_s * 3.6 END AS speed_kmh FROM m0), m AS (SELECT * FROM mm WHERE speed_kmh IS NULL OR speed_kmh <= 200)"""


def numbered_sql(gap: float, least: float | None) -> str:
    """CTEs n (points with trips, all of them), t (trips kept) and k (points of kept trips)."""
    keep = "" if least is None else f" WHERE distance_m >= {least}"
    return f"""{M}, g AS (SELECT *, lag(timestamp) OVER w AS gt FROM m WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, event_id)),
b AS (SELECT *, CASE WHEN gt IS NULL OR (epoch_us(timestamp) - epoch_us(gt)) / 1e6 > {gap * 60} THEN 1 ELSE 0 END AS begins FROM g),
n AS (SELECT *, CAST(sum(begins) OVER (PARTITION BY user_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) - 1 AS INTEGER) AS trip_seq FROM b),
t0 AS (SELECT user_id, trip_seq, user_id || '-' || trip_seq AS trip_id, min(timestamp) AS start_time, max(timestamp) AS end_time, count(*) AS points, sum(CASE WHEN begins = 1 THEN 0 ELSE dist_m END) AS distance_m,
 arg_min(lat, event_key) AS start_lat, arg_min(lon, event_key) AS start_lon, arg_max(lat, event_key) AS end_lat, arg_max(lon, event_key) AS end_lon FROM (SELECT *, (epoch_us(timestamp)::HUGEINT * 1000000000 + event_id) AS event_key FROM n) GROUP BY user_id, trip_seq),
t1 AS (SELECT *, (epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS duration_s FROM t0),
t AS (SELECT *, CASE WHEN duration_s > 0 THEN distance_m / duration_s * 3.6 ELSE 0 END AS avg_speed_kmh FROM t1{keep}),
k AS (SELECT n.*, t.trip_id FROM n JOIN t USING (user_id, trip_seq))"""


T = numbered_sql(GAP_MIN, 100)
DAY = numbered_sql(1440, None)
MODE = "CASE WHEN avg_speed_kmh <= 6 THEN 'walk' WHEN avg_speed_kmh <= 20 THEN 'bike' WHEN avg_speed_kmh <= 40 THEN 'bus' ELSE 'car' END"
ACC = f"""{M}, a AS (SELECT *, greatest(-5, least(5, CASE WHEN dt_s > 0 THEN (speed_kmh - lag(speed_kmh) OVER (PARTITION BY user_id ORDER BY timestamp, event_id)) / 3.6 / dt_s END)) AS acc0,
 CASE WHEN dt_s > 0 THEN (speed_kmh - lag(speed_kmh) OVER (PARTITION BY user_id ORDER BY timestamp, event_id)) END AS d FROM m), ac AS (SELECT *, CASE WHEN d IS NOT NULL THEN acc0 END AS accel_mps2 FROM a)"""


def text(v: str, digits: int) -> str:
    return f"printf('%.{digits}f', round({v}, {digits}) + 0.0)"


def pair(lat: str, lon: str, digits: int, between: str) -> str:
    return f"{text(lat, digits)} || '{between}' || {text(lon, digits)}"


MATCHED = """x AS (SELECT user_id, trip_id, CAST(row_number() OVER (PARTITION BY trip_id ORDER BY timestamp, event_id) - 1 AS INTEGER) AS seq, lat, lon, lat + CAST(event_id % 5 - 2 AS DOUBLE) / CAST(50000 AS DOUBLE) AS snapped_lat,
 lon + CAST(event_id % 3 - 1 AS DOUBLE) / CAST(50000 AS DOUBLE) AS snapped_lon, timestamp AS snapped_time, CAST(event_id % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence, event_id % 10 <> 0 AS matched, CAST(event_id * 37 % 360 AS DOUBLE) AS heading_deg FROM k)"""


# --- Kinematics and trips ------------------------------------------------------------------------------------------


@query(f"WITH {M} SELECT event_id, round(dist_m, 3) AS dist_m, dt_s, round(speed_kmh, 5) AS speed_kmh FROM mm")
def motion(spark, sf):
    return trips.with_motion(points(spark, sf)).select("event_id", rnd("dist_m", 3), "dt_s", rnd("speed_kmh", 5))


@query(f"WITH {M} SELECT count(*) AS n, count(DISTINCT user_id) AS users, CAST(sum(event_id) AS BIGINT) AS ids FROM m")
def speed_filter(spark, sf):
    return moved(spark, sf).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.sum("event_id").alias("ids"))


@query(f"WITH {T} SELECT user_id, trip_seq, trip_id, epoch_us(start_time) AS start_time, epoch_us(end_time) AS end_time, points, round(distance_m, 3) AS distance_m, duration_s, round(avg_speed_kmh, 5) AS avg_speed_kmh, {MODE} AS mode_heuristic FROM t")
def trips_with_modes(spark, sf):
    _, t = cut(spark, sf)
    return modes.label_modes(t).select("user_id", "trip_seq", "trip_id", us("start_time"), us("end_time"), "points", rnd("distance_m", 3), "duration_s", rnd("avg_speed_kmh", 5), "mode_heuristic")


@query(f"WITH {T} SELECT event_id, trip_id FROM k")
def trip_points(spark, sf):
    return cut(spark, sf)[0].select("event_id", "trip_id")


@query(f"WITH {T} SELECT trip_id, round(start_lat, 6) AS start_lat, round(start_lon, 6) AS start_lon, round(end_lat, 6) AS end_lat, round(end_lon, 6) AS end_lon FROM t WHERE points >= 3")
def trip_ends_min_points(spark, sf):
    _, t = trips.segment_trips(moved(spark, sf), GAP_MIN, 100.0, 3)
    return t.select("trip_id", *[rnd(c, 6) for c in ("start_lat", "start_lon", "end_lat", "end_lon")])


@query("WITH e AS (SELECT CAST(user_id AS VARCHAR) AS user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM events), s AS (SELECT *, sum(CASE WHEN b IS NULL OR ts - b > INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM e) SELECT user_id, epoch_us(min(ts)) AS start_time, epoch_us(max(ts)) AS end_time, count(*) AS points FROM s GROUP BY user_id, g")
def session_window_trips(spark, sf):
    return session_trips(points(spark, sf), 30.0).select("user_id", us("start_time"), us("end_time"), "points")


@query(f"WITH {T}, wm AS (SELECT (epoch_us(max(timestamp)) // 1000 - 172800000) * 1000 AS w FROM p) SELECT user_id, trip_seq, trip_id, epoch_us(start_time) AS start_time, epoch_us(end_time) AS end_time, points, round(distance_m, 3) AS distance_m, duration_s, round(avg_speed_kmh, 5) AS avg_speed_kmh, round(start_lat, 6) AS start_lat, round(end_lon, 6) AS end_lon FROM t, wm WHERE w - epoch_us(end_time) > {int(GAP_MIN * 60_000_000)}")
def streamed_trips(spark, sf):
    """A stateful stream over the events: the trips that its watermark, two days behind the latest time, has closed."""
    t = trips_so_far(events.point_stream(spark, sf), scratch_folder(spark, "stream"), GAP_MIN, 100.0, "2 days")
    return t.select("user_id", "trip_seq", "trip_id", us("start_time"), us("end_time"), "points", rnd("distance_m", 3), "duration_s", rnd("avg_speed_kmh", 5), rnd("start_lat", 6), rnd("end_lon", 6))


@query("\nUNION ALL\n".join(f"SELECT * FROM (WITH {numbered_sql(g, None)} SELECT CAST({g} AS DOUBLE) AS gap_min, CAST(d AS DOUBLE) AS min_distance_m, count(*) AS trips, round(median(distance_m), 3) AS median_distance_m, round(median(duration_s), 3) AS median_duration_s FROM t, (VALUES (50), (100), (250)) v(d) WHERE distance_m >= d GROUP BY d)" for g in (480, 720, 1440)))
def trip_grid(spark, sf):
    return validate.trip_grid(points(spark, sf), (480, 720, 1440)).select("gap_min", "min_distance_m", "trips", rnd("median_distance_m", 3), rnd("median_duration_s", 3))


# --- Features ------------------------------------------------------------------------------------------------------


@query(f"WITH {ACC} SELECT event_id, round(accel_mps2, 7) + 0.0 AS accel_mps2 FROM ac")
def acceleration(spark, sf):
    return features.with_acceleration(moved(spark, sf)).select("event_id", (F.round("accel_mps2", 7) + F.lit(0.0)).alias("accel_mps2"))


@query("SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour, isodow(ts) >= 6 AS is_weekend, CASE WHEN hour(ts) >= 22 OR hour(ts) < 6 THEN 'night' WHEN hour(ts) < 10 THEN 'morning' WHEN hour(ts) < 17 THEN 'midday' ELSE 'evening' END AS time_of_day FROM events")
def calendar_features(spark, sf):
    return features.with_calendar(points(spark, sf)).select("event_id", "year", "month", "day", "weekday", "hour", "is_weekend", "time_of_day")


def _geohash_sql(precision: int) -> str:
    x_bits, y_bits = (5 * precision + 1) // 2, 5 * precision // 2
    axis = lambda v, low, span, bits: f"least(greatest(CAST(floor(({v} - ({low})) / {span} * {1 << bits}) AS BIGINT), 0), {(1 << bits) - 1})"
    letters = []
    for c in range(precision):
        bits = []
        for k in range(5):
            place = 5 * c + k
            source, total = ("x", x_bits) if place % 2 == 0 else ("y", y_bits)
            bits.append(f"((({source} >> {total - 1 - place // 2}) & 1) << {4 - k})")
        letters.append(f"substr('{BASE32}', CAST({' + '.join(bits)} + 1 AS INTEGER), 1)")
    return f"WITH {P}, q AS (SELECT event_id, {axis('lon', '-180.0', '360.0', x_bits)} AS x, {axis('lat', '-90.0', '180.0', y_bits)} AS y FROM p) SELECT event_id, {' || '.join(letters)} AS geohash FROM q"


@query(_geohash_sql(7))
def geohashes(spark, sf):
    return features.with_geohash(points(spark, sf)).select("event_id", "geohash")


@query(f"WITH {P} SELECT event_id, {pair('(lat + 0.00001::DOUBLE)', '(lon + 0.00001::DOUBLE)', 3, '_')} AS geohash FROM p")
def rounded_cells(spark, sf):
    off = points(spark, sf).withColumns({"lat": F.col("lat") + 0.00001, "lon": F.col("lon") + 0.00001})  # away from halves
    return features.with_geohash(off, 0).select("event_id", "geohash")


@query(f"WITH {M} SELECT event_id, round(sum(CASE WHEN speed_kmh <= 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY epoch_us(timestamp) RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) / (86400 / 60.0), 8) AS stop_density_per_min FROM m")
def stop_density(spark, sf):
    return features.with_stop_density(moved(spark, sf), 86_400).select("event_id", rnd("stop_density_per_min", 8))


@query(f"WITH {ACC} SELECT event_id, round(stddev_samp(accel_mps2) OVER (PARTITION BY user_id ORDER BY epoch_us(timestamp) RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW), 6) AS accel_roll_std FROM ac")
def accel_spread(spark, sf):
    return features.with_accel_spread(moved(spark, sf), 86_400).select("event_id", rnd("accel_roll_std", 6))


@query(f"WITH {DAY}, aa AS (SELECT *, CASE WHEN dt_s > 0 THEN greatest(-5, least(5, (speed_kmh - ls) / 3.6 / dt_s)) END AS a0 FROM (SELECT *, lag(speed_kmh) OVER (PARTITION BY user_id ORDER BY timestamp, event_id) AS ls FROM k)), ab AS (SELECT trip_id, CASE WHEN ls IS NOT NULL AND speed_kmh IS NOT NULL THEN a0 END AS a FROM aa) SELECT trip_id, round(stddev_pop(a), 6) AS accel_std, round(quantile_cont(a, 0.75) - quantile_cont(a, 0.25), 6) AS accel_iqr FROM ab GROUP BY trip_id")
def accel_by_trip(spark, sf):
    return features.accel_by_trip(all_cut(spark, sf)[0]).select("trip_id", rnd("accel_std", 6), rnd("accel_iqr", 6))


#: Stays for the interval joins: each user's events of one kind, from the first to the last of a day.
DAY_STAYS = "SELECT CAST(user_id AS {s}) AS user_id, min(ts) AS start_time, max(ts) AS end_time FROM events WHERE event_type IN ('view', 'click') GROUP BY user_id, CAST(ts AS DATE)"


def day_stays(spark, sf):
    spark.read.parquet(f"{sf}/events.parquet").createOrReplaceTempView("trek_events")
    return spark.sql(DAY_STAYS.format(s="STRING").replace("FROM events", "FROM trek_events")).select("user_id", F.col("start_time").cast("timestamp"), F.col("end_time").cast("timestamp"))


@query(f"WITH {T}, s AS ({DAY_STAYS.format(s='VARCHAR')}), o AS (SELECT trip_id, sum(greatest(0, (epoch_us(least(t.end_time, s.end_time)) - epoch_us(greatest(t.start_time, s.start_time))) / 1e6)) AS dwell FROM t JOIN s ON t.user_id = s.user_id AND s.start_time <= t.end_time AND t.start_time <= s.end_time GROUP BY trip_id) SELECT t.trip_id, round(CASE WHEN duration_s > 0 THEN coalesce(dwell, 0) / duration_s END, 6) AS dwell_ratio FROM t LEFT JOIN o USING (trip_id)")
def dwell_ratio(spark, sf):
    return features.dwell_ratio(cut(spark, sf)[1], day_stays(spark, sf)).select("trip_id", rnd("dwell_ratio", 6))


@query(f"WITH {T}, r AS (SELECT user_id, timestamp, sum(CASE WHEN speed_kmh <= 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY epoch_us(timestamp) RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) / (86400 / 60.0) AS d FROM m) SELECT trip_id, round(avg(d), 7) AS mean_stop_density FROM t JOIN r ON t.user_id = r.user_id AND r.timestamp BETWEEN t.start_time AND t.end_time GROUP BY trip_id")
def stop_density_by_trip(spark, sf):
    rated = features.with_stop_density(moved(spark, sf), 86_400)
    return features.stop_density_by_trip(rated, cut(spark, sf)[1]).select("trip_id", rnd("mean_stop_density", 7))


# --- Paths ---------------------------------------------------------------------------------------------------------

PATH2 = f"c AS (SELECT trip_id, string_agg({pair('lat', 'lon', 2, ':')}, ';' ORDER BY rn) AS code FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY timestamp, event_id) - 1 AS rn FROM k) WHERE rn % 5 = 0 GROUP BY trip_id)"


@query(f"WITH {DAY}, {PATH2} SELECT trip_id, code AS encoded_path FROM c")
def encoded_paths(spark, sf):
    return paths.encoded_paths(all_cut(spark, sf)[0], 2, 5).select("trip_id", "encoded_path")


@query(f"WITH {DAY}, {PATH2}, v AS (SELECT trip_id, unnest(string_split(code, ';')) AS p FROM c) SELECT trip_id, count(*) AS vertices, round(sum(CAST(split_part(p, ':', 1) AS DOUBLE)), 4) AS lat_sum FROM v GROUP BY trip_id")
def decoded_paths(spark, sf):
    coded = paths.encoded_paths(all_cut(spark, sf)[0], 2, 5).withColumn("v", F.explode(paths.decoded(F.col("encoded_path"))))
    return coded.groupBy("trip_id").agg(F.count(F.lit(1)).alias("vertices"), rnd(F.sum("v.lat"), 4, "lat_sum"))


@query(f"WITH {DAY}, {PATH2} SELECT coalesce(code, '') AS encoded_path, count(*) AS occurrences, count(DISTINCT user_id) AS unique_users, round(avg(distance_m), 3) AS avg_distance_m, round(avg(duration_s), 3) AS avg_duration_s, arg_min(trip_id, user_id || chr(1) || printf('%08d', trip_seq)) AS sample_trip_id FROM t LEFT JOIN c USING (trip_id) GROUP BY 1 HAVING count(*) >= 2")
def frequent_paths(spark, sf):
    p, t = all_cut(spark, sf)
    return paths.frequent_paths(p, t, 2, 2, 5).select("encoded_path", "occurrences", "unique_users", rnd("avg_distance_m", 3), rnd("avg_duration_s", 3), "sample_trip_id")


OD = f"{pair('start_lat', 'start_lon', 2, '_')} || '->' || {pair('end_lat', 'end_lon', 2, '_')}"


@query(f"WITH {DAY}, o AS (SELECT *, {OD} AS od_bin FROM t), q AS (SELECT od_bin, quantile_cont(distance_m, 0.25) AS d1, quantile_cont(distance_m, 0.75) AS d3, quantile_cont(duration_s, 0.25) AS t1, quantile_cont(duration_s, 0.75) AS t3 FROM o GROUP BY od_bin), z AS (SELECT trip_id, od_bin, distance_m < d1 - 1.5 * (d3 - d1) OR distance_m > d3 + 1.5 * (d3 - d1) AS is_distance_outlier, duration_s < t1 - 1.5 * (t3 - t1) OR duration_s > t3 + 1.5 * (t3 - t1) AS is_duration_outlier FROM o JOIN q USING (od_bin)) SELECT *, concat_ws(',', CASE WHEN is_distance_outlier THEN 'distance' END, CASE WHEN is_duration_outlier THEN 'duration' END) AS outlier_reason FROM z")
def od_outliers(spark, sf):
    return paths.od_outliers(all_cut(spark, sf)[1], 1.5, 2).select("trip_id", "od_bin", "is_distance_outlier", "is_duration_outlier", "outlier_reason")


MPATH = f"""mp AS (SELECT trip_id, any_value(user_id) AS user_id, sum(step) AS length_m, string_agg(CASE WHEN seq % 5 = 0 THEN {pair('snapped_lat', 'snapped_lon', 2, ':')} END, ';' ORDER BY seq) AS code FROM (SELECT *, {hav('lag(snapped_lat) OVER w', 'lag(snapped_lon) OVER w', 'snapped_lat', 'snapped_lon')} AS step FROM x WINDOW w AS (PARTITION BY trip_id ORDER BY seq)) GROUP BY trip_id)"""


@query(f"WITH {DAY}, {MATCHED}, {MPATH} SELECT code AS path_id, count(*) AS support_total, count(DISTINCT user_id) AS support_users, round(avg(coalesce(length_m, 0)) / 1000, 6) AS avg_length_km FROM mp GROUP BY code HAVING count(*) >= 2")
def frequent_matched_paths(spark, sf):
    return paths.frequent_matched_paths(events.matched(all_cut(spark, sf)[0]), 2, 1e-2, 5).select("path_id", "support_total", "support_users", rnd("avg_length_km", 6))


BASE = f"""f AS (SELECT code AS path_id FROM mp GROUP BY code HAVING count(*) >= 2), fv AS (SELECT path_id, unnest(string_split(path_id, ';')) AS v FROM f WHERE len(string_split(path_id, ';')) >= 2),
vv AS (SELECT path_id, CAST(split_part(v, ':', 1) AS DOUBLE) AS va, CAST(split_part(v, ':', 2) AS DOUBLE) AS vo FROM fv),
dv AS (SELECT user_id, trip_id, seq, snapped_time, snapped_lat, snapped_lon, path_id, min({hav('snapped_lat', 'snapped_lon', 'va', 'vo')}) AS dev FROM x, vv GROUP BY ALL)"""


def _baseline(m: DataFrame) -> DataFrame:
    return paths.frequent_matched_paths(m, 2, 1e-2, 5)


@query(f"""WITH {DAY}, {MATCHED}, {MPATH}, {BASE}, md AS (SELECT trip_id, path_id, median(dev) AS md FROM dv GROUP BY trip_id, path_id), bp AS (SELECT trip_id, path_id FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY md, path_id) AS r FROM md) WHERE r = 1),
ow AS (SELECT dv.*, dev > 200 AS over_, coalesce({hav('lag(snapped_lat) OVER w', 'lag(snapped_lon) OVER w', 'snapped_lat', 'snapped_lon')}, 0) AS step, row_number() OVER w AS rn FROM dv JOIN bp USING (trip_id, path_id) WINDOW w AS (PARTITION BY trip_id ORDER BY snapped_time, seq)),
il AS (SELECT *, rn - row_number() OVER (PARTITION BY trip_id, over_ ORDER BY snapped_time, seq) AS island FROM ow)
SELECT user_id, trip_id, epoch_us(min(snapped_time)) AS start_time, epoch_us(max(snapped_time)) AS end_time, round(max(dev), 3) AS max_deviation_m, round(sum(step), 3) AS span_m FROM il WHERE over_ GROUP BY user_id, trip_id, island HAVING sum(step) >= 300""")
def matched_detours(spark, sf):
    m = written(events.matched(all_cut(spark, sf)[0]).select("user_id", "trip_id", "seq", "snapped_time", "snapped_lat", "snapped_lon"))
    return paths.matched_detours(m, _baseline(m)).select("user_id", "trip_id", us("start_time"), us("end_time"), rnd("max_deviation_m", 3), rnd("span_m", 3))


@query(f"WITH {DAY}, {MATCHED} SELECT user_id, epoch_us(snapped_time) AS timestamp, round({hav('lat', 'lon', 'snapped_lat', 'snapped_lon')}, 3) AS detour_m FROM x ORDER BY {hav('lat', 'lon', 'snapped_lat', 'snapped_lon')} DESC, user_id, timestamp LIMIT 100")
def farthest_points(spark, sf):
    p = all_cut(spark, sf)[0]
    return paths.farthest_points(p, events.matched(p)).select("user_id", us("timestamp"), rnd("detour_m", 3))


@query(f"WITH {DAY} SELECT user_id, trip_id, count(*) AS n, string_agg({pair('(lat + 0.00001::DOUBLE)', '(lon + 0.00001::DOUBLE)', 4, ':')}, ';' ORDER BY timestamp, lat, lon) AS path FROM k GROUP BY user_id, trip_id HAVING count(*) >= 2")
def drawn_paths(spark, sf):
    code = F.transform("path", lambda p: pair_text(p["lat"] + 0.00001, p["lon"] + 0.00001, 4, ":"))  # away from halves
    return paths.drawn_paths(all_cut(spark, sf)[0]).select("user_id", "trip_id", F.size("path").cast("long").alias("n"), F.array_join(code, ";").alias("path"))


# --- Map matching --------------------------------------------------------------------------------------------------


@query(f"WITH {DAY}, {MATCHED}, h AS (SELECT *, abs(((heading_deg - lag(heading_deg) OVER w + 180) % 360 + 360) % 360 - 180) AS turn, {hav('lag(snapped_lat) OVER w', 'lag(snapped_lon) OVER w', 'snapped_lat', 'snapped_lon')} AS step FROM x WINDOW w AS (PARTITION BY trip_id ORDER BY seq)) SELECT trip_id, round(avg(confidence), 6) AS matched_confidence_mean, max(confidence) AS matched_confidence_max, round(CASE WHEN sum(step) > 0 THEN sum(turn) / (sum(step) / 1000) END, 3) AS curvature FROM h GROUP BY trip_id")
def matched_features(spark, sf):
    m = features.matched_by_trip(events.matched(all_cut(spark, sf)[0]))
    return m.select("trip_id", rnd("matched_confidence_mean", 6), "matched_confidence_max", rnd("curvature_heading_change_per_km", 3, "curvature"))


#: A trace whose times are off by a few seconds.
LATE = MATCHED.replace("timestamp AS snapped_time", "timestamp, timestamp + to_seconds(event_id % 4) AS snapped_time")
PAIRS = f"""pr AS (SELECT *, abs(epoch_us(snapped_time) - epoch_us(timestamp)) / 1e6 AS drift_s, {hav('lat', 'lon', 'snapped_lat', 'snapped_lon')} AS offset_m, {hav('lag(lat) OVER w', 'lag(lon) OVER w', 'lat', 'lon')} AS rs, {hav('lag(snapped_lat) OVER w', 'lag(snapped_lon) OVER w', 'snapped_lat', 'snapped_lon')} AS ss FROM x WINDOW w AS (PARTITION BY trip_id ORDER BY seq)), pb AS (SELECT *, CASE WHEN rs IS NOT NULL THEN CAST(ss <= rs AS INTEGER) END AS better FROM pr)"""


@query(f"WITH {DAY}, {LATE}, {PAIRS} SELECT trip_id, count(*) AS points, round(avg(offset_m), 4) AS mean_offset_m, round(avg(better), 6) AS improved_share, round(median(drift_s), 4) AS median_drift_s, bool_and(NOT matched) AS failed FROM pb GROUP BY trip_id")
def matching_by_trip(spark, sf):
    p = all_cut(spark, sf)[0]
    return validate.matching_by_trip(validate.matching_pairs(p, events.matched(p, 4))).select("trip_id", "points", rnd("mean_offset_m"), rnd("improved_share", 6), rnd("median_drift_s"), "failed")


def _thin(k: int) -> str:
    """CTE d{k}: the mean over trips of what every k-th point gives."""
    steps = f"{hav('lag(lat) OVER w', 'lag(lon) OVER w', 'lat', 'lon')} AS rs, {hav('lag(snapped_lat) OVER w', 'lag(snapped_lon) OVER w', 'snapped_lat', 'snapped_lon')} AS ss"
    return f"d{k} AS (SELECT avg(o) AS o, avg(s) AS s FROM (SELECT trip_id, avg(offset_m) AS o, avg(CASE WHEN rs IS NOT NULL THEN CAST(ss <= rs AS INTEGER) END) AS s FROM (SELECT trip_id, offset_m, {steps} FROM pr WHERE seq % {k} = 0 WINDOW w AS (PARTITION BY trip_id ORDER BY seq)) GROUP BY trip_id HAVING count(*) > 1))"


@query(f"""WITH {DAY}, {LATE}, {PAIRS}, tb AS (SELECT trip_id, bool_and(NOT matched) AS failed FROM pb GROUP BY trip_id), w AS (SELECT avg(offset_m) AS o, avg(better) AS s, median(drift_s) AS t FROM pb), {_thin(2)}, {_thin(3)}
SELECT round(w.o, 4) AS mean_offset_m, round(w.s, 5) AS improved_share, round(w.t, 4) AS median_drift_s, round((SELECT avg(CAST(failed AS INTEGER)) FROM tb), 6) AS failed_share, round(d2.o - w.o, 4) AS delta_2_offset_m, round(d2.s - w.s, 5) AS delta_2_improved, round(d3.o - w.o, 4) AS delta_3_offset_m, round(d3.s - w.s, 5) AS delta_3_improved FROM w, d2, d3""")
def matching_quality(spark, sf):
    p = all_cut(spark, sf)[0]
    m = events.matched(p, 4)
    q = validate.matching_quality(validate.matching_pairs(p, m), m)
    return q.select(rnd("mean_offset_m"), rnd("improved_share", 5), rnd("median_drift_s"), rnd("failed_share", 6), *[rnd(f"delta_{k}_{c}", n) for k in (2, 3) for c, n in (("offset_m", 4), ("improved", 5))])


def roadless(lat, lon, at):
    """A stand-in service that knows no roads: it moves points by a ten-thousandth of a degree, misses some and fails for batches of a multiple of five."""
    if len(lat) % 5 == 0:
        return None
    return [(a + 0.0001, o - 0.0001) if t % 7 else None for a, o, t in zip(lat, lon, at)], len(lat) % 10 / 10


@query(f"""WITH {DAY}, z AS (SELECT trip_id, timestamp, lat, lon, CAST(row_number() OVER w - 1 AS INTEGER) AS seq, count(*) OVER (PARTITION BY trip_id) AS n, CAST(floor(epoch_us(timestamp) / 1e6) AS BIGINT) AS sec FROM k WINDOW w AS (PARTITION BY trip_id ORDER BY timestamp, event_id)),
v AS (SELECT *, n > 1 AND n % 5 <> 0 AND sec % 7 <> 0 AS ok FROM z) SELECT trip_id, seq, epoch_us(timestamp) AS snapped_time, round(CASE WHEN ok THEN lat + CAST(0.0001 AS DOUBLE) ELSE lat END, 7) AS snapped_lat, round(CASE WHEN ok THEN lon - CAST(0.0001 AS DOUBLE) ELSE lon END, 7) AS snapped_lon, ok AS matched, n > 1 AS asked, CASE WHEN ok THEN round(CAST(n % 10 AS DOUBLE) / 10, 6) END AS confidence FROM v""")
def map_matching(spark, sf):
    done = matching.map_match(all_cut(spark, sf)[0], roadless, fail_limit=None)
    return done.select("trip_id", "seq", us("snapped_time"), rnd("snapped_lat", 7), rnd("snapped_lon", 7), "matched", "asked", rnd("confidence", 6))


# --- Stays ---------------------------------------------------------------------------------------------------------

def dbscan_sql(eps: float, least: int) -> str:
    """CTEs after m: cl, the clustered points with their cluster."""
    return f"""r0 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp, event_id) AS rank, median(lat) OVER (PARTITION BY user_id) AS ref FROM m), r AS (SELECT *, 6371000.0::DOUBLE * cos(radians(ref)) * radians(lon) AS x, 6371000.0::DOUBLE * radians(lat) AS y FROM r0),
nb AS (SELECT a.user_id, a.rank AS i, b.rank AS j FROM r a JOIN r b ON a.user_id = b.user_id AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= {eps * eps}), co AS (SELECT user_id, i FROM nb GROUP BY user_id, i HAVING count(*) >= {least}),
ce AS (SELECT nb.user_id, nb.i, nb.j FROM nb JOIN co c1 ON nb.user_id = c1.user_id AND nb.i = c1.i JOIN co c2 ON nb.user_id = c2.user_id AND nb.j = c2.i), re AS (SELECT user_id, i, i AS j FROM co UNION SELECT re.user_id, re.i, ce.j FROM re JOIN ce ON re.user_id = ce.user_id AND re.j = ce.i),
lb AS (SELECT user_id, j AS rank, min(i) AS first FROM re GROUP BY user_id, j), bo AS (SELECT nb.user_id, nb.j AS rank, min(lb.first) AS first FROM nb JOIN lb ON nb.user_id = lb.user_id AND nb.i = lb.rank GROUP BY nb.user_id, nb.j),
cl AS (SELECT r.*, dense_rank() OVER (PARTITION BY r.user_id ORDER BY coalesce(lb.first, bo.first)) - 1 AS cluster FROM r LEFT JOIN lb ON r.user_id = lb.user_id AND r.rank = lb.rank LEFT JOIN bo ON r.user_id = bo.user_id AND r.rank = bo.rank WHERE coalesce(lb.first, bo.first) IS NOT NULL)"""


STAY_ROWS = "user_id, user_id || '-stay-' || cluster AS stay_id, avg(lat) AS la, avg(lon) AS lo, min(timestamp) AS st, max(timestamp) AS en FROM cl GROUP BY user_id, cluster"


@query(f"WITH RECURSIVE {M}, {dbscan_sql(150, 5)} SELECT user_id, user_id || '-stay-' || cluster AS stay_id, round(avg(lat), 9) AS center_lat, round(avg(lon), 9) AS center_lon, epoch_us(min(timestamp)) AS start_time, epoch_us(max(timestamp)) AS end_time, round((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 60e6, 4) AS dwell_minutes, count(*) AS point_count FROM cl GROUP BY user_id, cluster")
def stays_dbscan(spark, sf):
    return stays.detect_stays_dbscan(moved(spark, sf)).select("user_id", "stay_id", rnd("center_lat", 9), rnd("center_lon", 9), us("start_time"), us("end_time"), rnd("dwell_minutes"), "point_count")


@query()
def stays_hdbscan(spark, sf):
    return stays.detect_stays_hdbscan(moved(spark, sf)).select("user_id", "stay_id", rnd("center_lat", 6), rnd("center_lon", 6), "point_count")


def _half_stays(spark, sf):
    """Two stay tables without clustering: each user's days and half days at their mean place."""
    p = moved(spark, sf).withColumn("ts", F.col("timestamp").cast("timestamp"))
    def table(key):
        g = p.groupBy("user_id", key.alias("d")).agg(F.avg("lat").alias("center_lat"), F.avg("lon").alias("center_lon"), F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.count(F.lit(1)).alias("point_count"))
        return g.withColumns({"stay_id": F.concat("user_id", F.lit("-stay-"), F.col("d").cast("string")), "dwell_minutes": (F.unix_micros("end_time") - F.unix_micros("start_time")) / 60e6})
    return table(F.dayofyear("ts")), table(F.dayofyear("ts") * 2 + F.floor(F.hour("ts") / 12))


HALF = """s1 AS (SELECT user_id, dayofyear(timestamp) AS d, avg(lat) AS la, avg(lon) AS lo, min(timestamp) AS st, max(timestamp) AS en FROM m GROUP BY ALL), s2 AS (SELECT user_id, dayofyear(timestamp) * 2 + CAST(floor(hour(timestamp) / 12) AS BIGINT) AS d, avg(lat) AS la, avg(lon) AS lo, min(timestamp) AS st, max(timestamp) AS en FROM m GROUP BY ALL)"""


@query(f"WITH {M}, {HALF} SELECT s1.user_id, s1.user_id || '-stay-' || s1.d AS a_stay, s2.user_id || '-stay-' || s2.d AS b_stay FROM s1 JOIN s2 ON s1.user_id = s2.user_id WHERE {hav('s1.la', 's1.lo', 's2.la', 's2.lo')} <= 500 AND (epoch_us(least(s1.en, s2.en)) - epoch_us(greatest(s1.st, s2.st))) / 60e6 >= 5")
def stay_candidates(spark, sf):
    return stays.stay_candidates(*_half_stays(spark, sf), 500.0, 5.0)


@query(f"WITH {M}, {HALF}, c AS (SELECT s1.user_id, s1.d AS i, min(s2.d) AS j FROM s1 JOIN s2 ON s1.user_id = s2.user_id WHERE {hav('s1.la', 's1.lo', 's2.la', 's2.lo')} <= 500 AND (epoch_us(least(s1.en, s2.en)) - epoch_us(greatest(s1.st, s2.st))) / 60e6 >= 5 GROUP BY s1.user_id, s1.d), h AS (SELECT user_id, count(*) AS matched FROM c GROUP BY user_id) SELECT a.user_id, n_a, n_b, coalesce(matched, 0) AS matched, round(coalesce(matched, 0) / (n_a + n_b - coalesce(matched, 0)), 6) AS overlap FROM (SELECT user_id, count(*) AS n_a FROM s1 GROUP BY user_id) a JOIN (SELECT user_id, count(*) AS n_b FROM s2 GROUP BY user_id) b USING (user_id) LEFT JOIN h USING (user_id)")
def stay_matching(spark, sf):
    return stays.match_stays(*_half_stays(spark, sf), 500.0, 5.0).select("user_id", "n_a", "n_b", "matched", rnd("overlap", 6))


def _spread(s: str) -> str:
    return f"(SELECT user_id, avg({hav('la', 'lo', 'ma', 'mo')}) AS disp, median((epoch_us(en) - epoch_us(st)) / 60e6) AS dwell, count(*) AS n FROM (SELECT *, avg(la) OVER (PARTITION BY user_id) AS ma, avg(lo) OVER (PARTITION BY user_id) AS mo FROM {s}) GROUP BY user_id)"


def _spread_all(s: str) -> str:
    return f"(SELECT avg({hav('la', 'lo', 'ma', 'mo')}) AS disp, median((epoch_us(en) - epoch_us(st)) / 60e6) AS dwell, count(*) AS n FROM (SELECT *, avg(la) OVER () AS ma, avg(lo) OVER () AS mo FROM {s}))"


def _hits(metres: float) -> str:
    """Matched stays of each user: a half day lies in one day only, so each day takes its first half that fits."""
    return f"SELECT user_id, count(*) AS matched FROM (SELECT DISTINCT s1.user_id, s1.d FROM s1 JOIN s2 ON s1.user_id = s2.user_id WHERE {hav('s1.la', 's1.lo', 's2.la', 's2.lo')} <= {metres} AND (epoch_us(least(s1.en, s2.en)) - epoch_us(greatest(s1.st, s2.st))) / 60e6 >= 5) GROUP BY user_id"


@query(f"WITH {M}, {HALF} SELECT user_id, a.n AS first_stays, b.n AS second_stays, b.n - a.n AS delta_stays, round(b.dwell - a.dwell, 4) AS delta_median_dwell_min, round(b.disp - a.disp, 3) AS delta_dispersion_m, round(coalesce(h.matched, 0) / (a.n + b.n - coalesce(h.matched, 0)), 6) AS overlap FROM {_spread('s1')} a FULL JOIN {_spread('s2')} b USING (user_id) LEFT JOIN ({_hits(100)}) h USING (user_id)")
def stay_comparison(spark, sf):
    return stays.compare_by_user(*_half_stays(spark, sf)).select("user_id", "first_stays", "second_stays", "delta_stays", rnd("delta_median_dwell_min"), rnd("delta_dispersion_m", 3), rnd("overlap", 6))


@query(f"""WITH {M}, {HALF}, g AS (SELECT CAST(coalesce(sum(matched), 0) AS BIGINT) AS hits FROM ({_hits(75)})), q1 AS {_spread_all('s1')}, q2 AS {_spread_all('s2')}
SELECT q1.n AS first_stays, round(q1.dwell, 4) AS first_median_dwell_min, round(q1.disp, 3) AS first_dispersion_m, q2.n AS second_stays, round(q2.dwell, 4) AS second_median_dwell_min, round(q2.disp, 3) AS second_dispersion_m, round(hits / (q1.n + q2.n - hits), 6) AS overlap FROM q1, q2, g""")
def stay_comparison_overall(spark, sf):
    both = stays.compare_overall(*_half_stays(spark, sf))
    return both.select("first_stays", rnd("first_median_dwell_min"), rnd("first_dispersion_m", 3), "second_stays", rnd("second_median_dwell_min"), rnd("second_dispersion_m", 3), rnd("overlap", 6))


@query()
def clusterings_by_user(spark, sf):
    """DBSCAN and HDBSCAN stays of the same points, compared for each user."""
    m = moved(spark, sf)
    return stays.compare_by_user(stays.detect_stays_dbscan(m), stays.detect_stays_hdbscan(m)).select("user_id", "first_stays", "second_stays", "delta_stays", rnd("overlap", 6))


@query(f"WITH {M}, {HALF} SELECT count(*) AS stays, round(median((epoch_us(en) - epoch_us(st)) / 60e6), 4) AS median_dwell_min, round(stddev_pop(la), 6) AS lat_std, round(stddev_pop(lo), 6) AS lon_std FROM s1")
def stay_statistics(spark, sf):
    return stays.stay_stats(_half_stays(spark, sf)[0]).select("stays", rnd("median_dwell_min"), rnd("lat_std", 6), rnd("lon_std", 6))


def _dwell(a: int, b: int) -> str:
    return f"greatest(0, least(epoch_us(e), d0 + {b} * 3600000000) - greatest(epoch_us(s), d0 + {a} * 3600000000))"


@query(f"""WITH {M}, {HALF}, z AS (SELECT user_id, user_id || '-stay-' || d AS stay_id, st AS s, en AS e FROM s2), y AS (SELECT *, epoch_us(CAST(day AS TIMESTAMP)) AS d0 FROM (SELECT *, unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE), INTERVAL 1 DAY)) AS day FROM z)),
c AS (SELECT user_id, stay_id, sum({_dwell(0, 6)} + {_dwell(22, 24)}) AS night, sum(CASE WHEN isodow(day) <= 5 THEN {_dwell(10, 17)} ELSE 0 END) AS midday FROM y GROUP BY ALL)
SELECT u.user_id, h.stay_id AS home_stay_id, w.stay_id AS work_stay_id FROM (SELECT DISTINCT user_id FROM c) u LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY night DESC, stay_id) AS r FROM c WHERE night > 0) WHERE r = 1) h USING (user_id)
 LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY midday DESC, stay_id) AS r FROM c WHERE midday > 0) WHERE r = 1) w USING (user_id)""")
def home_work(spark, sf):
    return stays.home_work(_half_stays(spark, sf)[1])


@query(f"WITH {P}, e AS (SELECT *, min(lat) OVER () AS a0, max(lat) OVER () AS a1, min(lon) OVER () AS o0, max(lon) OVER () AS o1 FROM p) SELECT CAST(least(floor((lon - o0) / (o1 - o0) * 50), 49) AS INTEGER) AS ix, CAST(least(floor((lat - a0) / (a1 - a0) * 50), 49) AS INTEGER) AS iy, count(*) AS points, count(DISTINCT user_id) AS users FROM e GROUP BY 1, 2")
def hotspot_grid(spark, sf):
    return stays.hotspot_grid(points(spark, sf))


@query(f"WITH {P}, q AS (SELECT user_id, event_id, 6371000.0::DOUBLE * cos(radians(40.0::DOUBLE)) * radians(lon) AS x, 6371000.0::DOUBLE * radians(lat) AS y FROM p) SELECT a.event_id, count(*) AS neighbours FROM q a JOIN q b ON a.user_id = b.user_id AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 10000 GROUP BY a.event_id")
def neighbours(spark, sf):
    x, y = to_plane(F.col("lat"), F.col("lon"), F.lit(40.0))
    p = points(spark, sf).select("user_id", "event_id", x.alias("x"), y.alias("y"))
    pairs = grid_join(p, p.select("user_id", F.col("event_id").alias("other"), F.col("x").alias("x2"), F.col("y").alias("y2")), 100.0, ["user_id"], ("x", "y"), ("x2", "y2"))
    return pairs.groupBy("event_id").agg(F.count(F.lit(1)).alias("neighbours"))


@query(f"WITH {P} SELECT event_id, round(lat, 9) AS lat, round(lon, 9) AS lon FROM p")
def plane_round_trip(spark, sf):
    ref = F.lit(40.0)
    lat, lon = from_plane(*to_plane(F.col("lat"), F.col("lon"), ref), ref)
    return points(spark, sf).select("event_id", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"))


# --- Profiles ------------------------------------------------------------------------------------------------------

GYR = f"gy AS (SELECT user_id, sqrt(avg(pow({hav('lat', 'lon', 'ma', 'mo')}, 2))) / 1000 AS g FROM (SELECT *, avg(lat) OVER (PARTITION BY user_id) AS ma, avg(lon) OVER (PARTITION BY user_id) AS mo FROM m) GROUP BY user_id), en AS (SELECT user_id, -sum(q * ln(q)) / ln(7) AS e FROM (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS q FROM (SELECT user_id, isodow(timestamp) AS d, count(*) AS n FROM m GROUP BY ALL)) GROUP BY user_id)"


@query(f"WITH {T}, {GYR}, tr AS (SELECT user_id, CAST(count(*) AS INTEGER) AS n, median(distance_m) / 1000 AS md, median(duration_s) / 60 AS mt FROM t GROUP BY user_id), dy AS (SELECT user_id, avg(d) / 1000 AS a FROM (SELECT user_id, CAST(start_time AS DATE) AS day, sum(distance_m) AS d FROM t GROUP BY ALL) GROUP BY user_id) SELECT gy.user_id, coalesce(n, 0) AS total_trips, round(md, 6) AS median_trip_distance_km, round(mt, 4) AS median_trip_duration_min, round(g, 6) AS radius_of_gyration_km, round(e, 6) AS routine_index, round(a, 6) AS average_daily_distance_km FROM gy LEFT JOIN tr USING (user_id) LEFT JOIN en USING (user_id) LEFT JOIN dy USING (user_id)")
def user_features(spark, sf):
    f = profile.user_features(moved(spark, sf), cut(spark, sf)[1])
    return f.select("user_id", "total_trips", rnd("median_trip_distance_km", 6), rnd("median_trip_duration_min", 4), rnd("radius_of_gyration_km", 6), rnd("routine_index", 6), rnd("average_daily_distance_km", 6))


@query(f"WITH {M}, {HALF}, a AS (SELECT user_id, min(user_id || '-stay-' || d) AS home, max(user_id || '-stay-' || d) AS work FROM s1 GROUP BY user_id), z AS (SELECT user_id, user_id || '-stay-' || d AS stay_id, (epoch_us(en) - epoch_us(st)) / 60e6 AS dw FROM s1) SELECT user_id, round(sum(CASE WHEN stay_id = home THEN dw ELSE 0 END) / sum(dw), 6) AS fraction_time_home, round(sum(CASE WHEN stay_id = work THEN dw ELSE 0 END) / sum(dw), 6) AS fraction_time_work FROM z JOIN a USING (user_id) GROUP BY user_id HAVING sum(dw) > 0")
def stay_shares(spark, sf):
    s = _half_stays(spark, sf)[0]
    a = s.groupBy("user_id").agg(F.min("stay_id").alias("home_stay_id"), F.max("stay_id").alias("work_stay_id"))
    return profile.stay_shares(s, a).filter("fraction_time_home IS NOT NULL").select("user_id", rnd("fraction_time_home", 6), rnd("fraction_time_work", 6))


@query()
def user_segments(spark, sf):
    done, _ = profile.segment_users(profile.user_features(moved(spark, sf), cut(spark, sf)[1]))
    return done.select("user_id", "segment")


@query()
def segment_centres(spark, sf):
    _, centres = profile.segment_users(profile.user_features(moved(spark, sf), cut(spark, sf)[1]))
    return centres.select("segment", *[rnd(c, 6) for c in centres.columns[1:]])


# --- Modes ---------------------------------------------------------------------------------------------------------


@query(f"WITH {T} SELECT trip_id, round(avg_speed_kmh, 5) AS avg_speed_kmh, round(distance_m * 0.001, 6) AS distance_km, round(duration_s / 60, 5) AS duration_min, CAST(hour(start_time) AS DOUBLE) AS start_hour, CAST(isodow(start_time) - 1 AS DOUBLE) AS day_of_week, {MODE} AS mode_heuristic FROM t")
def trip_dataset(spark, sf):
    d = modes.trip_dataset(cut(spark, sf)[1])
    return d.select("trip_id", rnd("avg_speed_kmh", 5), rnd("distance_km", 6), rnd("duration_min", 5), "start_hour", "day_of_week", "mode_heuristic")


@query(f"WITH {T} SELECT trip_id, round(avg_speed_kmh, 5) AS avg_speed_kmh, CASE WHEN trip_seq % 3 = 0 THEN 'tram' ELSE 'walk' END AS mode_heuristic FROM t WHERE trip_seq % 5 <> 1 AND trip_seq % 5 <> 2")
def trip_dataset_labelled(spark, sf):
    """Labels given from outside: none for some trips, an empty one for others."""
    t = cut(spark, sf)[1]
    given = t.filter("trip_seq % 5 <> 1").selectExpr("trip_id", "CASE WHEN trip_seq % 5 = 2 THEN '' WHEN trip_seq % 3 = 0 THEN 'tram' ELSE 'walk' END AS mode_heuristic")
    return modes.trip_dataset(t, labels=given).select("trip_id", rnd("avg_speed_kmh", 5), "mode_heuristic")


@query(f"""WITH {DAY}, {MATCHED}, s AS ({DAY_STAYS.format(s='VARCHAR')}), o AS (SELECT trip_id, sum(greatest(0, (epoch_us(least(t.end_time, s.end_time)) - epoch_us(greatest(t.start_time, s.start_time))) / 1e6)) AS dwell FROM t JOIN s ON t.user_id = s.user_id AND s.start_time <= t.end_time AND t.start_time <= s.end_time GROUP BY trip_id),
r AS (SELECT user_id, timestamp, sum(CASE WHEN speed_kmh <= 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY epoch_us(timestamp) RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW) / 5.0 AS d FROM k), sd AS (SELECT trip_id, avg(d) AS mean_stop_density FROM t JOIN r ON t.user_id = r.user_id AND r.timestamp BETWEEN t.start_time AND t.end_time GROUP BY trip_id),
aa AS (SELECT *, lag(speed_kmh) OVER (PARTITION BY user_id ORDER BY timestamp, event_id) AS ls FROM k), ab AS (SELECT trip_id, CASE WHEN ls IS NOT NULL AND speed_kmh IS NOT NULL AND dt_s > 0 THEN greatest(-5, least(5, (speed_kmh - ls) / 3.6 / dt_s)) END AS a FROM aa), ac AS (SELECT trip_id, stddev_pop(a) AS accel_std, quantile_cont(a, 0.75) - quantile_cont(a, 0.25) AS accel_iqr FROM ab GROUP BY trip_id),
h AS (SELECT *, abs(((heading_deg - lag(heading_deg) OVER w + 180) % 360 + 360) % 360 - 180) AS turn, {hav('lag(snapped_lat) OVER w', 'lag(snapped_lon) OVER w', 'snapped_lat', 'snapped_lon')} AS step FROM x WINDOW w AS (PARTITION BY trip_id ORDER BY seq)), mf AS (SELECT trip_id, avg(confidence) AS cm, max(confidence) AS cx, CASE WHEN sum(step) > 0 THEN sum(turn) / (sum(step) / 1000) END AS cv FROM h GROUP BY trip_id)
SELECT t.trip_id, round(CASE WHEN duration_s > 0 THEN coalesce(dwell, 0) / duration_s END, 6) AS dwell_ratio, round(accel_std, 6) AS accel_std, round(accel_iqr, 6) AS accel_iqr, round(mean_stop_density, 6) AS mean_stop_density, round(cm, 6) AS matched_confidence_mean, cx AS matched_confidence_max, round(cv, 3) AS curvature, {MODE} AS mode_heuristic FROM t LEFT JOIN o USING (trip_id) LEFT JOIN sd USING (trip_id) LEFT JOIN ac USING (trip_id) LEFT JOIN mf USING (trip_id)""")
def trip_dataset_extended(spark, sf):
    p, t = all_cut(spark, sf)
    d = modes.trip_dataset(t, p, day_stays(spark, sf), events.matched(p))
    return d.select("trip_id", *[rnd(c, 6) for c in ("dwell_ratio", "accel_std", "accel_iqr", "mean_stop_density", "matched_confidence_mean")], "matched_confidence_max", rnd("curvature_heading_change_per_km", 3, "curvature"), "mode_heuristic")


@query(f"WITH {T} SELECT trip_id, {MODE} AS prediction FROM t")
def rule_prediction(spark, sf):
    return modes.rule_prediction(cut(spark, sf)[1]).select("trip_id", "prediction")


@query(f"WITH {T} SELECT trip_id FROM t WHERE trip_id IN (SELECT trip_id FROM t WHERE trip_seq % 2 = 0)")
def trips_in_both(spark, sf):
    t = cut(spark, sf)[1]
    return report.trips_in_both(t, t.filter("trip_seq % 2 = 0").select("trip_id")).select("trip_id")


@query(f"WITH {T}, r AS (SELECT trip_id, row_number() OVER (ORDER BY start_time, trip_id) AS r, count(*) OVER () AS n FROM t) SELECT trip_id, CASE WHEN r <= n - 2 * floor(n * 0.2) THEN 'train' WHEN r <= n - floor(n * 0.2) THEN 'val' ELSE 'test' END AS split FROM r")
def time_split(spark, sf):
    return modes.split_by_time(modes.trip_dataset(cut(spark, sf)[1])).select("trip_id", "split")


@query(f"WITH {T}, r AS (SELECT trip_id, row_number() OVER (PARTITION BY {MODE} ORDER BY md5(trip_id || '-42'), trip_id) AS r, count(*) OVER (PARTITION BY {MODE}) AS n FROM t) SELECT trip_id, CASE WHEN r <= ceil(n * 0.2) THEN 'test' WHEN r <= 2 * ceil(n * 0.2) THEN 'val' ELSE 'train' END AS split FROM r")
def stratified_split(spark, sf):
    return modes.split_stratified(modes.trip_dataset(cut(spark, sf)[1])).select("trip_id", "split")


def _called(spark, sf):
    """Labels by event kind as truth and by value as prediction, with a confidence, for the metrics."""
    return spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_type AS mode_heuristic", "CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS prediction", "CAST(event_id % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence")


CALLED = "e AS (SELECT event_type AS label, CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS prediction, CAST(event_id % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence FROM events)"


@query(f"WITH {CALLED} SELECT label, prediction, count(*) AS n FROM e GROUP BY ALL")
def confusion(spark, sf):
    return modes.confusion(_called(spark, sf))


CLASS = "s AS (SELECT label, count(*) AS support, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS hits FROM e GROUP BY label), c AS (SELECT prediction AS label, count(*) AS called FROM e GROUP BY prediction), pq AS (SELECT label, support, hits / called AS p, hits / support AS r FROM s JOIN c USING (label)), f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM pq)"


@query(f"WITH {CALLED}, {CLASS} SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM f")
def class_metrics(spark, sf):
    return modes.class_metrics(modes.confusion(_called(spark, sf))).select("label", rnd("precision", 6), rnd("recall", 6), rnd("f1", 6), "support")


@query(f"WITH {CALLED}, {CLASS} SELECT round((SELECT avg(CASE WHEN label = prediction THEN 1 ELSE 0 END) FROM e), 6) AS accuracy, round(avg(f1), 6) AS f1_macro, (SELECT count(*) FROM e) AS n FROM f")
def summary_metrics(spark, sf):
    return modes.summary_metrics(modes.confusion(_called(spark, sf))).select(rnd("accuracy", 6), rnd("f1_macro", 6), "n")


BINS = "b AS (SELECT CAST(floor(confidence * 10) AS INTEGER) AS bin, count(*) AS n, avg(confidence) AS c, avg(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS a FROM e WHERE confidence < 1 GROUP BY 1)"


@query(f"WITH {CALLED}, {BINS} SELECT bin, n, round(c, 6) AS mean_confidence, round(a, 6) AS accuracy FROM b")
def calibration(spark, sf):
    return modes.calibration(_called(spark, sf)).select("bin", "n", rnd("mean_confidence", 6), rnd("accuracy", 6))


@query(f"WITH {CALLED}, {BINS} SELECT round(sum(n * abs(a - c)) / sum(n), 6) AS ece FROM b")
def calibration_error(spark, sf):
    return modes.calibration_error(modes.calibration(_called(spark, sf))).select(rnd("ece", 6))


@query("WITH e AS (SELECT CAST(event_id % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS y_prob, event_type = 'view' AS y_true FROM events) SELECT CAST(least(floor(y_prob * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(y_prob), 6) AS mean_probability, round(avg(CAST(y_true AS INTEGER)), 6) AS positive_share FROM e GROUP BY 1")
def reliability(spark, sf):
    s = spark.read.parquet(f"{sf}/events.parquet").selectExpr("CAST(event_id % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS y_prob", "event_type = 'view' AS y_true")
    return modes.reliability(s).select("bin", "n", rnd("mean_probability", 6), rnd("positive_share", 6))


EVALUATED = """ev AS (SELECT 'accuracy' AS metric, (SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FROM e) AS value UNION ALL SELECT 'f1_macro', avg(f1) FROM f UNION ALL SELECT 'ece', sum(n * abs(a - c)) / sum(n) FROM b UNION ALL SELECT 'n', CAST(count(*) AS DOUBLE) FROM e)"""


@query(f"WITH {CALLED}, {CLASS}, {BINS}, {EVALUATED} SELECT metric, round(value, 6) AS value FROM ev")
def evaluation(spark, sf):
    return modes.evaluation(_called(spark, sf)).select("metric", rnd("value", 6))


RIGHT = CALLED.replace("CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS prediction", "CASE WHEN event_id % 5 = 0 THEN 'click' ELSE event_type END AS prediction")


@query(f"SELECT a.metric, round(a.value, 6) AS value, round(b.value, 6) AS baseline, round(a.value - b.value, 6) AS delta FROM (WITH {CALLED}, {CLASS}, {BINS}, {EVALUATED} SELECT * FROM ev) a JOIN (WITH {RIGHT}, {CLASS}, {BINS}, {EVALUATED} SELECT * FROM ev) b ON a.metric = b.metric")
def evaluation_deltas(spark, sf):
    other = spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_type AS mode_heuristic", "CASE WHEN event_id % 5 = 0 THEN 'click' ELSE event_type END AS prediction", "CAST(event_id % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence")
    return modes.evaluation_deltas(modes.evaluation(_called(spark, sf)), modes.evaluation(other)).select("metric", rnd("value", 6), rnd("baseline", 6), rnd("delta", 6))


def _fitted(spark, sf):
    data = modes.split_by_time(modes.trip_dataset(cut(spark, sf)[1]))
    return (*modes.train_classifier(data.filter("split = 'train'")), data.filter("split = 'test'"))


@query()
def mode_model(spark, sf):
    model, _, test = _fitted(spark, sf)
    return modes.confusion(modes.predict(model, test))


@query()
def mode_importance(spark, sf):
    model, used, _ = _fitted(spark, sf)
    return spark.createDataFrame(list(modes.importance(model, used).items()), "feature string, importance double").select("feature", rnd("importance", 6))


# --- Robustness ----------------------------------------------------------------------------------------------------

LONG = "lm AS (SELECT {k}, unnest(['distance_m', 'duration_s', 'avg_speed_kmh']) AS metric, unnest([distance_m, duration_s, avg_speed_kmh]) AS value FROM t)"


@query(f"WITH {T}, {LONG.format(k='start_time')} SELECT CAST(week(start_time) AS VARCHAR) AS period, metric, count(value) AS n, round(median(value), 4) AS median, round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.75), 4) AS p75 FROM lm GROUP BY 1, 2")
def period_stats(spark, sf):
    week = F.weekofyear(F.col("start_time").cast("timestamp")).cast("string")
    return validate.period_stats(cut(spark, sf)[1], week).select("period", "metric", "n", rnd("median"), rnd("p25"), rnd("p75"))


@query(f"WITH {T} SELECT year(start_time) || 'Q' || quarter(start_time) AS period, count(*) AS trips FROM t GROUP BY 1")
def quarters(spark, sf):
    return cut(spark, sf)[1].groupBy(validate.quarter(F.col("start_time")).alias("period")).agg(F.count(F.lit(1)).alias("trips"))


#: CTEs after r (k, n_a, n_b, d): pv, the exact p-value of each k by shares of lattice paths, anti-diagonal by anti-diagonal.
PATHS = """h AS (SELECT k, n_a AS n, n_b AS m, n_a // gcd(n_a, n_b) AS a, n_b // gcd(n_a, n_b) AS b, CAST(round(d * (n_a // gcd(n_a, n_b)) * n_b) AS BIGINT) AS h FROM r),
st AS (SELECT *, CAST(0 AS BIGINT) AS s, CAST(0 AS BIGINT) AS lo, CAST(0 AS BIGINT) AS hi, [CAST(0 AS DOUBLE)] AS l FROM h WHERE h > 0
 UNION ALL SELECT k, n, m, a, b, h, s + 1, lo2, hi2, list_transform(range(lo2, hi2 + 1), lambda i: (i * CASE WHEN i - 1 BETWEEN lo AND hi THEN l[i - lo] ELSE 1 END + (s + 1 - i) * CASE WHEN i BETWEEN lo AND hi THEN l[i - lo + 1] ELSE 1 END) / (s + 1))
 FROM (SELECT *, greatest(CAST(floor(((s + 1) * a - h) / (a + b)) AS BIGINT) + 1, s + 1 - m, 0) AS lo2, least(CAST(ceil(((s + 1) * a + h) / (a + b)) AS BIGINT) - 1, n, s + 1) AS hi2 FROM st) WHERE s < n + m AND lo2 <= hi2),
pv AS (SELECT h.k, CASE WHEN least(h.n, h.m) >= 2 THEN coalesce(st.l[1], 1) END AS p FROM h LEFT JOIN st ON h.k = st.k AND st.s = h.n + h.m)"""
KS = "u AS (SELECT {k}, metric, value, sum(CASE WHEN side THEN 1 ELSE 0 END) AS a, sum(CASE WHEN side THEN 0 ELSE 1 END) AS b FROM {f} GROUP BY ALL), c AS (SELECT *, sum(a) OVER w AS fa, sum(b) OVER w AS fb, sum(a) OVER v AS na, sum(b) OVER v AS nb FROM u WINDOW w AS (PARTITION BY {k}, metric ORDER BY value), v AS (PARTITION BY {k}, metric))"


@query(f"WITH RECURSIVE {T}, {LONG.format(k='start_time')}, pr AS (SELECT DISTINCT CAST(week(start_time) AS VARCHAR) AS period FROM t), nx AS (SELECT period, lead(period) OVER (ORDER BY period) AS next_period FROM pr), s AS (SELECT nx.*, metric, value, CAST(week(start_time) AS VARCHAR) = nx.period AS side FROM lm JOIN nx ON CAST(week(start_time) AS VARCHAR) IN (nx.period, nx.next_period) WHERE next_period IS NOT NULL), {KS.format(k='period, next_period', f='s')}, q AS (SELECT period, next_period, metric, CAST(any_value(na) AS BIGINT) AS n_a, CAST(any_value(nb) AS BIGINT) AS n_b, max(abs(fa / na - fb / nb)) AS d FROM c GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (ORDER BY period, metric) AS k FROM q), {PATHS} SELECT period, next_period, metric, n_a, n_b, round(d, 6) AS d, round(p, 6) AS p FROM r JOIN pv USING (k)")
def temporal_shift(spark, sf):
    week = F.weekofyear(F.col("start_time").cast("timestamp")).cast("string")
    return validate.temporal_shift(cut(spark, sf)[1], week).select("period", "next_period", "metric", "n_a", "n_b", rnd("d", 6), rnd("p", 6))


@query(f"WITH {T}, {LONG.format(k='user_id')}, s AS (SELECT 1 AS one, metric, value, CAST(user_id AS BIGINT) % 5 = 0 AS side FROM lm), {KS.format(k='one', f='s')} SELECT metric, CAST(any_value(na) AS BIGINT) AS n_a, CAST(any_value(nb) AS BIGINT) AS n_b, round(max(abs(fa / na - fb / nb)), 6) AS d FROM c GROUP BY metric")
def ks_distance(spark, sf):
    long = validate.long_metrics(cut(spark, sf)[1], "user_id").withColumn("side", F.col("user_id").cast("long") % 5 == 0)
    return validate.ks_table(long, ["metric"], "value", "side").select("metric", "n_a", "n_b", rnd("d", 6))


FOLDS = "fo AS (SELECT user_id, CAST((row_number() OVER (ORDER BY md5(user_id || '-42'), user_id) - 1) % 5 AS INTEGER) AS own FROM (SELECT DISTINCT user_id FROM t))"


@query(f"WITH {T}, {FOLDS} SELECT user_id, own AS fold FROM fo")
def user_folds(spark, sf):
    return validate.user_folds(cut(spark, sf)[1])


@query(f"WITH RECURSIVE {T}, {FOLDS}, {LONG.format(k='user_id')}, s AS (SELECT fold, metric, value, own = fold AS side FROM lm JOIN fo USING (user_id), (SELECT unnest(range(5))::INTEGER AS fold)), {KS.format(k='fold', f='s')}, q AS (SELECT fold, metric, CAST(any_value(na) AS BIGINT) AS n_a, CAST(any_value(nb) AS BIGINT) AS n_b, max(abs(fa / na - fb / nb)) AS d FROM c GROUP BY fold, metric), r AS (SELECT *, row_number() OVER (ORDER BY fold, metric) AS k, sqrt(CAST(n_a AS DOUBLE) * n_b / (n_a + n_b)) * d AS root FROM q WHERE n_a > 0 AND n_b > 0), {PATHS} SELECT fold, metric, n_a, n_b, round(d, 6) AS d, round(CASE WHEN root < 0.2 THEN 1 ELSE least(greatest(list_sum(list_transform(range(1, 61), lambda k: 2 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * root * root))), 0), 1) END, 6) AS p_asymptotic, round(p, 6) AS p FROM r JOIN pv USING (k)")
def cross_user(spark, sf):
    return validate.cross_user(cut(spark, sf)[1]).select("fold", "metric", "n_a", "n_b", rnd("d", 6), rnd("p_asymptotic", 6), rnd("p", 6))


def _grid_sql(eps: float, least: int) -> str:
    disp = f"(SELECT avg({hav('la', 'lo', 'ma', 'mo')}) FROM (SELECT *, avg(la) OVER () AS ma, avg(lo) OVER () AS mo FROM sr))"
    each = f"(SELECT median(dp) FROM (SELECT user_id, avg({hav('la', 'lo', 'ma', 'mo')}) AS dp FROM (SELECT *, avg(la) OVER (PARTITION BY user_id) AS ma, avg(lo) OVER (PARTITION BY user_id) AS mo FROM sr) GROUP BY user_id))"
    return f"SELECT * FROM (WITH RECURSIVE {M}, {dbscan_sql(eps, least)}, sr AS (SELECT {STAY_ROWS}) SELECT CAST({eps} AS DOUBLE) AS eps_m, {least} AS min_samples, count(*) AS stays, count(DISTINCT user_id) AS users, round(median((epoch_us(en) - epoch_us(st)) / 60e6), 4) AS median_dwell_min, round({disp}, 3) AS dispersion_m, round({each}, 3) AS median_dispersion_m FROM sr)"


@query("\nUNION ALL\n".join(_grid_sql(e, m) for e in (100, 150) for m in (3, 5)))
def dbscan_grid(spark, sf):
    return validate.dbscan_grid(moved(spark, sf), (100.0, 150.0), (3, 5)).select("eps_m", "min_samples", "stays", "users", rnd("median_dwell_min"), rnd("dispersion_m", 3), rnd("median_dispersion_m", 3))


@query()
def hdbscan_grid(spark, sf):
    g = validate.hdbscan_grid(moved(spark, sf), (5, 8), (None, 5), (0.0, 50.0))
    return g.select("min_cluster_size", "min_samples", "epsilon_m", "stays", "users", rnd("median_dwell_min"), rnd("dispersion_m", 3))


# --- Reports -------------------------------------------------------------------------------------------------------


@query(f"WITH {P} SELECT count(DISTINCT user_id) AS num_users, CAST(0 AS BIGINT) AS num_files, count(*) AS num_points, epoch_us(min(timestamp)) AS start_time, epoch_us(max(timestamp)) AS end_time, round(min(lat), 6) AS min_lat, round(max(lat), 6) AS max_lat, round(min(lon), 6) AS min_lon, round(max(lon), 6) AS max_lon, CAST(floor((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 86400e6) AS BIGINT) AS timespan_days FROM p")
def overview(spark, sf):
    return report.overview(points(spark, sf)).select("num_users", "num_files", "num_points", us("start_time"), us("end_time"), *[rnd(c, 6) for c in ("min_lat", "max_lat", "min_lon", "max_lon")], "timespan_days")


@query(f"WITH {T}, u AS (SELECT user_id, count(*) AS num_points, epoch_us(min(timestamp)) AS first_time, epoch_us(max(timestamp)) AS last_time, count(DISTINCT CAST(timestamp AS DATE)) AS active_days FROM m GROUP BY user_id), v AS (SELECT user_id, count(*) AS num_trips, avg(distance_m) / 1000 AS km, avg(duration_s) / 60 AS mi FROM t GROUP BY user_id) SELECT user_id, num_points, first_time, last_time, active_days, round(num_points / active_days, 6) AS points_per_day, coalesce(num_trips, 0) AS num_trips, round(km, 6) AS avg_trip_km, round(mi, 4) AS avg_trip_min FROM u LEFT JOIN v USING (user_id)")
def user_summary(spark, sf):
    s = report.user_summary(moved(spark, sf), cut(spark, sf)[1])
    return s.select("user_id", "num_points", us("first_time"), us("last_time"), "active_days", rnd("points_per_day", 6), "num_trips", rnd("avg_trip_km", 6), rnd("avg_trip_min"))


@query("SELECT CAST('hour' AS VARCHAR) AS kind, CAST(hour(ts) AS INTEGER) AS bucket, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'weekday', CAST(isodow(ts) - 1 AS INTEGER), count(*) FROM events GROUP BY 2 UNION ALL SELECT 'month', CAST(month(ts) AS INTEGER), count(*) FROM events GROUP BY 2")
def bucket_counts(spark, sf):
    p = points(spark, sf)
    return reduce(DataFrame.union, [report.bucket_counts(p, k).select(F.lit(k).alias("kind"), "bucket", "n") for k in ("hour", "weekday", "month")])


@query("WITH e AS (SELECT value, min(value) OVER () AS lo, max(value) OVER () AS hi FROM events) SELECT CAST(least(floor((value - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n FROM e GROUP BY 1")
def value_histogram(spark, sf):
    return report.histogram(spark.read.parquet(f"{sf}/events.parquet").select("value"), "value")


@query("SELECT event_type, count(value) AS n, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q1, round(median(value), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS max FROM events GROUP BY event_type")
def value_box(spark, sf):
    return report.box(spark.read.parquet(f"{sf}/events.parquet"), "value", "event_type").select("event_type", "n", "min", rnd("q1", 6), rnd("median", 6), rnd("q3", 6), "max")


@query(f"WITH {P}, e AS (SELECT *, min(lat) OVER () AS a0, max(lat) OVER () AS a1, min(lon) OVER () AS o0, max(lon) OVER () AS o1 FROM p) SELECT CAST(least(floor((lon - o0) / (o1 - o0) * 200), 199) AS INTEGER) AS ix, CAST(least(floor((lat - a0) / (a1 - a0) * 200), 199) AS INTEGER) AS iy, count(*) AS n FROM e GROUP BY 1, 2")
def heat_grid(spark, sf):
    return report.heat_grid(points(spark, sf))


def _smooth(source: str, target: str, i: str, c: str) -> str:
    """CTE: one axis' counts convolved with its Gaussian."""
    return f"{target} AS (SELECT {'ix + k AS ix, iy' if i == 'ix' else 'ix, iy + k AS iy'}, sum(v * CASE WHEN bw_{c} > 0 THEN exp(CAST(-0.5 AS DOUBLE) * pow(k * w_{c} / bw_{c}, 2)) ELSE 1 END) AS v FROM {source}, b, (SELECT unnest(range(-200, 201)) AS k) o WHERE abs(k) <= CASE WHEN bw_{c} > 0 THEN ceil(4 * bw_{c} / w_{c}) ELSE 0 END AND {i} + k BETWEEN 0 AND 199 GROUP BY 1, 2)"


@query(f"""WITH {P}, e AS (SELECT min(lat) AS lo_lat, max(lat) AS hi_lat, min(lon) AS lo_lon, max(lon) AS hi_lon, stddev_samp(lat) * pow(count(*), CAST(-1 AS DOUBLE) / 6) AS bw_lat, stddev_samp(lon) * pow(count(*), CAST(-1 AS DOUBLE) / 6) AS bw_lon FROM p),
b AS (SELECT *, lo_lat - 3 * bw_lat AS at_lat, lo_lon - 3 * bw_lon AS at_lon, (hi_lat - lo_lat + 6 * bw_lat) / 200 AS w_lat, (hi_lon - lo_lon + 6 * bw_lon) / 200 AS w_lon FROM e),
g AS (SELECT CAST(floor((lon - at_lon) / w_lon) AS BIGINT) AS ix, CAST(floor((lat - at_lat) / w_lat) AS BIGINT) AS iy, count(*) AS v FROM p, b GROUP BY 1, 2), {_smooth('g', 'gx', 'ix', 'lon')}, {_smooth('gx', 'gy', 'iy', 'lat')},
d AS (SELECT ix, iy, v / (SELECT sum(v) FROM gy) AS density FROM gy), ms AS (SELECT *, sum(density) OVER (ORDER BY density DESC RANGE UNBOUNDED PRECEDING) AS mass FROM d),
th AS (SELECT k, max(density) AS begins FROM ms, (SELECT unnest(range(50)) AS k) o WHERE mass >= 1 - (CAST(0.05 AS DOUBLE) + k * (CAST(0.95 AS DOUBLE) / 49)) GROUP BY k), lv AS (SELECT ix, iy, any_value(density) AS density, count(*) AS level FROM d JOIN th ON begins <= density GROUP BY ix, iy)
SELECT CAST(ix AS INTEGER) AS ix, CAST(iy AS INTEGER) AS iy, round(at_lon + (ix + 0.5) * w_lon, 6) AS lon, round(at_lat + (iy + 0.5) * w_lat, 6) AS lat, round(density, 10) AS density, CAST(level AS INTEGER) AS level FROM lv, b""")
def density_surface(spark, sf):
    return report.density_surface(points(spark, sf)).select("ix", "iy", rnd("lon", 6), rnd("lat", 6), rnd("density", 10), "level")


@query(f"WITH {DAY}, {MATCHED} SELECT user_id, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS day, 'raw' AS kind, count(*) AS n FROM m GROUP BY 1, 2 UNION ALL SELECT user_id, CAST(CAST(snapped_time AS DATE) AS VARCHAR), 'matched', count(*) FROM x WHERE matched GROUP BY 1, 2")
def user_day_counts(spark, sf):
    m = events.matched(all_cut(spark, sf)[0]).filter("matched")
    return report.user_day_counts(raw=moved(spark, sf), matched=m).withColumn("day", F.col("day").cast("string"))


@query(f"WITH {DAY}, {MATCHED} SELECT DISTINCT user_id, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS day FROM m INTERSECT SELECT user_id, CAST(CAST(snapped_time AS DATE) AS VARCHAR) FROM x WHERE matched")
def common_user_days(spark, sf):
    return report.common_user_days(moved(spark, sf), events.matched(all_cut(spark, sf)[0]).filter("matched")).withColumn("day", F.col("day").cast("string"))


@query(f"WITH {P} SELECT user_id, event_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM p WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-11' AND user_id IN ('1', '2', '3')")
def pruned_artifact(spark, sf):
    """All points written by user bucket and day, and some users' days read back: only their folders are."""
    saved = save_artifact(points(spark, sf), scratch_folder(spark, "artifact"), "points", buckets=8)
    got = read_artifact(spark, "points", saved, users=["1", "2", "3"], start="2024-01-05", end="2024-01-10")
    return got.select("user_id", "event_id", rnd("lat", 6), rnd("lon", 6))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, sf):
    return report.value_counts(spark.read.parquet(f"{sf}/events.parquet"), "event_type")


@query(f"WITH {P} SELECT event_id FROM p WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-11' AND user_id IN ('1', '2', '3')")
def users_and_dates(spark, sf):
    p = report.between(points(spark, sf), F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-10").cast("timestamp"), ["1", "2", "3"])
    return p.select("event_id")


@query(f"WITH {T} SELECT least((SELECT min(timestamp) FROM p), (SELECT min(start_time) FROM t)) IS NOT NULL AS found, epoch_us(least((SELECT min(timestamp) FROM p), (SELECT min(start_time) FROM t))) AS first, epoch_us(greatest((SELECT max(timestamp) FROM p), (SELECT max(end_time) FROM t))) AS last")
def time_bounds(spark, sf):
    return report.time_bounds(points(spark, sf), cut(spark, sf)[1]).select(F.col("first").isNotNull().alias("found"), us("first"), us("last"))


@query(f"WITH {T} SELECT user_id FROM p UNION SELECT user_id FROM t")
def all_users(spark, sf):
    return report.all_users(points(spark, sf), cut(spark, sf)[1])


@query(f"WITH {P} SELECT round(avg(greatest(least(lat, 90), -90)), 6) AS lat, round(avg(greatest(least(lon, 180), -180)), 6) AS lon FROM p")
def view_state(spark, sf):
    return report.view_state(points(spark, sf)).select(rnd("lat", 6), rnd("lon", 6))


@query(f"WITH {P} SELECT user_id, epoch_us(timestamp) AS timestamp, round(lat, 6) AS lat, round(lon, 6) AS lon, CAST(NULL AS DOUBLE) AS alt_m, CAST(NULL AS VARCHAR) AS trip_id FROM p")
def conformed(spark, sf):
    raw = points(spark, sf).select(F.col("user_id").alias("UID"), F.col("timestamp").alias("ts"), F.col("lat").cast("string").alias("Latitude"), F.col("lon").alias("lng"))
    return conform(raw, "points").select("user_id", us("timestamp"), rnd("lat", 6), rnd("lon", 6), "alt_m", "trip_id")


@query(f"WITH {P} SELECT event_id FROM p ORDER BY md5(CAST(event_id AS VARCHAR) || '-42') LIMIT 500")
def sampled_points(spark, sf):
    return report.sampled(points(spark, sf), 500, key="event_id").select("event_id")
