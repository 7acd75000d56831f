"""Stays, joins, paths, sources and models on small tables."""

import itertools
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trekspark.operators import dbscan, features, graph, hdbscan, joins, matching, modes, paths, profile, ranks, report, stays, trips, validate
from trekspark.plans.settings import settings
from trekspark.sources import readers, sinks
from trekspark.sources.schema import conform

T0 = datetime(2024, 1, 1)


def test_dbscan_agrees_with_the_plain_form(spark):
    rng = np.random.default_rng(3)
    centres = rng.uniform(0, 0.02, (4, 2))
    rows = []
    for u in "ab":
        for i in range(120):
            lat, lon = centres[rng.integers(4)] + rng.normal(0, 0.0009, 2)
            rows.append((u, T0 + timedelta(minutes=i), float(lat), float(lon), i))
    df = spark.createDataFrame(rows, "user_id string, timestamp timestamp, lat double, lon double, event_id long")
    got = dbscan.dbscan_labels(df, 90.0, 5).toPandas().sort_values(["user_id", "rank"])
    placed = dbscan.projected(df).toPandas().sort_values(["user_id", "rank"])
    for u, own in placed.groupby("user_id"):
        want = dbscan.dbscan_plain(own[["x", "y"]].to_numpy(), 90.0, 5)
        assert got[got.user_id == u]["cluster"].fillna(-1).astype(int).tolist() == want.tolist()


def test_border_point_joins_the_lowest_cluster():
    line = np.array([[x, 0.0] for x in (0, 1, 2, 3, 5, 7, 8, 9, 10)])
    labels = dbscan.dbscan_plain(line, 2.0, 4)
    assert labels.tolist() == [0, 0, 0, 0, 0, 1, 1, 1, 1]


def placed_of(spark, users):
    """Rows of projected() from plane coordinates of each user."""
    rows = [(u, i + 1, T0 + timedelta(seconds=i), 0.0, 0.0, float(x), float(y)) for u, xy in users.items() for i, (x, y) in enumerate(xy)]
    return graph.written(spark.createDataFrame(rows, "user_id string, rank int, timestamp timestamp, lat double, lon double, x double, y double"))


def clusters_of(df):
    own = df.toPandas().sort_values(["user_id", "rank"])
    return {u: g["cluster"].fillna(-1).astype(int).tolist() for u, g in own.groupby("user_id")}


def test_dbscan_in_cells_agrees_with_the_plain_form(spark):
    rng = np.random.default_rng(8)
    users = {}
    for u in range(12):
        spread = rng.choice([0.4, 1.0, 2.0, 4.0])
        users[f"u{u}"] = np.round(np.concatenate([rng.normal(c, spread, (int(rng.integers(1, 40)), 2)) for c in rng.uniform(-9, 9, (3, 2))]), int(rng.integers(0, 4)))
    users["line"] = np.column_stack([np.arange(40) * 1.0, np.zeros(40)])  # neighbours exactly at eps
    users["apart"] = np.concatenate([rng.normal(0, 0.01, (30, 2)), rng.normal(0, 0.01, (30, 2)) + (1.0, 0.0)])  # two dense places near eps
    got = clusters_of(dbscan.cluster_placed(placed_of(spark, users), 1.0, 4))
    for u, xy in users.items():
        assert got[u] == dbscan.dbscan_plain(xy, 1.0, 4).tolist(), u


def test_a_dense_place_makes_no_row_per_pair(spark, monkeypatch):
    most = []
    monkeypatch.setattr(dbscan, "written", lambda df, own=graph.written: (lambda out: most.append(out.count()) or out)(own(df)))
    xy = np.random.default_rng(2).normal(0, 1, (20_000, 2))
    placed = placed_of(spark, {"home": xy})
    assert dbscan.cluster_placed(placed, 3.0, 5).filter("cluster = 0").count() > 19_900
    cells = 17  # a pair of cells has at most 256 pairs of boxes at a time, whatever the points in them
    assert max(most) <= max(20_000, 12 * cells * 256) and sum(most) < 120_000


def plain_hdbscan(xy, least, k, epsilon):
    """HDBSCAN by its definition: components of all pairs at each length, condensed, stable clusters chosen from the leaves up."""
    n = len(xy)
    if n < max(2, least):
        return [-1] * n
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(axis=2))
    core = np.array([np.sort(np.delete(d[i], i))[min(k, n - 1) - 1] for i in range(n)])
    reach = np.maximum(np.maximum(core[:, None], core[None]), d)

    def parts(own, length, inclusive):
        left, out = set(own), []
        while left:
            todo = [left.pop()]
            one = set(todo)
            while todo:
                i = todo.pop()
                near = {j for j in left if (reach[i, j] <= length if inclusive else reach[i, j] < length)}
                left -= near
                one |= near
                todo += near
            out.append(sorted(one))
        return out

    density = lambda x: 1 / x if x > 0 else 1e12

    def grow(own, birth, born):
        """(stability, own points, length at birth, clusters below) of the cluster that begins with these points."""
        total, alive = 0.0, own
        while True:
            length = next((x for x in np.unique(reach[np.ix_(alive, alive)]) if len(parts(alive, x, True)) == 1), 0.0) if len(alive) > 1 else 0.0
            big = [p for p in parts(alive, length, False) if len(p) >= least] if len(alive) > 1 else []
            if len(big) == 1 and len(big[0]) < len(alive):
                total += (len(alive) - len(big[0])) * (density(length) - birth)
                alive = big[0]
                continue
            return [total + len(alive) * (density(length) - birth), own, born, [grow(p, density(length), length) for p in big] if len(big) > 1 else []]

    root = grow(list(range(n)), 0.0, np.inf)

    def choose(c, top):
        below = [x for k in c[3] for x in choose(k, False)]
        value = sum(x[0] for x in below)
        return [c] if not top and (not c[3] or c[0] >= value) else below

    picked = choose(root, True)
    if epsilon > 0:
        up = {}

        def walk(c, above):
            for k in c[3]:
                up[id(k)] = c
                walk(k, c)

        walk(root, None)
        raised = {}
        for c in picked:
            while up[id(c)] is not root and c[2] < epsilon:
                c = up[id(c)]
            raised[id(c)] = c
        inside = lambda c: any(set(c[1]) < set(o[1]) for o in raised.values())
        picked = [c for c in raised.values() if not inside(c)]
    out = [-1] * n
    for number, c in enumerate(sorted(picked, key=lambda c: min(c[1]))):
        for i in c[1]:
            out[i] = number
    return out


def whole_tree(xy, k):
    n = len(xy)
    core = np.sqrt(hdbscan.nearest(xy, xy, min(k, n - 1), True)[:, -1])
    return hdbscan.spanning(xy, core)


def test_hdbscan_agrees_with_its_definition():
    rng = np.random.default_rng(5)
    clusters = 0
    for case in range(200):
        n = int(rng.integers(2, 26))
        xy = rng.normal(0, 1, (n, 2)) + rng.choice([0, 6, 20], (n, 1)) if case % 2 else rng.integers(0, 5, (n, 2)).astype(float)
        least, k, epsilon = int(rng.integers(2, 6)), int(rng.integers(1, 6)), float(rng.choice([0.0, 1.5]))
        got = hdbscan.labels(n, *whole_tree(xy, k), least, epsilon).tolist()
        want = plain_hdbscan(xy, least, k, epsilon)
        assert got == want, (case, n, least, k, epsilon)
        clusters += max(want) + 1
    assert clusters > 150


def test_blocks_and_thinning_change_nothing(spark):
    rng = np.random.default_rng(6)
    users = {f"u{n}": np.concatenate([rng.normal(0, 1, (n, 2)), rng.normal(30, 2, (n, 2)), rng.integers(0, 9, (n, 2))]) for n in (1, 4, 15, 30)}
    placed = placed_of(spark, users)
    whole = clusters_of(hdbscan.cluster_placed(placed, 5, 3))
    for block, most in ((7, 1 << 40), (20, 1)):
        assert clusters_of(hdbscan.cluster_placed(placed, 5, 3, 0.0, hdbscan.tree_edges(placed, 3, block, most))) == whole
    for u, xy in users.items():
        assert whole[u] == plain_hdbscan(xy, 5, 3, 0.0)


def test_hdbscan_of_many_points_on_a_line_and_in_one_place(spark):
    n = 20_000
    users = {"line": np.column_stack([np.cumsum(1.0 / np.arange(1, n + 1)), np.zeros(n)]), "place": np.zeros((n, 2))}
    got = clusters_of(hdbscan.cluster_placed(placed_of(spark, users), 5))
    assert len(got["line"]) == n and len(got["place"]) == n


@pytest.mark.parametrize("most", [0, 45, 2048])
def test_dbscan_grid_of_small_and_large_users(spark, most):
    """Users worked in lots and those worked by cells have the plain form's clusters in every setting (F5: dbscan_grid, F8: clusterings_by_user)."""
    rng = np.random.default_rng(18)
    users = {f"u{u}": np.round(np.concatenate([rng.normal(c, 0.8, (int(rng.integers(1, 30)), 2)) for c in rng.uniform(-5, 5, (3, 2))]), 2) for u in range(8)}
    users["one"] = np.zeros((1, 2))
    found = dbscan.cluster_grid(placed_of(spark, users), (0.5, 1.0), (3, 5), most)
    for rows, (eps, samples) in zip(found, [(e, m) for e in (0.5, 1.0) for m in (3, 5)]):
        got = clusters_of(rows)
        for u, xy in users.items():
            assert got[u] == dbscan.dbscan_plain(xy, eps, samples).tolist(), (u, eps, samples)


def test_small_users_take_one_shuffle_for_all_settings(spark):
    """Each setting of a grid reads the same written labels (F5: dbscan_grid, F7: hdbscan_grid)."""
    placed = placed_of(spark, {u: np.random.default_rng(1).normal(0, 1, (30, 2)) for u in "abc"})
    for found in (dbscan.cluster_grid(placed, (0.5, 1.0), (3, 5)), hdbscan.cluster_grid(placed, [(5, 5, 0.0), (8, 5, 1.0)])):
        plans = [rows._jdf.queryExecution().executedPlan().toString() for rows in found]
        assert not any("Exchange" in p or "FlatMap" in p or "CoGroup" in p for p in plans)
        assert len({tuple(rows.inputFiles()) for rows in found}) == 1


@pytest.mark.parametrize("most", [0, 60, 2048])
def test_hdbscan_grid_of_small_and_large_users(spark, most):
    """Trees made of many users at a time and those of blocks give the same clusters (F7: hdbscan_grid, F11: stays_hdbscan)."""
    rng = np.random.default_rng(16)
    users = {f"u{n}": np.concatenate([rng.normal(0, 1, (n, 2)), rng.normal(30, 2, (n, 2)), rng.integers(0, 9, (n, 2))]) for n in (1, 2, 4, 15, 30)}
    users["one"] = np.zeros((1, 2))
    settings_ = [(5, 3, 0.0), (3, 8, 2.0)]
    for rows, (least, k, epsilon) in zip(hdbscan.cluster_grid(placed_of(spark, users), settings_, most), settings_):
        got = clusters_of(rows)
        for u, xy in users.items():
            assert got[u] == plain_hdbscan(xy, least, k, epsilon), (u, least, k)


def test_components_of_a_long_chain(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n) if i != 20], "a long, b long")
    got = {r.v: r.label for r in graph.components(edges, spark.range(n + 1).toDF("v")).collect()}
    assert got == {v: 0 if v <= 20 else 21 for v in range(n + 1)}


def test_interval_join_gives_each_pair_once(spark):
    day = timedelta(days=1)
    a = spark.createDataFrame([("u", T0, T0 + 5 * day), ("u", T0 + 9 * day, T0 + 9 * day)], "k string, s timestamp, e timestamp")
    b = spark.createDataFrame([("u", T0 + 2 * day, T0 + 4 * day, 1), ("u", T0 + 5 * day, T0 + 9 * day, 2), ("v", T0, T0, 3)], "k string, s2 timestamp, e2 timestamp, id int")
    assert sorted(r.id for r in joins.interval_join(a, b, "k", ("s", "e"), ("s2", "e2")).collect()) == [1, 2, 2]


def test_greedy_matching_takes_the_first_free(spark):
    row = lambda n, h0, h1: ("u", f"u-stay-{n}", 0.0, 0.0, T0 + timedelta(hours=h0), T0 + timedelta(hours=h1))
    schema = "user_id string, stay_id string, center_lat double, center_lon double, start_time timestamp, end_time timestamp"
    a = spark.createDataFrame([row(0, 0, 5), row(1, 0, 5)], schema)
    b = spark.createDataFrame([row(0, 1, 3), row(1, 20, 22)], schema)
    out = stays.match_stays(a, b).first()
    assert (out.n_a, out.n_b, out.matched) == (2, 2, 1) and out.overlap == pytest.approx(1 / 3)


def test_one_trip_bin_has_no_outlier_and_missing_ends_are_named(spark):
    df = spark.createDataFrame([("a-0", 1.0, 1.0, 2.0, 2.0, 10.0, 5.0), ("a-1", None, None, None, None, 1.0, 1.0)], "trip_id string, start_lat double, start_lon double, end_lat double, end_lon double, distance_m double, duration_s double")
    out = {r.trip_id: r for r in paths.od_outliers(df).collect()}
    assert out["a-0"].outlier_reason == "" and out["a-1"].od_bin == "nan_nan->nan_nan"


def test_path_decoding_passes_over_malformed_vertices(spark):
    df = spark.createDataFrame([("1:2;x:3;4;5:6",)], "p string").select(paths.decoded(F.col("p")).alias("v"))
    assert [tuple(v) for v in df.first().v] == [(1.0, 2.0), (5.0, 6.0)]


@pytest.mark.parametrize("reach,together", [(1.0, 2048), (700.0, 3), (1e5, 2), (3e7, 1)])
def test_closest_paths_agree_with_all_pairs_of_points_and_paths(spark, monkeypatch, reach, together):
    monkeypatch.setattr(paths, "TOGETHER", together)  # the group sizes at which lots and blocks part
    monkeypatch.setattr(paths, "CELLS", 9)
    rng = np.random.default_rng(3)
    code = lambda vertices: ";".join(f"{a:.2f}:{b:.2f}" for a, b in vertices)
    baseline = [code(rng.integers(0, 9, (rng.integers(2, 6), 2)) / 100 + (40, 116)) for _ in range(12)]
    baseline += [";".join(reversed(baseline[0].split(";"))), "40.00:116.00"]  # a tie, and a path of one vertex
    rows = [("u", f"u-{t}", i, None, *(x + 0.0 for x in (rng.random(2) / 10 + (40, 116)).tolist())) for t in range(8) for i in range(rng.integers(1, 9))]
    rows.append(("u", "u-0", 99, None, None, None))
    m = spark.createDataFrame(rows, "user_id string, trip_id string, seq int, snapped_time timestamp, snapped_lat double, snapped_lon double")
    b = spark.createDataFrame([(p,) for p in baseline], "path_id string")
    got = {(r.trip_id, r.seq): (r.path_id, round(r.deviation_m, 6)) for r in paths.closest_paths(m, b, reach).collect()}

    def metres(a, o, c, p):
        a, o, c, p = np.radians([a, o, c, p])
        h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((p - o) / 2) ** 2
        return 2 * 6371000 * np.arctan2(np.sqrt(h), np.sqrt(1 - h))

    want = {}
    for trip in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == trip and r[4] is not None]
        each = {p: [min(metres(r[4], r[5], *map(float, v.split(":"))) for v in p.split(";")) for r in own] for p in baseline if ";" in p}
        best = min(each, key=lambda p: (round(float(np.median(each[p])), 7), p))
        want |= {(trip, r[2]): (best, round(d, 6)) for r, d in zip(own, each[best])}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-5 for k in want)
    assert not paths.closest_paths(m, b.filter("path_id = '40.00:116.00'"), reach).count()


def test_paths_of_the_same_vertices_are_compared_once(spark, monkeypatch):
    compared, within = [], paths._best_within
    monkeypatch.setattr(paths, "_best_within", lambda trips, some, reach: compared.append(some.count()) or within(trips, some, reach))
    places = ("40.01:116.01", "40.00:116.00", "40.02:116.02")
    whole = [";".join(p) for k in (3, 4, 5) for p in itertools.product(places, repeat=k) if set(p) == set(places)]
    b = spark.createDataFrame([(p,) for p in [*whole, ";".join(places[:2]), ";".join(places[:1] * 2)]], "path_id string")
    rows = [("u", f"u-{t}", i, None, 40.02 + i / 1e5, 116.02) for t in range(3) for i in range(4)]
    m = spark.createDataFrame(rows, "user_id string, trip_id string, seq int, snapped_time timestamp, snapped_lat double, snapped_lon double")
    got = paths.closest_paths(m, b).collect()
    assert len(whole) > 100 and compared == [3]
    assert len(got) == 12 and {r.path_id for r in got} == {min(whole)}


def test_trips_of_one_length_are_measured_together(monkeypatch):
    calls, distances = [], paths._distances
    monkeypatch.setattr(paths, "_distances", lambda *a: calls.append(len(a[0])) or distances(*a))
    place = lambda a, o: {"lat": 40 + a / 100, "lon": 116 + o / 100}
    pts = [[place(t % 5, k) for k in range(3 if t % 2 else 4)] for t in range(200)]
    v = [[place(a, 0), place(a, 1), place(a, 5)] for a in range(5)]
    got = paths._medians(pa.table({"trip_id": [f"u-{t}" for t in range(200)], "pts": pts}).slice(3), pa.table({"path_id": list("edcba"), "v": v}))
    assert sorted(calls) == [99 * 3, 98 * 4]
    assert got["trip_id"].to_pylist() == [f"u-{t}" for t in range(3, 200)]
    assert got["path_id"].to_pylist() == ["edcba"[t % 5] for t in range(3, 200)]


def test_plt_and_label_files(spark, tmp_path):
    folder = tmp_path / "007" / "Trajectory"
    folder.mkdir(parents=True)
    head = ["Trajectory file", "WGS 84", "Altitude is in Feet", "Reserved 3", "0,2,255,My Track,0,0,2,8421376", "0"]
    body = ["39.906631,116.385564,0,492,40097.5864583333,2009-10-11,14:04:30", "39.9,116.3,0,-777,40097.5864583333,,", "x,116.3,0,1,1,2009-10-11,14:04:30", "39.9,116.3,0,1"]
    (folder / "t.plt").write_text("\r\n".join(head + body))
    (tmp_path / "007" / "labels.txt").write_text("Start Time\tEnd Time\tMode\n2009/10/11 14:00:00\t2009/10/11 15:00:00\tWalk\n2009/10/11 16:00:00,2009/10/11 17:00:00,bus\n")
    points = readers.read_plt(spark, str(tmp_path)).orderBy("date_num", F.desc("date")).collect()
    assert [(p.user_id, p.lat, p.alt_m is None) for p in points] == [("007", 39.906631, False), ("007", 39.9, True)]
    assert abs((points[0].timestamp - points[1].timestamp).total_seconds()) < 1e-4
    assert points[0].alt_m == pytest.approx(492 * 0.3048)
    assert [(r.mode) for r in readers.read_labels(spark, str(tmp_path)).orderBy("start_time").collect()] == ["walk", "bus"]
    assert readers.read_plt(spark, str(tmp_path), ["008"]).count() == 0


def test_conform_fills_casts_and_derives(spark):
    df = spark.createDataFrame([("u", "1.5", float("nan"), "note")], "UID string, Latitude string, lng double, note string")
    row = conform(df, "points", extra=True).first()
    assert (row.user_id, row.lat, row.lon, row.trip_id, row.note) == ("u", 1.5, None, None, "note")
    stay = spark.createDataFrame([("u", T0, T0 + timedelta(minutes=90))], "user string, start timestamp, end timestamp")
    assert conform(stay, "stays").first().dwell_minutes == 90.0


def test_artifacts_round_trip_and_missing_ones_are_empty(spark, tmp_path):
    df = spark.createDataFrame([("a-0", "a", 1.0)], "trip_id string, user_id string, extra double")
    path = sinks.save_artifact(df, str(tmp_path), "trips")
    back = readers.read_artifact(spark, "trips", str(tmp_path / "none"), path)
    assert back.first().trip_id == "a-0" and "extra" in back.columns
    assert readers.read_artifact(spark, "stays", str(tmp_path / "none")).count() == 0
    assert readers.read_config(str(tmp_path / "none.yaml")) == {} and readers.read_report(str(tmp_path / "none.json")) is None


def test_settings_prefer_override_then_config():
    s = settings({"features": {"max_speed_kmh": 150}, "analysis": {"user_ids": "all"}}, gap_min=10.0)
    assert (s.max_speed_kmh, s.gap_min, s.user_ids, s.eps_m) == (150, 10.0, None, 150.0)


def traces(spark, n, parts):
    rows = [("u", f"u-{t}", T0 + timedelta(seconds=60 * t + i), 1.0 + i, 2.0, i) for t in range(n) for i in range(1 + t % 3)]
    return spark.createDataFrame(rows, "user_id string, trip_id string, timestamp timestamp, lat double, lon double, event_id int").repartition(parts)


def test_map_matching_leaves_out_no_point_and_does_not_depend_on_partitions(spark):
    down = [matching.map_match(traces(spark, 9, parts), lambda *_: None, fail_limit=3).toPandas() for parts in (1, 5)]
    for d in down:
        assert len(d) == 18 and not d.matched.any() and d.confidence.isna().all() and set(d[d.asked].trip_id) == {"u-1", "u-2", "u-4"}
    some = lambda lat, lon, at: None if len(lat) == 2 else ([(9.0, 9.0), None, (8.0, 8.0)], 0.5)
    up = [matching.map_match(traces(spark, 9, parts), some, fail_limit=None).toPandas().sort_values(["trip_id", "seq"]).reset_index(drop=True) for parts in (1, 5)]
    assert up[0].equals(up[1]) and len(up[0]) == 18
    own = up[0]
    assert own.matched.sum() == 6 and set(own[own.matched].confidence) == {0.5} and own[~own.matched].confidence.isna().all()
    assert (own[~own.matched].snapped_lon == 2.0).all() and own.asked.sum() == 15
    mixed = matching.map_match(traces(spark, 9, 2), some, fail_limit=2).toPandas()
    assert mixed.matched.sum() == 2 and set(mixed[mixed.asked].trip_id) == {"u-1", "u-2", "u-4"}  # u-1 and u-4 fail; those after them aren't asked


def test_routing_service_over_http(spark):
    import http.server
    import json
    import threading

    class Stub(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            places = self.path.split("/driving/")[1].split("?")[0].split(";")
            points = [{"location": [float(p.split(",")[0]) + 1, float(p.split(",")[1]) + 1]} if i != 1 else None for i, p in enumerate(places)]
            good = len(places) == 3 and "radiuses=10;10;10" in self.path and "timestamps=" in self.path
            body = json.dumps({"code": "Ok" if good else "NoMatch", "tracepoints": points, "matchings": [{"confidence": 0.25}, {"confidence": 0.75}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        client = matching.RoutingService(f"http://127.0.0.1:{server.server_port}")
        got = matching.map_match(traces(spark, 6, 2), client).toPandas()
        own = got[got.matched]
        assert len(got) == 12 and len(own) == 4 and set(own.confidence) == {0.75} and set(own.seq) == {0, 2} and (own.snapped_lon == 3.0).all()
    finally:
        server.shutdown()
    gone = matching.map_match(traces(spark, 6, 2), matching.RoutingService(f"http://127.0.0.1:{server.server_port}", timeout_s=0.2)).toPandas()
    assert len(gone) == 12 and not gone.matched.any()


def test_split_quantiles_are_the_linear_ones(spark):
    rng = np.random.default_rng(1)
    rows = [(k, float(v)) for k in ("a", "b", None) for v in np.round(rng.normal(0, 5, 37 if k else 8), 1)] + [("a", None), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.n, r.q) for r in ranks.split_quantiles(df, ["k"], "v", (0.25, 0.5, 0.9)).collect()}
    assert set(got) == {"a", "b", None}
    for k, (n, q) in got.items():
        own = [v for x, v in rows if x == k and v is not None]
        assert n == len(own) and np.allclose(q, np.quantile(own, (0.25, 0.5, 0.9)))


def test_users_in_spans_have_the_same_features(spark, sf):
    from trekspark.queries import moved

    p = moved(spark, sf)
    rows = lambda df, c: sorted((r.event_id, None if r[c] is None else round(r[c], 9)) for r in df.select("event_id", c).collect())
    for f, c in ((lambda s: features.with_acceleration(p, split_s=s), "accel_mps2"), (lambda s: features.with_stop_density(p, 7200, split_s=s), "stop_density_per_min"), (lambda s: features.with_accel_spread(p, 200_000, split_s=s), "accel_roll_std")):
        assert rows(f(None), c) == rows(f(86_400), c)


def test_segments_are_those_of_the_nearest_centre(spark, sf):
    from trekspark.queries import cut, moved

    f = profile.user_features(moved(spark, sf), cut(spark, sf)[1])
    done, centres = (x.toPandas() for x in profile.segment_users(f, 3))
    used = list(centres.columns[1:])
    x = done[used].astype(float)
    x = x.fillna(x.median())
    scale = x.std(ddof=1).replace(0, 1)
    gap = ((x.to_numpy()[:, None] - centres[used].to_numpy()[None]) / scale.to_numpy()) ** 2
    assert gap.sum(axis=2).argmin(axis=1).tolist() == done.segment.tolist()
    assert np.allclose(x.groupby(done.segment).mean().to_numpy(), centres[used].to_numpy(), rtol=1e-6, atol=1e-9)


def test_segments_read_their_features_once(spark):
    """Every step of the fit would otherwise work out all users' points again, sorts of many branches in one task (F1, F2: user_segments)."""
    import random

    rng = random.Random(5)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(n):
        calls.add(1)
        return n

    rows = [(f"u{i}", rng.randint(1, 9), *[rng.random() for _ in profile.FEATURES[1:]]) for i in range(40)]
    df = spark.createDataFrame(rows, "user_id string, total_trips int, " + ", ".join(f"{c} double" for c in profile.FEATURES[1:]))
    done, centres = profile.segment_users(df.withColumn("total_trips", counted.asNondeterministic()("total_trips")))
    assert done.count() == 40 and centres.count() == 4
    assert calls.value == 40


def test_evaluation_and_importance(spark, sf, tmp_path):
    from trekspark.queries import cut

    data = modes.split_by_time(modes.trip_dataset(cut(spark, sf)[1]))
    model, used = modes.train_classifier(data.filter("split = 'train'"))
    test = data.filter("split = 'test'")
    report = modes.evaluate(model, used, test)
    rows = modes.predict(model, test).collect()
    assert report["accuracy"] == pytest.approx(np.mean([r.prediction == r.mode_heuristic for r in rows])) and report["n"] == len(rows)
    assert set(report["importance"]) == set(used) and report["rule"]["accuracy"] == 1.0
    matrix = model.stages[-1].coefficientMatrix.toArray()
    assert report["importance"][used[0]] == pytest.approx(sum(abs(v) for v in matrix[:, 0]) / len(matrix))
    deltas = modes.compare_reports(report, report | {"accuracy": 0.0})
    assert deltas["delta_accuracy"] == report["accuracy"] and deltas["delta_f1_macro"] == 0
    path = sinks.save_model(model, report, str(tmp_path / "m"))
    assert readers.read_report(path)["accuracy"] == pytest.approx(report["accuracy"]) and (tmp_path / "m" / "mode_model").exists()


def test_reports_as_files(spark, tmp_path):
    df = spark.createDataFrame([("a", T0, 1.5), ("b", None, None)], "user_id string, at timestamp, v double")
    path = sinks.save_csv(df, str(tmp_path / "r.csv"))
    back = {r.user_id: (r.at, r.v) for r in spark.read.option("header", True).csv(path).collect()}
    assert back == {"a": ("2024-01-01 00:00:00", "1.5"), "b": (None, None)}
    (tmp_path / "c.yaml").write_text("features:\n  max_speed_kmh: 90\n")
    taken = readers.read_report(sinks.snapshot_config(str(tmp_path / "c.yaml"), str(tmp_path / "out" / "c.json")))
    assert taken["config"] == {"features": {"max_speed_kmh": 90}} and taken["taken_at"].endswith("+00:00")
    assert {r["summary"] for r in sinks.describe(df).collect()} >= {"count", "mean", "max"}


def test_users_for_drawing(spark):
    df = spark.createDataFrame([("b", 1), ("c", 2), ("a", 3), ("b", 4)], "user_id string, n int").coalesce(1)
    assert readers.first_users(df, 2) == ["a", "b"]
    assert sorted(r.n for r in report.sample_users(df, 2).collect()) == [1, 2, 4]
    assert report.sampled(df, 3).count() == 3 and report.sampled(df, 9).count() == 4


def test_flows_from_files_to_profiles(spark, tmp_path):
    from trekspark.plans import ingest

    folder = tmp_path / "raw" / "001" / "Trajectory"
    folder.mkdir(parents=True)
    lines = ["head"] * 6
    for day in (11, 12, 13):
        for i in range(40):
            lines.append(f"{39.9 + 0.0004 * min(i, 20)},{116.3},0,100,40097,2009-10-{day},{8 + i // 60:02d}:{i % 60:02d}:00")
    (folder / "t.plt").write_text("\n".join(lines))
    s = settings({}, raw_dir=str(tmp_path / "raw"), processed_dir=str(tmp_path / "done"), user_ids=("001", "009"))
    paths_ = ingest.ingest(spark, s)
    points, table = (readers.read_artifact(spark, kind, p) for kind, p in zip(("points", "trips"), paths_))
    assert points.count() == 120 and table.count() == 3
    rated = ingest.point_features(points, s).filter("geohash IS NOT NULL AND stop_density_per_min IS NOT NULL")
    assert rated.count() == 120
    found, users = ingest.profiles(points, table, s)
    assert found.count() >= 1 and users.filter("total_trips = 3").count() == 1


def test_ks_is_symmetric_and_exact(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True), (2.0, False), (3.0, False), (None, True)], "value double, side boolean").withColumn("k", F.lit(1))
    d = validate.ks_table(df, ["k"], "value", "side").first()
    e = validate.ks_table(df.withColumn("side", ~F.col("side")), ["k"], "value", "side").first()
    assert d.d == e.d == 0.5 and (d.n_a, d.n_b) == (2, 2)
    assert validate.ks_p_value(0.0, 10, 10) == 1.0 and validate.ks_p_value(1.0, 50, 50) < 1e-6


def test_calibration_leaves_out_certainty(spark):
    df = spark.createDataFrame([("a", "a", 1.0), ("a", "b", 0.95), ("b", "b", 0.9)], "mode_heuristic string, prediction string, confidence double")
    assert [(r.bin, r.n, r.accuracy) for r in modes.calibration(df).collect()] == [(9, 2, 0.5)]


def test_mode_bounds(spark):
    df = spark.createDataFrame([(6.0,), (6.01,), (20.0,), (40.0,), (40.1,), (None,)], "avg_speed_kmh double")
    assert [r.mode_heuristic for r in modes.label_modes(df).collect()] == ["walk", "bike", "bike", "bus", "car", ""]


def test_stream_gives_the_same_trips_as_the_table(spark, sf, tmp_path):
    from trekspark.queries import points
    from trekspark.streaming.trips import session_trips, watch

    table = points(spark, sf).select("user_id", "timestamp", "lat", "lon")
    table.coalesce(1).write.parquet(str(tmp_path / "in"))
    q = watch(spark, str(tmp_path / "in"), "user_id string, timestamp timestamp, lat double, lon double", str(tmp_path / "out"), str(tmp_path / "cp"), 720.0)
    q.processAllAvailable()
    q.stop()
    closed = spark.read.parquet(str(tmp_path / "out")).collect()
    every = {(r.user_id, r.start_time): (r.end_time, r.points) for r in session_trips(table, 720.0).collect()}
    assert closed and all(every[r.user_id, r.start_time] == (r.end_time, r.points) for r in closed)
