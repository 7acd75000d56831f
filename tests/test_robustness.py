"""Exact p-values, density, partitioned artifacts, streamed trips, the failure limit, matching in rounds."""

import itertools
import math
import os
import random
from datetime import datetime, timedelta
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from trekspark.operators import matching, ranks, report, stays, trips, validate
from trekspark.sources import readers, sinks

T0 = datetime(2024, 3, 1)


def share_of_orders(d: Fraction, n: int, m: int) -> float:
    every = hits = 0
    for firsts in map(set, itertools.combinations(range(n + m), n)):
        i = j = 0
        far = Fraction(0)
        for k in range(n + m):
            i, j = (i + 1, j) if k in firsts else (i, j + 1)
            far = max(far, abs(Fraction(i, n) - Fraction(j, m)))
        every, hits = every + 1, hits + (far >= d)
    return hits / every


@pytest.mark.parametrize("n,m", [(1, 1), (2, 3), (4, 4), (3, 6), (5, 6), (4, 7)])
def test_exact_p_is_the_share_of_all_orders(n, m):
    step = math.lcm(n, m)
    for k in range(step + 1):
        assert validate.path_p(k / step, n, m) == pytest.approx(share_of_orders(Fraction(k, step), n, m), abs=1e-12)


def test_exact_p_of_large_samples_is_near_the_limit_and_monotone(spark):
    assert validate.path_p(0.02, 10_000, 9_999) == pytest.approx(validate.ks_p_value(0.02, 10_000, 9_999), abs=2e-3)
    assert [validate.path_p(d, 60, 80) for d in (0.0, 1.0)][0] == 1.0
    found = [validate.path_p(d, 300, 200) for d in (0.02, 0.05, 0.1, 0.2, 0.4)]
    assert found == sorted(found, reverse=True) and 0 < found[-1] < 1e-15  # small shares aren't lost beside 1
    rows = spark.createDataFrame([(0.5, 4, 4), (0.02, 20_000, 20_000), (1.0, 1, 5)], "d double, n_a long, n_b long")
    exact, few, limit = (r.p for r in validate.with_p(rows).orderBy("n_b").collect())
    assert exact == pytest.approx(share_of_orders(Fraction(1, 2), 4, 4)) and limit == pytest.approx(validate.ks_p_value(0.02, 20_000, 20_000)) and few is None


def test_density_is_the_plain_convolution(spark):
    rng = np.random.default_rng(5)
    at = np.column_stack([rng.normal(40, 0.1, 300), rng.normal(116, 0.3, 300)])
    df = spark.createDataFrame([*map(tuple, at.tolist()), (None, 1.0)], "lat double, lon double")
    got = {(r.ix, r.iy): (r.density, r.level) for r in report.density_surface(df, cells=30).collect()}
    bw = at.std(axis=0, ddof=1) * 300 ** (-1 / 6)
    low, high = at.min(axis=0) - 3 * bw, at.max(axis=0) + 3 * bw
    width = (high - low) / 30
    grid = np.zeros((30, 30))
    for iy, ix in np.floor((at - low) / width).astype(int):
        grid[ix, iy] += 1
    for axis, c in ((0, 1), (1, 0)):
        r = math.ceil(4 * bw[c] / width[c])
        kernel = np.exp(-0.5 * (np.arange(-r, r + 1) * width[c] / bw[c]) ** 2)
        grid = np.apply_along_axis(lambda v: np.convolve(v, kernel)[r : r + 30], axis, grid)
    grid /= grid.sum()
    down = np.sort(grid.reshape(-1))[::-1]
    begins = down[np.searchsorted(np.cumsum(down), 1 - np.linspace(0.05, 1, 50)).clip(0, 899)]
    want = {(ix, iy): (grid[ix, iy], int((begins <= grid[ix, iy] * (1 + 1e-12)).sum())) for ix in range(30) for iy in range(30)}
    assert set(got) == {k for k, v in want.items() if v[1]}
    assert all(got[k][0] == pytest.approx(want[k][0], rel=1e-9) and abs(got[k][1] - want[k][1]) <= 1 for k in got)
    one = report.density_surface(spark.createDataFrame([(40.0, 116.0)] * 3, "lat double, lon double")).collect()
    assert [(r.ix, r.iy, r.density) for r in one] == [(0, 0, 1.0)]
    assert report.density_surface(df.limit(0)).count() == 0


def test_partitioned_artifacts_are_pruned_by_user_and_day(spark, tmp_path):
    rows = [(f"u{u}", T0 + timedelta(days=d, hours=h), float(u), float(d), d) for u in range(12) for d in range(6) for h in range(3)] + [("u1", None, 1.0, 1.0, 1), (None, T0, 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "user_id string, timestamp timestamp, lat double, lon double, day int")
    path = sinks.save_artifact(df, str(tmp_path), "points", buckets=4)
    assert readers.read_artifact(spark, "points", path).count() == len(rows)
    some = readers.read_artifact(spark, "points", path, users=["u1", "u2"], start="2024-03-02", end="2024-03-03")
    assert {(r.user_id, r.timestamp) for r in some.collect()} == {(u, t) for u, t, *_ in rows if u in ("u1", "u2") and t and datetime(2024, 3, 2) <= t < datetime(2024, 3, 4)}
    assert "day" in some.columns and some.count() == 12  # a column of the table's own called day stays
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "user_bucket_of_4" in plan.split("PartitionFilters")[1].split("]")[0] and "row_day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    files = lambda f: len(f.inputFiles())
    read = [r[0] for r in some.select(F.input_file_name()).distinct().collect()]
    assert 0 < len(read) <= 4 < files(spark.read.parquet(path))
    plain = sinks.save_artifact(df, str(tmp_path / "plain"), "points")
    same = readers.read_artifact(spark, "points", plain, users=["u1", "u2"], start="2024-03-02", end="2024-03-03")
    assert sorted(map(str, same.collect())) == sorted(map(str, some.select(same.columns).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_streamed_trips_are_those_of_the_table(spark, tmp_path, seed):
    from trekspark.streaming.trips import watch_trips

    rng = random.Random(seed)
    rows, number = [], 0
    for u in range(7):
        t, lat = T0 + timedelta(minutes=rng.randrange(60)), 40.0
        for _ in range(60):
            t += timedelta(seconds=rng.choice([0, 20, 60, 300, 1800, 1801, 4000]))
            lat += rng.choice([0.0, 0.0005, 0.002, -0.001, 3.0 if rng.random() < 0.05 else 0.0])
            rows.append((f"u{u}", t, number, lat if rng.random() > 0.02 else None, 116.0))
            number += 1
    schema = "user_id string, timestamp timestamp, event_id long, lat double, lon double"
    want = trips.segment_trips(trips.drop_fast(trips.with_motion(spark.createDataFrame(rows, schema))), 30.0, 100.0)[1].collect()
    rows.sort(key=lambda r: r[1])
    late = timedelta(hours=2)
    at = 0
    for k in range(6):  # files of rows out of order, none of them farther behind than the delay
        upto = len(rows) if k == 5 else bisect_time(rows, at, late * 0.9)
        part = rows[at:upto]
        rng.shuffle(part)
        folder = str(tmp_path / f"in/{k}.parquet")
        if part:
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(folder)
        at = upto
    end = [("far", T0 + timedelta(days=400), -1, 0.0, 0.0)]
    spark.createDataFrame(end, schema).coalesce(1).write.parquet(str(tmp_path / "in/6.parquet"))
    too_late = [("u0", T0 - timedelta(days=9), -2, 0.0, 0.0)]
    times = sorted(os.listdir(tmp_path / "in"))
    for k, name in enumerate(times):
        for file in (tmp_path / "in" / name).iterdir():
            os.utime(file, (1_700_000_000 + k, 1_700_000_000 + k))
    q = watch_trips(spark, str(tmp_path / "in/*.parquet"), schema, str(tmp_path / "out"), str(tmp_path / "cp"), 30.0, 100.0, "2 hours", files=1)
    try:
        q.processAllAvailable()
        spark.createDataFrame(too_late, schema).coalesce(1).write.parquet(str(tmp_path / "in/7.parquet"))
        q.processAllAvailable()
    finally:
        q.stop()
    plain = lambda r: (r.user_id, r.trip_seq, r.trip_id, r.start_time, r.end_time, r.points, round(r.distance_m, 6), r.duration_s, round(r.avg_speed_kmh, 6), r.start_lat, r.start_lon, r.end_lat, r.end_lon)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(want) > 20 and sorted(map(str, map(plain, got))) == sorted(map(str, map(plain, want)))


def bisect_time(rows, at, span):
    return next((i for i in range(at, len(rows)) if rows[i][1] > rows[at][1] + span), len(rows))


@pytest.mark.parametrize("tasks", [1, 3, 4])
def test_a_service_that_dies_is_left_alone(spark, tmp_path, tasks):
    rows = [("u", f"u-{t:03d}", T0 + timedelta(seconds=60 * t + i), 1.0 + i, 2.0, i) for t in range(40) for i in range(2 + t % 2)] + [("v", "v-0", T0, 5.0, 5.0, 0)]
    df = spark.createDataFrame(rows, "user_id string, trip_id string, timestamp timestamp, lat double, lon double, event_id int").repartition(5)
    calls = tmp_path / "calls"
    calls.mkdir()

    def service(lat, lon, at):
        number = (at[0] - int(T0.timestamp())) // 60
        (calls / str(number)).touch()
        return None if number == 4 or number >= 11 else ([(9.0, 9.0)] * len(lat), 0.5)

    got = matching.map_match(df, service, fail_limit=3, tasks=tasks).toPandas().sort_values(["trip_id", "seq"]).reset_index(drop=True)
    assert len(got) == len(rows)
    asked = {int(t[2:]) for t in got[got.asked].trip_id}
    assert asked == set(range(13))  # 4, 11 and 12 fail; whatever the number of tasks, those behind aren't asked
    assert set(got[got.matched].trip_id) == {f"u-{t:03d}" for t in range(11) if t != 4}
    assert len(list(calls.iterdir())) <= 13 + tasks - 1
    assert (got[~got.matched].snapped_lon == got[~got.matched].apply(lambda r: 5.0 if r.user_id == "v" else 2.0, axis=1)).all()


def test_matching_in_rounds_is_the_loop(spark):
    rng = random.Random(9)
    rows = [(f"u{u}", rng.randrange(12), rng.randrange(12)) for u in range(200) for _ in range(rng.randrange(1, 30))]
    want = set()
    for u in {r[0] for r in rows}:
        used_i, used_j = set(), set()
        for _, i, j in sorted(r for r in rows if r[0] == u):
            if i not in used_i and j not in used_j:
                used_i.add(i)
                used_j.add(j)
                want.add((u, i, j))
    got = stays.first_matching(spark.createDataFrame(rows, "user_id string, i int, j int"))
    assert {tuple(r) for r in got.collect()} == want
    assert stays.first_matching(spark.createDataFrame([], "user_id string, i int, j int")).count() == 0


def test_quantiles_of_a_whole_table_and_of_none(spark):
    df = spark.createDataFrame([(float(v),) for v in (3, 1, 2, 8)] + [(None,)], "v double")
    assert ranks.whole_quantiles(df, "v", (0.5, 1.0)).first().q == [2.5, 8.0]
    assert ranks.whole_quantiles(df.limit(0), "v").first().q is None


def test_dispersion_of_a_grid_is_over_all_stays(spark):
    rows = [("a", "a-stay-0", 40.0, 116.0, 5.0), ("a", "a-stay-1", 40.1, 116.0, 7.0), ("b", "b-stay-0", 41.0, 116.0, 20.0)]
    table = spark.createDataFrame(rows, "user_id string, stay_id string, center_lat double, center_lon double, dwell_minutes double")
    out = {r.k: r for r in validate._stay_rows([({"k": 1}, table), ({"k": 2}, table.limit(0))]).collect()}
    middle = np.mean([40.0, 40.1, 41.0])
    want = np.mean([abs(x - middle) for x in (40.0, 40.1, 41.0)]) * math.pi / 180 * 6371000
    assert out[1].dispersion_m == pytest.approx(want) and (out[1].stays, out[1].users, out[1].median_dwell_min) == (3, 2, 7.0)
    assert (out[2].stays, out[2].users, out[2].median_dwell_min, out[2].dispersion_m) == (0, 0, None, None)


def test_a_grid_also_has_the_median_of_the_users_dispersions(spark):
    """The column that a change of the SQL had dropped (F4: dbscan_grid)."""
    rows = [("a", "a-stay-0", 40.0, 116.0, 5.0), ("a", "a-stay-1", 40.1, 116.0, 7.0), ("b", "b-stay-0", 41.0, 116.0, 20.0)]
    table = spark.createDataFrame(rows, "user_id string, stay_id string, center_lat double, center_lon double, dwell_minutes double")
    out = {r.k: r for r in validate._stay_rows([({"k": 1}, table), ({"k": 2}, table.limit(0))]).collect()}
    assert out[1].median_dispersion_m == pytest.approx(0.05 * math.pi / 180 * 6371000 / 2)
    assert out[2].median_dispersion_m is None


def test_hdbscan_leaves_out_only_parts_that_cannot_matter(spark):
    from tests.test_operators import clusters_of, placed_of, whole_tree
    from trekspark.operators import hdbscan

    rng = np.random.default_rng(12)
    centres = rng.uniform(-4000, 4000, (7, 2))
    xy = np.concatenate([centres[rng.integers(0, 7, 330)] + rng.normal(0, 30, (330, 2)), rng.uniform(-5000, 5000, (70, 2)), np.repeat(centres[:1], 20, axis=0)])
    placed = placed_of(spark, {"u": xy})
    trees = hdbscan.core_distances(hdbscan.dealt_blocks(placed, 32), 4).toPandas().sort_values("rank")
    near = np.sort(((xy[:, None] - xy[None]) ** 2).sum(axis=2), axis=1)[:, 4] ** 0.5
    assert np.allclose(trees["core"].to_numpy(), near)
    got = clusters_of(hdbscan.cluster_placed(placed, 6, 4, 0.0, hdbscan.tree_edges(placed, 4, 32)))
    assert got["u"] == hdbscan.labels(len(xy), *whole_tree(xy, 4), 6, 0.0).tolist()
    assert len(set(got["u"])) > 4


def test_most_pairs_of_parts_are_left_out():
    import pyarrow as pa

    from trekspark.operators import hdbscan

    rng = np.random.default_rng(3)
    at = rng.uniform(-20_000, 20_000, (200, 2))  # parts of 20 m width, far from each other
    nodes = {"user_id": ["u"] * 200, "block": pa.array(range(200), pa.int32()), "part": pa.array([0] * 200, pa.int32()), "x0": at[:, 0], "x1": at[:, 0] + 20, "y0": at[:, 1], "y1": at[:, 1] + 20, "core": np.ones(200), "inner": np.full(200, 5.0)}
    nodes["known"] = [[{"x": x + i, "y": y + j, "core": 1.0} for i, j in ((0, 9), (20, 11), (9, 0), (11, 20))] for x, y in at.tolist()]
    cuts = {"user_id": pa.array([], pa.string()), "block": pa.array([], pa.int32()), "part": pa.array([], pa.int32()), "a_part": pa.array([], pa.int32()), "w": pa.array([], pa.float64())}
    pairs = hdbscan.meeting(pa.table(nodes), pa.table(cuts))
    assert 199 <= pairs.num_rows < 400  # of 19,900


def test_steps_of_one_length_but_for_the_last_bits_are_compared_as_sql_does(spark):
    """Places moved alike have steps whose last bits tell which is longer (F3: matching_by_trip)."""
    import duckdb

    from trekspark.operators import validate
    from trekspark.queries import hav

    rows = duckdb.sql(f"""SELECT *, {hav('la', 'lo', 'lb', 'lp')} <= {hav('a', 'o', 'b', 'p')} AS shorter FROM (SELECT *, a + s AS la, o + CAST(0.00002 AS DOUBLE) AS lo, b + s AS lb, p + CAST(0.00002 AS DOUBLE) AS lp FROM (
        SELECT i, 39.9::DOUBLE + CAST(i % 997 AS DOUBLE) / 7000 AS a, 116.4::DOUBLE + CAST(i % 883 AS DOUBLE) / 9000 AS o, 39.9::DOUBLE + CAST(i % 991 AS DOUBLE) / 8000 AS b, 116.4::DOUBLE + CAST(i % 877 AS DOUBLE) / 6000 AS p, CAST(0 AS DOUBLE) AS s FROM range(20000) t(i)))""").fetchall()
    wanted = {str(r[0]): r[-1] for r in rows}
    both = [(str(r[0]), k, *r[1 + 2 * k : 3 + 2 * k], *r[6 + 2 * k : 8 + 2 * k]) for r in rows for k in (0, 1)]
    df = validate._stepped(spark.createDataFrame(both, "trip_id string, seq int, lat double, lon double, snapped_lat double, snapped_lon double"))
    found = {r.trip_id: r.shorter for r in df.filter("place = 1").select("trip_id", "shorter").collect()}
    assert found == wanted
    assert len(set(wanted.values())) == 2


def test_small_batches_are_asked_in_lots(spark):
    """A call of its own for each trip took most of the time (F6: map_matching); batches that Arrow cuts anywhere give the same rows."""
    from datetime import datetime, timedelta

    from trekspark.operators import matching
    from trekspark.queries import roadless

    rows = [(f"u{u}", f"u{u}-{t}", datetime(2024, 1, 1) + timedelta(minutes=i), 40.0 + i / 1000, 116.0 + t / 1000, i) for u in range(5) for t in range(6) for i in range(u + t + 1)]
    df = spark.createDataFrame(rows, "user_id string, trip_id string, timestamp timestamp, lat double, lon double, event_id long")
    order = ["user_id", "trip_id", "seq"]
    wanted = matching.map_match(df, roadless, fail_limit=10**6).orderBy(*order).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        out = matching.map_match(df, roadless, fail_limit=None)
        assert out.orderBy(*order).collect() == wanted
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()


def test_a_stream_measures_by_plain_numbers():
    """Numpy's single numbers cost several times as much for each point (F9: streamed_trips)."""
    from trekspark.streaming.trips import metres

    assert type(metres(40.0, 116.0, 40.1, 116.2)) is float and metres(0.0, 0.0, 0.0, 180.0) == pytest.approx(math.pi * 6371000)
    assert math.isnan(metres(math.inf, 0.0, 0.0, 0.0)) and math.isnan(metres(math.nan, 0.0, 0.0, 0.0))
