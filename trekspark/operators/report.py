"""Report tables and the data behind plots and dashboard pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import seconds_between
from .graph import written
from .ranks import quantiles


def overview(points: DataFrame) -> DataFrame:
    """One row: users, files, points, first and last time, whole days between, bounds."""
    files = F.count_distinct("source_file") if "source_file" in points.columns else F.lit(0).cast("long")
    row = points.agg(F.count_distinct("user_id").alias("num_users"), files.alias("num_files"), F.count(F.lit(1)).alias("num_points"), F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"), F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"), F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"))
    return row.withColumn("timespan_days", F.floor(seconds_between(F.col("start_time"), F.col("end_time")) / 86_400))


def user_summary(points: DataFrame, trips: DataFrame | None = None) -> DataFrame:
    """Per user: points, first and last time, active days, points per day, and of trips their number, mean km and mean minutes."""
    per = points.groupBy("user_id").agg(F.count(F.lit(1)).alias("num_points"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"), F.count_distinct(F.to_date(F.col("timestamp").cast("timestamp"))).alias("active_days"))
    per = per.withColumn("points_per_day", F.col("num_points") / F.col("active_days"))
    if trips is None:
        return per
    t = trips.groupBy("user_id").agg(F.count(F.lit(1)).alias("num_trips"), (F.avg("distance_m") / 1000.0).alias("avg_trip_km"), (F.avg("duration_s") / 60.0).alias("avg_trip_min"))
    return per.join(t, "user_id", "left").withColumn("num_trips", F.coalesce("num_trips", F.lit(0)))


def bucket_counts(points: DataFrame, by: str) -> DataFrame:
    """bucket, n of points by hour, weekday (Monday 0) or month."""
    f = {"hour": F.hour, "weekday": F.weekday, "month": F.month}[by]
    return points.groupBy(f(F.col("timestamp").cast("timestamp")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """bin, n over equal bins from the least to the greatest value, which is in the last bin."""
    ends = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    number = F.when(width > 0, F.least(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    return df.filter(F.col(value).isNotNull()).join(F.broadcast(ends)).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def box(df: DataFrame, value: str, *keys: str, accuracy: int | None = None) -> DataFrame:
    """keys, n, min, q1, median, q3, max."""
    q = quantiles(value, (0.25, 0.5, 0.75), accuracy)
    out = df.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("min"), q.alias("q"), F.max(value).alias("max"))
    return out.select(*keys, "n", "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "max")


def heat_grid(points: DataFrame, cells: int = 200) -> DataFrame:
    """ix, iy, n: points over a grid between the bounds."""
    ends = points.agg(F.min("lat").alias("_a0"), F.max("lat").alias("_a1"), F.min("lon").alias("_o0"), F.max("lon").alias("_o1"))
    cell = lambda v, lo, hi: F.when(F.col(hi) > F.col(lo), F.least(F.floor((F.col(v) - F.col(lo)) / (F.col(hi) - F.col(lo)) * cells), F.lit(cells - 1))).otherwise(0).cast("int")
    return points.join(F.broadcast(ends)).groupBy(cell("lon", "_o0", "_o1").alias("ix"), cell("lat", "_a0", "_a1").alias("iy")).agg(F.count(F.lit(1)).alias("n"))


def density_surface(points: DataFrame, cells: int = 200, cut: float = 3.0, reach: float = 4.0, levels: int = 50, threshold: float = 0.05) -> DataFrame:
    """ix, iy, lon, lat (a cell's middle), density (share of the mass a cell holds), level (1 to `levels`) of a smoothed map of the points.

    A cells x cells grid spans the points' bounds and `cut` bandwidths beyond them. Points are counted by cell once; the counts are
    convolved with a Gaussian along one axis and then the other, cut off at `reach` bandwidths. A bandwidth is the axis' sample deviation
    times n^(-1/6); an axis without spread isn't smoothed. Level k begins at the density beyond which 1 - p of the mass lies, p going from
    `threshold` to 1 in equal steps; cells below the first level are left out. All that follows the count is bounded by the grid, whatever the number of points.
    """
    placed = points.filter("lat IS NOT NULL AND lon IS NOT NULL")
    scale = F.pow(F.count(F.lit(1)).cast("double"), F.lit(-1.0 / 6.0))
    ends = placed.agg(*[f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for f, n in ((F.min, "lo"), (F.max, "hi"))], *[(F.coalesce(F.stddev_samp(c), F.lit(0.0)) * scale).alias(f"bw_{c}") for c in ("lat", "lon")])
    for c in ("lat", "lon"):
        ends = ends.withColumn(f"at_{c}", F.col(f"lo_{c}") - cut * F.col(f"bw_{c}"))
        ends = ends.withColumn(f"w_{c}", (F.col(f"hi_{c}") + cut * F.col(f"bw_{c}") - F.col(f"at_{c}")) / cells)
    ends = written(ends)  # one row, read by every step
    cell = lambda c: F.when(F.col(f"w_{c}") > 0, F.least(F.floor((F.col(c) - F.col(f"at_{c}")) / F.col(f"w_{c}")), F.lit(cells - 1))).otherwise(0).cast("int")
    grid = placed.join(F.broadcast(ends)).groupBy(cell("lon").alias("ix"), cell("lat").alias("iy")).agg(F.count(F.lit(1)).cast("double").alias("v"))
    for c, i in (("lon", "ix"), ("lat", "iy")):
        w, bw = F.col(f"w_{c}"), F.col(f"bw_{c}")
        steps = F.when(bw > 0, F.least(F.ceil(reach * bw / w), F.lit(cells))).otherwise(0).cast("int")
        weight = F.when(bw > 0, F.exp(-0.5 * F.pow(F.col("k") * w / bw, F.lit(2.0)))).otherwise(1.0)
        spread = grid.join(F.broadcast(ends)).withColumn("k", F.explode(F.sequence(-steps, steps)))
        spread = spread.withColumn(i, (F.col(i) + F.col("k")).cast("int")).filter((F.col(i) >= 0) & (F.col(i) < cells))
        grid = spread.groupBy("ix", "iy").agg(F.sum(F.col("v") * weight).alias("v"))
    grid = written(grid)
    total = grid.agg(F.sum("v").alias("total"))
    down = Window.orderBy(F.desc("v")).rangeBetween(Window.unboundedPreceding, 0)  # at most cells x cells rows
    dense = written(grid.join(F.broadcast(total)).select("ix", "iy", (F.col("v") / F.col("total")).alias("density"), F.col("v")).withColumn("mass", F.sum("density").over(down)).drop("v"))
    p = F.lit(threshold) + F.col("k") * F.lit((1.0 - threshold) / (levels - 1))
    begins = dense.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).filter(F.col("mass") >= 1.0 - p).groupBy("k").agg(F.max("density").alias("begins"))
    begins = begins.agg(F.collect_list("begins").alias("begins"))  # `levels` numbers
    found = dense.join(F.broadcast(begins)).join(F.broadcast(ends)).withColumn("level", F.size(F.filter("begins", lambda b: b <= F.col("density"))))
    middle = lambda c, i: (F.col(f"at_{c}") + (F.col(i) + 0.5) * F.col(f"w_{c}")).alias(c)
    return found.filter("level > 0").select("ix", "iy", middle("lon", "ix"), middle("lat", "iy"), "density", "level")


def user_day_counts(**tables: DataFrame) -> DataFrame:
    """user_id, day, kind, n of several tables of points."""
    out = None
    for kind, df in tables.items():
        time = next(c for c in ("timestamp", "snapped_time", "start_time") if c in df.columns)
        own = df.groupBy("user_id", F.to_date(F.col(time).cast("timestamp")).alias("day")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
        out = own if out is None else out.unionByName(own)
    return out.select("user_id", "day", "kind", "n")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def between(df: DataFrame, start: Column, end: Column, users: list[str] | None = None, time: str = "timestamp") -> DataFrame:
    """Rows of the users from `start` up to, but not including, the day after `end`."""
    t = F.col(time).cast("timestamp")
    out = df.filter((t >= start) & (t < F.date_add(end.cast("date"), 1).cast("timestamp")))
    return out.filter(F.col("user_id").isin(users)) if users else out


def all_users(*tables: DataFrame) -> DataFrame:
    out = tables[0].select("user_id")
    for t in tables[1:]:
        out = out.union(t.select("user_id"))
    return out.distinct()


def time_bounds(*tables: DataFrame) -> DataFrame:
    """first, last over several tables; of a trip or stay table both its ends count."""
    out = None
    for t in tables:
        ends = [c for c in ("timestamp", "snapped_time", "start_time", "end_time") if c in t.columns]
        own = t.select(F.least(*[F.col(c) for c in ends], F.col(ends[0])).alias("a"), F.greatest(*[F.col(c) for c in ends], F.col(ends[0])).alias("b"))
        out = own if out is None else out.union(own)
    return out.agg(F.min("a").alias("first"), F.max("b").alias("last"))


def common_user_days(a: DataFrame, b: DataFrame) -> DataFrame:
    day = lambda df: df.select("user_id", F.to_date(F.col(next(c for c in ("timestamp", "snapped_time") if c in df.columns)).cast("timestamp")).alias("day"))
    return day(a).intersect(day(b))


def view_state(points: DataFrame) -> DataFrame:
    """Mean centre of coordinates held to their ranges."""
    clip = lambda c, m: F.greatest(F.least(F.col(c), F.lit(m)), F.lit(-m))
    return points.agg(F.avg(clip("lat", 90.0)).alias("lat"), F.avg(clip("lon", 180.0)).alias("lon"))


def sampled(df: DataFrame, most: int = 50_000, seed: int = 42, key: str | None = None) -> DataFrame:
    """A random sample of at most so many rows, for drawing: the first in the order of a hash of the row, or of `key`, with the seed. Equal rows stand together."""
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in ([key] if key else df.columns)])
    return df.orderBy(F.md5(F.concat(text, F.lit(f"-{seed}")))).limit(most)


def sample_users(points: DataFrame, n: int = 3) -> DataFrame:
    """Points of the first n users in row order, for drawing."""
    first = points.withColumn("_row", F.monotonically_increasing_id()).groupBy("user_id").agg(F.min("_row").alias("_row")).orderBy("_row").limit(n)
    return points.join(F.broadcast(first.select("user_id")), "user_id", "left_semi")


def trips_in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a whose trip_id is in b too."""
    return a.join(b.select("trip_id").distinct(), "trip_id", "left_semi")
