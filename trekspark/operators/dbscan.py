"""DBSCAN of each user's points as joins over grid cells, without a row per pair of neighbours.

Cells have a diagonal of eps, so points of one cell are neighbours. A cell with `min_samples` points is core without any
comparison; only points of emptier cells, a few in each, are compared with the points around them. Clusters are components
of cells, not of points: two cells are joined if a core point of one reaches a core point of the other, which boxes around
their points settle in all but a few cases; undecided boxes are quartered until they are settled. So users of many points are worked by many
tasks; those of few points, which are most, are labelled many in a task, by their own distances.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import to_plane
from .graph import components, written
from .lots import SMALL, by_size, labelled_lots, setting
from .ranks import running_sums, split_quantiles

#: Times that undecided boxes are divided by 4 x 4 before their different points are compared.
LEVELS = 4


def projected(points: DataFrame) -> DataFrame:
    """Points with a place each: rank in the user's time order, plane coordinates around the user's median latitude.

    Ranks and medians are taken over ranges of rows, so a user with a third of all points is worked by many tasks.
    """
    df = points.filter("lat IS NOT NULL AND lon IS NOT NULL AND timestamp IS NOT NULL")
    ties = [c for c in ("event_id", "source_file", "lat", "lon") if c in df.columns]
    df = running_sums(df, ["user_id"], list(dict.fromkeys(["timestamp", *ties])), {"rank": F.lit(1)})
    middle = split_quantiles(df, ["user_id"], "lat", (0.5,)).select(F.col("user_id").alias("_user"), F.col("q")[0].alias("_ref"))
    x, y = to_plane(F.col("lat"), F.col("lon"), F.col("_ref"))
    both = df.join(middle, F.col("user_id").eqNullSafe(F.col("_user")))
    return both.withColumns({"x": x, "y": y}).select("user_id", F.col("rank").cast("int").alias("rank"), "timestamp", "lat", "lon", "x", "y")


def _around(df: DataFrame, offsets: list[tuple[int, int]], bx: str, by: str) -> DataFrame:
    """Each row once for each offset, with the cell there as _cx, _cy."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets]))
    return df.withColumn("_o", steps).withColumns({"_cx": F.col(bx) + F.col("_o.i"), "_cy": F.col(by) + F.col("_o.j")}).drop("_o")


def _boxes(core: DataFrame, side: float, level: int) -> DataFrame:
    """user_id, bx, by, and the box x0, x1, y0, y1 around the core points of each cell of that level."""
    cell = lambda c: F.floor(F.col(c) / (side / 4**level)).cast("long")
    ends = [f(c).alias(f"{c}{k}") for c in ("x", "y") for k, f in enumerate((F.min, F.max))]
    return core.groupBy("user_id", cell("x").alias("bx"), cell("y").alias("by")).agg(*ends)


def _reach(a: str, b: str, squared: float) -> tuple[Column, Column]:
    """(whether points of two boxes may be within eps, whether all are)."""
    c = lambda m, v: F.col(f"{m}{v}")
    gap = [F.greatest(F.lit(0.0), c(a, f"{v}0") - c(b, f"{v}1"), c(b, f"{v}0") - c(a, f"{v}1")) for v in "xy"]
    span = [F.greatest(c(a, f"{v}1") - c(b, f"{v}0"), c(b, f"{v}1") - c(a, f"{v}0")) for v in "xy"]
    near, far = (F.pow(u, 2.0) + F.pow(v, 2.0) <= squared for u, v in (gap, span))
    return near, far


def _renamed(df: DataFrame, mark: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c == "user_id" else f"{mark}{c}") for c in df.columns])


def _open(left: DataFrame, links: DataFrame) -> DataFrame:
    """The undecided pairs without those of cells that are both linked to a third one, for only connection matters."""
    pair = ["user_id", "ax", "ay", "bx", "by"]
    ends = lambda p, q: [links.select("user_id", *[F.col(f"{m}{v}").alias(f"{n}{v}") for m, n in zip(way, (p, q)) for v in "xy"]) for way in ("ab", "ba")]
    here, there = (x.union(y) for x, y in (ends("a", "c"), ends("c", "b")))
    third = left.select(*pair).distinct().join(here, ["user_id", "ax", "ay"])
    known = third.join(there, ["user_id", "cx", "cy", "bx", "by"], "left_semi")
    return left.join(known.select(*pair).distinct(), pair, "left_anti")


def _cell_links(core: DataFrame, side: float, eps: float) -> DataFrame:
    """user_id, ax, ay, bx, by: pairs of cells of which a core point of one is within eps of a core point of the other."""
    pair = ["user_id", "ax", "ay", "bx", "by"]
    half = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if (i, j) > (0, 0)]
    cells = written(_boxes(core, side, 0))
    one = _around(_renamed(cells, "a_"), half, "a_bx", "a_by").withColumnsRenamed({"_cx": "b_bx", "_cy": "b_by"})
    near, far = _reach("a_", "b_", eps * eps)
    both = written(one.join(_renamed(cells, "b_"), ["user_id", "b_bx", "b_by"]).withColumns({"near": near, "far": far}).filter("near").selectExpr("user_id", "a_bx AS ax", "a_by AS ay", "b_bx AS bx", "b_by AS by", "a_bx AS abx", "a_by AS aby", "b_bx AS bbx", "b_by AS bby", "far"))
    links = both.filter("far").select(*pair)
    left = both.filter("NOT far").drop("far")
    for level in range(1, LEVELS + 1):
        if left.isEmpty():
            return links
        boxes = _boxes(core, side, level)
        up = lambda c: F.floor(F.col(c) / 4).cast("long")
        small = lambda m: _renamed(boxes, f"{m}_").withColumns({f"{m}bx": up(f"{m}_bx"), f"{m}by": up(f"{m}_by")})
        tried = left.join(small("a"), ["user_id", "abx", "aby"]).join(small("b"), ["user_id", "bbx", "bby"]).withColumns({"near": near, "far": far}).filter("near")
        tried = written(tried.select(*pair, F.col("a_bx").alias("abx"), F.col("a_by").alias("aby"), F.col("b_bx").alias("bbx"), F.col("b_by").alias("bby"), "far"))
        found = tried.filter("far").select(*pair).distinct()
        links = links.union(found)
        left = written(_open(tried.filter("NOT far").drop("far").join(found, pair, "left_anti"), links))
    cell = lambda c: F.floor(F.col(c) / (side / 4**LEVELS)).cast("long")
    places = core.select("user_id", "x", "y").distinct()
    point = lambda m: places.select("user_id", F.col("x").alias(f"{m}x_"), F.col("y").alias(f"{m}y_"), cell("x").alias(f"{m}bx"), cell("y").alias(f"{m}by"))
    exact = left.join(point("a"), ["user_id", "abx", "aby"]).join(point("b"), ["user_id", "bbx", "bby"])
    return links.union(exact.filter(F.pow(F.col("ax_") - F.col("bx_"), 2.0) + F.pow(F.col("ay_") - F.col("by_"), 2.0) <= eps * eps).select(*pair).distinct())


def _side(eps: float) -> float:
    return eps / math.sqrt(2.0) * (1 - 1e-9)


def neighbourhoods(placed: DataFrame, eps: tuple[float, ...], most: int) -> DataFrame:
    """The written rows of projected() with, for the k-th of the eps, cx{k}, cy{k} (the cell), in{k} (points of the cell) and n{k}: points within eps, known where the cell has fewer than `most`.

    One join over cells of the largest eps counts for all of them: points that are in an emptier cell of any eps, a few in each of these, meet
    the points around them once.
    """
    every = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]
    sized = placed
    for k, e in enumerate(eps):
        cell = lambda c, e=e: F.floor(F.col(c) / _side(e)).cast("long")
        sized = sized.withColumns({f"cx{k}": cell("x"), f"cy{k}": cell("y")})
        sized = sized.join(sized.groupBy("user_id", f"cx{k}", f"cy{k}").agg(F.count(F.lit(1)).alias(f"in{k}")), ["user_id", f"cx{k}", f"cy{k}"])
    sized = written(sized)
    far = max(range(len(eps)), key=lambda k: eps[k])
    other = sized.select("user_id", F.col(f"cx{far}").alias("_cx"), F.col(f"cy{far}").alias("_cy"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    squared = F.pow(F.col("x") - F.col("x2"), 2.0) + F.pow(F.col("y") - F.col("y2"), 2.0)
    thin = sized.filter(F.least(*[F.col(f"in{k}") for k in range(len(eps))], F.lit(most)) < most)
    thin = _around(thin.select("user_id", "rank", "x", "y", f"cx{far}", f"cy{far}"), every, f"cx{far}", f"cy{far}")
    counts = [F.sum((squared <= e * e).cast("long")).alias(f"n{k}") for k, e in enumerate(eps)]
    counted = thin.join(other, ["user_id", "_cx", "_cy"]).filter(squared <= eps[far] * eps[far]).groupBy("user_id", "rank").agg(*counts)
    return written(sized.join(counted, ["user_id", "rank"], "left"))


def cluster_grid(placed: DataFrame, eps: tuple[float, ...], samples: tuple[int, ...], most: int = SMALL) -> list[DataFrame]:
    """For each eps and each number of samples the written rows of projected() with cluster.

    Users of at most `most` points are bounded blocks: they are shuffled once, for all settings, and labelled many in a task; larger ones go by cells.
    """
    small, large = by_size(placed, most)
    lots = labelled_lots(small, lambda xy, starts: small_labels(xy, starts, eps, samples))
    out = [setting(lots, k) for k in range(len(eps) * len(samples))]
    if large is not None:
        counted = neighbourhoods(written(large), tuple(eps), max(samples))
        cells = [cluster_counted(counted, k, e, m) for k, e in enumerate(eps) for m in samples]
        out = [a.unionByName(b.withColumn("cluster", F.col("cluster").cast("int"))) for a, b in zip(out, cells)]
    return out


def small_labels(xy: np.ndarray, starts: np.ndarray, eps: tuple[float, ...], samples: tuple[int, ...]) -> np.ndarray:
    """The clusters of the points of users that begin at these places, a column for each eps and number of samples, -1 for noise."""
    out = np.full((len(xy), len(eps) * len(samples)), -1, np.int32)
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        x, y = xy[lo:hi, 0], xy[lo:hi, 1]
        apart = (x[:, None] - x) ** 2 + (y[:, None] - y) ** 2
        for i, e in enumerate(eps):
            near = apart <= e * e
            count = near.sum(axis=1)
            for j, m in enumerate(samples):
                out[lo:hi, i * len(samples) + j] = _flooded(near, count >= m)
    return out


def _flooded(near: np.ndarray, core: np.ndarray) -> np.ndarray:
    """Clusters in order of their first core point; a border point stays with the first that reaches it."""
    out, number = np.full(len(near), -1, np.int32), 0
    for i in np.flatnonzero(core).tolist():
        if out[i] >= 0:
            continue
        inside = np.zeros(len(near), bool)
        front = np.array([i])
        while len(front):
            fresh = near[front].any(axis=0) & ~inside
            inside |= fresh
            front = np.flatnonzero(fresh & core)
        out[inside & (out < 0)] = number
        number += 1
    return out


def cluster_placed(placed: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """The written rows of projected() with cluster; see dbscan_labels()."""
    return cluster_grid(placed, (eps,), (min_samples,))[0]


def cluster_counted(counted: DataFrame, k: int, eps: float, min_samples: int) -> DataFrame:
    """The rows of neighbourhoods() with cluster for its k-th eps and at most its `most` samples."""
    side, every = _side(eps), [(i, j) for i in range(-2, 3) for j in range(-2, 3)]
    within = F.pow(F.col("x") - F.col("x2"), 2.0) + F.pow(F.col("y") - F.col("y2"), 2.0) <= eps * eps
    core = (F.col(f"in{k}") >= min_samples) | (F.coalesce(F.col(f"n{k}"), F.lit(0)) >= min_samples)
    marked = counted.select("user_id", "rank", "timestamp", "lat", "lon", "x", "y", F.col(f"cx{k}").alias("cx"), F.col(f"cy{k}").alias("cy"), core.alias("core"))
    core = marked.filter("core")
    links = _cell_links(core.select("user_id", "x", "y"), side, eps)
    vertex = lambda x, y: F.struct("user_id", F.col(x).alias("x"), F.col(y).alias("y"))
    first = core.groupBy("user_id", "cx", "cy").agg(F.min("rank").alias("first"))
    cells = components(links.select(vertex("ax", "ay").alias("a"), vertex("bx", "by").alias("b")), first.select(vertex("cx", "cy").alias("v")))
    cells = cells.select("v.user_id", F.col("v.x").alias("cx"), F.col("v.y").alias("cy"), "label").join(first, ["user_id", "cx", "cy"])
    starts = cells.groupBy("user_id", "label").agg(F.min("first").alias("first"))  # a row per cluster
    starts = starts.withColumn("cluster", F.row_number().over(Window.partitionBy("user_id").orderBy("first")) - 1)
    cells = written(cells.drop("first").join(starts, ["user_id", "label"]).select("user_id", "cx", "cy", "cluster"))
    edge = _around(marked.filter("NOT core").select("user_id", "rank", "x", "y", "cx", "cy"), every, "cx", "cy")
    reach = core.join(cells, ["user_id", "cx", "cy"]).select("user_id", F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("x").alias("x2"), F.col("y").alias("y2"), "cluster")
    border = edge.join(reach, ["user_id", "_cx", "_cy"]).filter(within).groupBy("user_id", "rank").agg(F.min("cluster").alias("_border"))
    out = marked.join(cells.withColumnRenamed("cluster", "_own"), ["user_id", "cx", "cy"], "left").join(border, ["user_id", "rank"], "left")
    return out.select("user_id", "rank", "timestamp", "lat", "lon", F.when(F.col("core"), F.col("_own")).otherwise(F.col("_border")).alias("cluster"))


def dbscan_labels(points: DataFrame, eps_m: float = 150.0, min_samples: int = 5) -> DataFrame:
    """user_id, rank, timestamp, lat, lon, cluster (dense from 0 per user in order of the first core point; null for noise).

    eps is inclusive and a point counts itself; a border point joins the lowest-numbered cluster that reaches it.
    Rows without a user, place or time take no part.
    """
    return cluster_placed(written(projected(points)), eps_m, min_samples)


def dbscan_plain(xy: np.ndarray, eps: float, min_samples: int) -> np.ndarray:
    """Labels of one user's points in order, -1 for noise: the plain form that the relational one is held against."""
    near = ((xy[:, None] - xy[None]) ** 2).sum(axis=2) <= eps * eps
    core, out, number = near.sum(axis=1) >= min_samples, np.full(len(xy), -1), 0
    for i in range(len(xy)):
        if not core[i] or out[i] >= 0:
            continue
        todo = [i]
        out[i] = number
        while todo:
            for j in np.flatnonzero(near[todo.pop()] & (out < 0)):
                out[j] = number
                if core[j]:
                    todo.append(j)
        number += 1
    return out
