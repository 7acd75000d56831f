"""HDBSCAN of each user's points, worked in bounded blocks and those pairs of them that can matter.

A user's points are dealt into blocks along a curve that keeps near points together. Each block gives its points' nearest
distances; only blocks whose boxes are closer than the farthest of these can add nearer ones, so core distances need neighbouring blocks alone. Each block
then gives the spanning tree of its own points under mutual reachability, cut at its longest edges into parts. A tree edge between two parts is never longer than
the longest step of any other way between them. The parts' boxes bound their edges from below; own trees and a few
points of each part bound the ways from above; so pairs of parts whose lower bound is beyond the upper one are left out, and the others give
the edges of their common tree that cross between them. The union of all these edges holds a spanning tree of all the user's points; it is
thinned in rounds where it's large. The last step takes one user's tree, a row per point: merges, condensed tree, excess of mass. Work grows with a
user's points times the parts near each, over many tasks; memory with the block, and at last with the user's points. What is known of
a user's parts, some rows for each block, meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dbscan import projected
from .graph import written
from .lots import SMALL, by_size, labelled_lots, setting
from .ranks import running_sums

#: Points of a block, edges that one task thins or merges at a time, and parts that a block's tree is cut into at most.
BLOCK, EDGES, PARTS = 2048, 2_000_000, 8


def nearest(xy: np.ndarray, others: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Squared distances of each place to its k nearest of the others (inf where there are fewer), itself left out if they are the same places."""
    out = np.full((len(xy), k), np.inf)
    for lo in range(0, len(xy), 512):
        part = ((xy[lo : lo + 512, None] - others[None]) ** 2).sum(axis=2)
        if own:
            part[np.arange(len(part)), lo + np.arange(len(part))] = np.inf
        m = min(k, part.shape[1])
        out[lo : lo + 512, :m] = np.partition(part, m - 1, axis=1)[:, :m]
    return out


def spanning(xy: np.ndarray, core: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning tree under mutual reachability, max(core of both, distance): ends a, b and lengths. Distances are made a row at a time."""
    n = len(xy)
    rest = np.arange(1, n)
    best, source = np.full(n - 1, np.inf), np.zeros(n - 1, np.int64)
    a, b, w, last = [], [], [], 0
    for _ in range(n - 1):
        reach = np.maximum(np.maximum(np.sqrt(((xy[rest] - xy[last]) ** 2).sum(axis=1)), core[rest]), core[last])
        closer = reach < best
        best[closer], source[closer] = reach[closer], last
        k = int(best.argmin())
        last = int(rest[k])
        a.append(int(source[k]))
        b.append(last)
        w.append(float(best[k]))
        for x in (rest, best, source):
            x[k] = x[-1]
        rest, best, source = rest[:-1], best[:-1], source[:-1]
    return np.array(a, np.int64), np.array(b, np.int64), np.array(w)


class Sets:
    """Disjoint sets of 0 to n - 1 by size, with halved paths."""

    def __init__(self, n: int):
        self.up, self.size = list(range(n)), [1] * n

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> tuple[int, int]:
        """(kept root, root that goes) of two different sets."""
        if self.size[a] < self.size[b]:
            a, b = b, a
        self.up[b] = a
        self.size[a] += self.size[b]
        return a, b


def thinned(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Places of the edges that a minimum spanning forest of them keeps, shortest first."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)].tolist(), ends[len(a) :].tolist()
    sets, kept = Sets(len(names)), []
    for e in np.argsort(w, kind="stable").tolist():
        p, q = sets.find(u[e]), sets.find(v[e])
        if p != q:
            sets.join(p, q)
            kept.append(e)
    return np.array(kept, np.int64)


def merges(n: int, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> tuple[list[list[int]], list[float]]:
    """Nodes above the points 0 to n - 1, from n on, by length: the nodes each one joins, and at which length. Edges of one length merge together, so ties don't depend on their order."""
    order = np.argsort(w, kind="stable")
    a, b, w = a[order].tolist(), b[order].tolist(), w[order].tolist()
    sets, node, parts, at = Sets(n), list(range(n)), [], []
    i = 0
    while i < len(w):
        j, joined = i, {}
        while j < len(w) and w[j] == w[i]:
            p, q = sets.find(a[j]), sets.find(b[j])
            if p != q:
                one, two = joined.pop(p, None) or [node[p]], joined.pop(q, None) or [node[q]]
                keep, _ = sets.join(p, q)
                if len(one) < len(two):
                    one, two = two, one
                one += two
                joined[keep] = one
            j += 1
        for root, below in joined.items():
            node[root] = n + len(parts)
            parts.append(below)
            at.append(w[i])
        i = j
    return parts, at


def labels(n: int, a: np.ndarray, b: np.ndarray, w: np.ndarray, least: int, epsilon: float) -> np.ndarray:
    """Cluster of each point of a spanning tree, -1 for noise, numbered by their first point: the condensed tree's clusters of the greatest excess of mass.

    The whole tree is never a cluster. A length of 0 counts as a density of 1e12.
    """
    out = np.full(n, -1)
    if n < max(2, least):
        return out
    parts, at = merges(n, a, b, w)
    size = [1] * n
    for below in parts:
        size.append(sum(size[k] for k in below))
    density = lambda d: 1.0 / d if d > 0 else 1e12
    # Clusters of the condensed tree in order of birth: node, density and length at birth, stability, the cluster above, those below.
    node, birth, born, stable, above, kids = [len(size) - 1], [0.0], [np.inf], [0.0], [-1], [[]]
    todo = [0]
    while todo:
        c = todo.pop()
        here = node[c]
        while here >= n:
            below, d = parts[here - n], at[here - n]
            big = [k for k in below if size[k] >= least]
            gone = size[here] - (size[big[0]] if len(big) == 1 else 0)
            stable[c] += gone * (density(d) - birth[c])
            if len(big) == 1:
                here = big[0]
                continue
            for k in big:
                kids[c].append(len(node))
                todo.append(len(node))
                for column, value in zip((node, birth, born, stable, above, kids), (k, density(d), d, 0.0, c, [])):
                    column.append(value)
            break
    chosen = [False] * len(node)
    for c in range(len(node) - 1, 0, -1):
        inside = sum(stable[k] for k in kids[c])
        chosen[c] = not kids[c] or stable[c] >= inside
        stable[c] = max(stable[c], inside)
    picked, todo = [], [0]
    while todo:
        c = todo.pop()
        if chosen[c]:
            picked.append(c)
        else:
            todo += kids[c]
    if epsilon > 0:  # clusters born below epsilon give way to their first ancestor that isn't
        raised = set()
        for c in picked:
            while above[c] > 0 and born[c] < epsilon:
                c = above[c]
            raised.add(c)
        picked = []
        for c in raised:
            up = above[c]
            while up > 0 and up not in raised:
                up = above[up]
            if up <= 0:
                picked.append(c)
    members = []
    for c in picked:
        own, todo = [], [node[c]]
        while todo:
            k = todo.pop()
            if k < n:
                own.append(k)
            else:
                todo += parts[k - n]
        members.append(own)
    for number, own in enumerate(sorted(members, key=min)):
        out[own] = number
    return out


LINKS = "user_id string, a int, b int, w double"
OWN = "user_id string, rank int, x double, y double, core double, block int, part int, a int, a_part int, w double, cut boolean"
MEETING = "user_id string, block_i int, part_i int, block_j int, part_j int"


def curve(x: Column, y: Column) -> Column:
    """Place on a curve through half-metre cells, quarter by quarter (the bits of both coordinates in turn), on which near points are mostly near."""
    def spread(v: Column) -> Column:
        v = F.floor((v + 2.1e7) * 2).cast("long")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def dealt_blocks(placed: DataFrame, block: int) -> DataFrame:
    """user_id, rank, x, y, n, blocks, block of users with two points at least; blocks are even runs along the curve."""
    sizes = placed.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    df = placed.select("user_id", "rank", "x", "y").join(sizes, "user_id").filter("n > 1").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    many = df.filter("blocks > 1")
    if many.isEmpty():
        return df.withColumn("block", F.lit(0))
    ranked = running_sums(many.withColumn("_z", curve(F.col("x"), F.col("y"))), ["user_id"], ["_z", "rank"], {"_place": F.lit(1)})
    ranked = ranked.withColumn("block", F.floor((F.col("_place") - 1) * F.col("blocks") / F.col("n")).cast("int")).drop("_z", "_place")
    return written(df.filter("blocks = 1").withColumn("block", F.lit(0)).unionByName(ranked))


def core_distances(dealt: DataFrame, k: int) -> DataFrame:
    """The dealt points with core, the distance to the k-th nearest other point, or to the farthest where there are fewer."""
    def own(table: pa.Table) -> pa.Table:
        xy = np.column_stack([table["x"].to_numpy(), table["y"].to_numpy()])
        return table.append_column("d", pa.array(list(nearest(xy, xy, k, True)), pa.list_(pa.float64())))

    inside = dealt.groupBy("user_id", "block").applyInArrow(own, f"{_ddl(dealt)}, d array<double>")
    if not dealt.filter("blocks > 1").isEmpty():
        inside = written(inside)
        # As of the k-th distance inside, another block that is farther off from all its points has nothing nearer.
        boxes = written(inside.filter("blocks > 1").groupBy("user_id", "block").agg(*[f(c).alias(f"{c}{i}") for c in "xy" for i, f in enumerate((F.min, F.max))], F.max(F.element_at("d", k)).alias("far")))
        left, right = (boxes.select(F.col("user_id"), *[F.col(c).alias(f"{m}_{c}") for c in ("block", "x0", "x1", "y0", "y1", "far")]) for m in "ij")
        gap = [F.greatest(F.lit(0.0), F.col(f"i_{v}0") - F.col(f"j_{v}1"), F.col(f"j_{v}0") - F.col(f"i_{v}1")) for v in "xy"]
        meet = left.join(right, "user_id").filter((F.col("i_block") < F.col("j_block")) & (gap[0] * gap[0] + gap[1] * gap[1] <= F.greatest("i_far", "j_far")))  # a row per pair of one user's blocks
        meet = written(meet.select("user_id", F.col("i_block").alias("i"), F.col("j_block").alias("j")))
        points = inside.select("user_id", "rank", "x", "y", "block")
        both = points.join(meet.withColumn("block", F.col("i")), ["user_id", "block"]).unionByName(points.join(meet.withColumn("block", F.col("j")), ["user_id", "block"]))

        def near(table: pa.Table) -> pa.Table:
            rank, at = table["rank"].to_numpy(), table["block"].to_numpy()
            xy = np.column_stack([table["x"].to_numpy(), table["y"].to_numpy()])
            one = at == table["i"][0].as_py()
            found = np.concatenate([nearest(xy[one], xy[~one], k, False), nearest(xy[~one], xy[one], k, False)])
            return pa.table({"user_id": pa.array([table["user_id"][0].as_py()] * len(rank), pa.string()), "rank": np.concatenate([rank[one], rank[~one]]), "d": pa.array(list(found), pa.list_(pa.float64()))})

        across = both.groupBy("user_id", "i", "j").applyInArrow(near, "user_id string, rank int, d array<double>")
        more = across.groupBy("user_id", "rank").agg(F.flatten(F.collect_list("d")).alias("more"))  # k values for each neighbouring block
        inside = inside.join(more, ["user_id", "rank"], "left").withColumn("d", F.concat("d", F.coalesce("more", F.array().cast("array<double>")))).drop("more")
    return inside.withColumn("core", F.sqrt(F.get(F.array_sort("d"), F.least(F.lit(k), F.col("n") - 1).cast("int") - 1))).drop("d")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def own_tree(table: pa.Table) -> pa.Table:
    """OWN of a block: each point with the point above it in the block's tree, and the part it is in once the longest edges are cut."""
    table = table.sort_by("rank")
    rank, core = table["rank"].to_numpy(), table["core"].to_numpy()
    n = len(rank)
    a, b, w = spanning(np.column_stack([table["x"].to_numpy(), table["y"].to_numpy()]), core) if n > 1 else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    longest = np.sort(w)[-(PARTS - 1) :][0] if len(w) >= PARTS else 0.0
    cut = np.zeros(n, bool)
    cut[b[w > longest]] = True
    part, above, length = np.zeros(n, np.int64), np.full(n, -1), np.full(n, np.nan)
    above[b], length[b] = a, w
    number = 0
    for p, q in zip(a.tolist(), b.tolist()):  # the point above comes first
        if cut[q]:
            number += 1
        part[q] = number if cut[q] else part[p]
    root = above < 0
    return pa.table({"user_id": table["user_id"], "rank": rank, "x": table["x"], "y": table["y"], "core": core, "block": table["block"], "part": part.astype(np.int32), "a": pa.array(rank[above].astype(np.int32), mask=root), "a_part": pa.array(part[above].astype(np.int32), mask=root), "w": pa.array(length, mask=root), "cut": cut})


def meeting(nodes: pa.Table, cuts: pa.Table) -> pa.Table:
    """MEETING of a user: the pairs of parts of which an edge may be in the tree.

    Between two parts no edge is shorter than their boxes' distance or either's least core distance. Any two points of them are joined by steps
    no longer than the longest edge inside parts, or a cut edge or one between two known points of different parts, on the best way over the parts.
    """
    m = nodes.num_rows
    if m < 2:
        return pa.table({c: pa.array([], t) for c, t in zip(("user_id", "block_i", "part_i", "block_j", "part_j"), (pa.string(), *[pa.int32()] * 4))})
    block, part = nodes["block"].to_numpy(), nodes["part"].to_numpy()
    x0, x1, y0, y1, core, inner = (nodes[c].to_numpy() for c in ("x0", "x1", "y0", "y1", "core", "inner"))
    inner = np.nan_to_num(inner, nan=0.0)
    known = np.array([[[p["x"], p["y"], p["core"]] for p in row] for row in nodes["known"].to_pylist()])  # (m, 4, 3)
    place = {key: i for i, key in enumerate(zip(block.tolist(), part.tolist()))}
    joined: dict[tuple[int, int], float] = {}
    for bl, p, q, w in zip(*(cuts[c].to_pylist() for c in ("block", "part", "a_part", "w"))):
        i, j = place[bl, p], place[bl, q]
        joined[i, j] = joined[j, i] = min(w, joined.get((i, j), np.inf))

    def steps(i: int) -> np.ndarray:
        """The longest step of a way straight from part i to each other."""
        best = np.full(m, np.inf)
        for u in range(known.shape[1]):
            for v in range(known.shape[1]):
                d = np.hypot(known[i, u, 0] - known[:, v, 0], known[i, u, 1] - known[:, v, 1])
                best = np.minimum(best, np.maximum(np.maximum(d, known[i, u, 2]), known[:, v, 2]))
        return np.maximum(np.maximum(best, inner), inner[i])

    rows = {i: [(j, w) for (k, j), w in joined.items() if k == i] for i in {k for k, _ in joined}}
    over = np.zeros((m, m), np.float32)  # the longest step of the best way, rounded up
    best, source, done, order = np.full(m, np.inf), np.zeros(m, np.int64), np.zeros(m, bool), []
    last = 0
    for _ in range(m):
        done[last] = True
        if order:
            up = source[last]
            over[last, order] = over[order, last] = np.maximum(over[up, order], np.nextafter(np.float32(best[last]), np.float32(np.inf)))
        order.append(last)
        reach = steps(last)
        for j, w in rows.get(last, ()):
            reach[j] = min(reach[j], max(w, inner[j], inner[last]))
        closer = (reach < best) & ~done
        best[closer], source[closer] = reach[closer], last
        last = int(np.where(done, np.inf, best).argmin())
    pairs = []
    for i in range(m - 1):
        j = np.arange(i + 1, m)
        gap = np.hypot(np.maximum(0, np.maximum(x0[i] - x1[j], x0[j] - x1[i])), np.maximum(0, np.maximum(y0[i] - y1[j], y0[j] - y1[i])))
        least = np.maximum(np.maximum(gap, core[i]), core[j])
        other = j[(least <= over[i, j]) & (block[j] != block[i])]
        pairs.append(np.column_stack([np.full(len(other), i), other]))
    pairs = np.concatenate(pairs)
    i, j = pairs[:, 0], pairs[:, 1]
    return pa.table({"user_id": pa.array([nodes["user_id"][0].as_py()] * len(i), pa.string()), "block_i": block[i].astype(np.int32), "part_i": part[i].astype(np.int32), "block_j": block[j].astype(np.int32), "part_j": part[j].astype(np.int32)})


def crossing(table: pa.Table) -> pa.Table:
    """LINKS of the edges between two parts in the tree of both."""
    table = table.sort_by("rank")
    rank, one = table["rank"].to_numpy(), table["first"].to_numpy(zero_copy_only=False)
    a, b, w = spanning(np.column_stack([table["x"].to_numpy(), table["y"].to_numpy()]), table["core"].to_numpy())
    own = one[a] != one[b]
    return pa.table({"user_id": pa.array([table["user_id"][0].as_py()] * int(own.sum()), pa.string()), "a": rank[a[own]], "b": rank[b[own]], "w": w[own]})


def tree_edges(placed: DataFrame, k: int, block: int = BLOCK, most: int = EDGES) -> DataFrame:
    """user_id, a, b (ranks), w: for each user edges that hold a minimum spanning tree of the user's points; at most `most` a user, or two a point."""
    dealt = dealt_blocks(placed, block)
    reach = core_distances(dealt, k)
    trees = written(reach.select("user_id", "rank", "x", "y", "core", "block").groupBy("user_id", "block").applyInArrow(own_tree, OWN))
    edges = trees.filter("a IS NOT NULL").select("user_id", "a", F.col("rank").alias("b"), "w")
    many = dealt.filter("blocks > 1").select("user_id").distinct()
    if many.isEmpty():
        return edges
    several = trees.join(many, "user_id", "left_semi")
    point = F.struct("x", "y", "core")
    nodes = written(several.groupBy("user_id", "block", "part").agg(
        *[f(c).alias(f"{c}{i}") for c in "xy" for i, f in enumerate((F.min, F.max))], F.min("core").alias("core"), F.max(F.when(~F.col("cut"), F.col("w"))).alias("inner"),
        F.array(F.min_by(point, "x"), F.max_by(point, "x"), F.min_by(point, "y"), F.max_by(point, "y")).alias("known"),
    ))
    cuts = several.filter("cut").select("user_id", "block", "part", "a_part", "w")
    meet = written(nodes.groupBy("user_id").cogroup(cuts.groupBy("user_id")).applyInArrow(meeting, MEETING))
    points = several.select("user_id", "rank", "x", "y", "core", "block", "part")
    side = lambda m, first: points.join(meet.withColumns({"block": F.col(f"block_{m}"), "part": F.col(f"part_{m}")}), ["user_id", "block", "part"]).withColumn("first", F.lit(first))
    pair = ["user_id", "block_i", "part_i", "block_j", "part_j"]
    edges = written(edges.unionByName(side("i", True).unionByName(side("j", False)).groupBy(*pair).applyInArrow(crossing, LINKS)))
    sizes = placed.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))

    def thin(table: pa.Table) -> pa.Table:
        return table.select(["user_id", "a", "b", "w"]).take(pa.array(thinned(*(table[c].to_numpy() for c in "abw"))))

    while True:
        crowded = edges.groupBy("user_id").agg(F.count(F.lit(1)).alias("m")).join(sizes, "user_id").filter((F.col("m") > most) & (F.col("m") > 2 * F.col("n")))
        crowded = written(crowded.select("user_id", F.ceil(F.col("m") / F.greatest(F.lit(most), 2 * F.col("n"))).cast("int").alias("parts")))
        if crowded.isEmpty():
            return edges
        apart = edges.join(crowded, "user_id").withColumn("part", F.pmod(F.xxhash64("a", "b"), F.col("parts")))
        edges = written(apart.groupBy("user_id", "part").applyInArrow(thin, LINKS).union(edges.join(crowded, "user_id", "left_anti")))


def cluster_grid(placed: DataFrame, settings: list[tuple[int, int, float]], most: int = SMALL) -> list[DataFrame]:
    """For each (min_cluster_size, min_samples, epsilon_m) the written rows of projected() with cluster.

    Users of at most `most` points, a block, are shuffled once, for all settings, and labelled many in a task; larger ones go by blocks.
    """
    small, large = by_size(placed, most)
    lots = labelled_lots(small, lambda xy, starts: small_labels(xy, starts, settings))
    out = [setting(lots, k) for k in range(len(settings))]
    if large is not None:
        large = written(large)
        edges = {k: tree_edges(large, k) for k in sorted({k for _, k, _ in settings})}
        out = [a.unionByName(cluster_placed(large, c, k, e, edges[k])) for a, (c, k, e) in zip(out, settings)]
    return out


#: Distances that are held at a time for small users' trees.
PAIRS = 1 << 21


def small_trees(xy: np.ndarray, starts: np.ndarray, ks: list[int]) -> Iterator[tuple[int, dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
    """The number of each user of two points at least, and for each k its spanning tree as of spanning(); users of like size take each step together."""
    sizes = np.diff(starts)
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 1]
    at = 0
    while at < len(order):
        take = 1
        while at + take < len(order) and (take + 1) * int(sizes[order[at + take]]) ** 2 <= PAIRS:
            take += 1
        users = order[at : at + take]
        at += take
        n = sizes[users]
        m = int(n[-1])
        there = np.arange(m) < n[:, None]
        place = np.where(there, starts[users][:, None] + np.arange(m), 0)
        x, y = (np.where(there, xy[place, c], np.inf) for c in (0, 1))
        with np.errstate(invalid="ignore"):
            squared = (x[:, :, None] - x[:, None]) ** 2 + (y[:, :, None] - y[:, None]) ** 2
        squared[~(there[:, :, None] & there[:, None])] = np.inf
        own = np.arange(m)
        squared[:, own, own] = np.inf
        nearest_first = np.partition(squared, sorted({min(k, m - 1) - 1 for k in ks}), axis=2)[:, :, : min(max(ks), m - 1)]
        apart = np.sqrt(squared)
        found = {}
        for k in ks:
            which = np.minimum(k, n - 1) - 1
            short = np.flatnonzero(which < min(k, m - 1) - 1)
            core = np.sqrt(nearest_first[:, :, min(k, m - 1) - 1])
            for i in short.tolist():  # fewer points than k: the farthest one
                core[i] = np.sqrt(np.sort(squared[i], axis=1)[:, which[i]])
            found[k] = _trees_together(np.maximum(np.maximum(apart, core[:, :, None]), core[:, None]), n)
        for i, user in enumerate(users.tolist()):
            yield user, {k: tuple(v[i, : n[i] - 1] for v in found[k]) for k in ks}


def _trees_together(reach: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends and lengths of the spanning trees of many users, n points each, from their lengths (users, points, points)."""
    users, m = reach.shape[:2]
    row = np.arange(users)
    done = np.arange(m) >= n[:, None]
    done[:, 0] = True
    best, source = reach[:, 0].copy(), np.zeros((users, m), np.int64)
    best[done] = np.inf
    a, b, w = np.zeros((users, m - 1), np.int64), np.zeros((users, m - 1), np.int64), np.full((users, m - 1), np.inf)
    for s in range(m - 1):
        last = best.argmin(axis=1)
        a[:, s], b[:, s], w[:, s] = source[row, last], last, best[row, last]
        done[row, last] = True
        step = reach[row, last]
        closer = (step < best) & ~done
        best = np.where(closer, step, best)
        best[done] = np.inf
        source = np.where(closer, last[:, None], source)
    return a, b, w


def small_labels(xy: np.ndarray, starts: np.ndarray, settings: list[tuple[int, int, float]]) -> np.ndarray:
    """The clusters of the points of users that begin at these places, a column for each setting, -1 for noise."""
    out = np.full((len(xy), len(settings)), -1, np.int32)
    for user, trees in small_trees(xy, starts, sorted({k for _, k, _ in settings})):
        lo, hi = int(starts[user]), int(starts[user + 1])
        for j, (least, k, epsilon) in enumerate(settings):
            out[lo:hi, j] = labels(hi - lo, *trees[k], least, epsilon)
    return out


def cluster_placed(placed: DataFrame, min_cluster_size: int = 5, min_samples: int | None = None, epsilon_m: float = 0.0, edges: DataFrame | None = None) -> DataFrame:
    """The written rows of projected() with cluster; see hdbscan_labels(). `edges` are those of tree_edges() if they are there already."""
    if edges is None:
        return cluster_grid(placed, [(min_cluster_size, min_samples or min_cluster_size, epsilon_m)])[0]

    def label(points: pa.Table, links: pa.Table) -> pa.Table:
        rank = np.sort(points["rank"].to_numpy())
        a, b = (np.searchsorted(rank, links[c].to_numpy()) for c in "ab")
        found = labels(len(rank), a, b, links["w"].to_numpy(), min_cluster_size, epsilon_m)
        users = pa.array([points["user_id"][0].as_py()] * len(rank) if len(rank) else [], pa.string())
        return pa.table({"user_id": users, "rank": pa.array(rank, pa.int32()), "cluster": pa.array(found, pa.int32())})

    found = placed.select("user_id", "rank").groupBy("user_id").cogroup(edges.groupBy("user_id")).applyInArrow(label, "user_id string, rank int, cluster int")
    return placed.join(found, ["user_id", "rank"]).select("user_id", "rank", "timestamp", "lat", "lon", F.when(F.col("cluster") >= 0, F.col("cluster")).alias("cluster"))


def hdbscan_labels(points: DataFrame, min_cluster_size: int = 5, min_samples: int | None = None, epsilon_m: float = 0.0) -> DataFrame:
    """user_id, rank, timestamp, lat, lon, cluster (dense from 0 per user in order of the first point; null for noise).

    A point's core distance is that to its `min_samples`-th neighbour (`min_cluster_size`-th if none is given), the point itself not counted, or to the
    farthest one where there are fewer. Rows without a user, place or time take no part.
    """
    return cluster_placed(written(projected(points)), min_cluster_size, min_samples, epsilon_m)
