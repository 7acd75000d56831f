"""Map matching behind an interface: batches of one trip each, sent by a client from the tasks."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import written
from .lots import whole_groups
from .ranks import running_sums

MATCHED = "user_id string, trip_id string, seq int, snapped_lat double, snapped_lon double, snapped_time timestamp, confidence double, matched boolean, asked boolean, lateral_offset_m double"
#: A client takes (lat, lon, unix second) lists and gives (lat, lon) or None per point with a confidence, or None if it fails.
Client = Callable[[list[float], list[float], list[int]], tuple[list[tuple[float, float] | None], float] | None]


@dataclass
class RoutingService:
    """A client of a routing service's match call over HTTP."""

    url: str = "http://localhost:5000"
    accuracy_m: float = 10.0
    most_m: float = 100.0
    profile: str = "driving"
    timeout_s: float = 8.0

    def __call__(self, lat: list[float], lon: list[float], at: list[int]):
        radius = min(max(1.0, self.accuracy_m), self.most_m)
        places = ";".join(f"{x:.6f},{y:.6f}" for x, y in zip(lon, lat))
        query = f"geometries=geojson&overview=false&timestamps={';'.join(map(str, at))}&radiuses={';'.join([f'{radius:g}'] * len(lat))}"
        try:
            with urllib.request.urlopen(f"{self.url}/match/v1/{self.profile}/{places}?{query}", timeout=self.timeout_s) as answer:
                data = json.load(answer)
        except (OSError, ValueError):
            return None
        if data.get("code") != "Ok":
            return None
        found = [tuple(t["location"][::-1]) if t else None for t in data.get("tracepoints", [])]
        return found, max((m.get("confidence", 0.0) for m in data.get("matchings", [])), default=0.0)


def batch_key(points: DataFrame) -> DataFrame:
    """trip_id as the batch; user and day where a table has no trips."""
    if "trip_id" in points.columns:
        return points
    return points.withColumn("trip_id", F.concat_ws("-", "user_id", F.date_format(F.col("timestamp").cast("timestamp"), "yyyyMMdd")))


def map_match(points: DataFrame, client: Client, fail_limit: int | None = 3, tasks: int | None = None) -> DataFrame:
    """Every point with its matched place, in MATCHED's columns.

    A point that isn't matched, of a batch of less than two points or of one that fails, keeps its own place, its matched is false and its confidence null.
    Batches are numbered by user and trip. A batch is asked for if fewer than `fail_limit` of those before it failed; from the batch that
    makes it so many, the service is taken to be down and no later one is asked, for each would be held until its timeout. `asked` tells which were.
    So no point is left out, and the rows don't depend on partitions. None asks always.

    To count failures in that order while many tasks ask at once, `tasks` of them run as one barrier stage and take the batches in turn, one each a
    round; after a round they tell each other which failed. Those that were asked in the round in which the limit was reached, but
    stand behind it, are put back to not asked: at most `tasks` - 1 calls are made in vain. A barrier stage needs as many free cores as `tasks` (default: the
    cluster's parallelism) and executors that aren't allocated dynamically.
    """
    from ..functions.geo import haversine_m

    spark = points.sparkSession
    df = batch_key(points).filter("lat IS NOT NULL AND lon IS NOT NULL AND timestamp IS NOT NULL")
    ties = [c for c in ("event_id", "source_file") if c in df.columns]
    df = df.select("user_id", "trip_id", "lat", "lon", F.col("timestamp").cast("timestamp").alias("timestamp"), F.struct("timestamp", *ties, "lat", "lon").alias("_order"), F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / 1_000_000).alias("_at"))
    if fail_limit is None:  # batches are small, so a task takes its sorted rows in lots of whole ones, not a call of its own for each
        sorted_rows = df.repartition("user_id", "trip_id").sortWithinPartitions("user_id", "trip_id", "_order").drop("_order")
        out = sorted_rows.mapInArrow(lambda batches: (_answered(table, starts, client) for table, starts in whole_groups(batches, ["user_id", "trip_id"])), PLACED)
    else:
        df = df.withColumn("seq", (F.row_number().over(Window.partitionBy("user_id", "trip_id").orderBy("_order")) - 1).cast("int")).drop("_order")
        df = written(df)
        several = df.groupBy("user_id", "trip_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").withColumn("_all", F.lit(1))
        numbered = written(running_sums(several, ["_all"], ["user_id", "trip_id"], {"_batch": F.lit(1)}).select(F.col("user_id").alias("_u"), F.col("trip_id").alias("_t"), (F.col("_batch") - 1).alias("_batch")))
        batches, width = numbered.count(), tasks or spark.sparkContext.defaultParallelism
        both = df.join(numbered, F.col("user_id").eqNullSafe(F.col("_u")) & F.col("trip_id").eqNullSafe(F.col("_t")), "left").drop("_u", "_t")
        alone = both.filter("_batch IS NULL").select(*[c for c in df.columns if c != "_at"], F.col("lat").alias("snapped_lat"), F.col("lon").alias("snapped_lon"), F.lit(None).cast("double").alias("confidence"), F.lit(False).alias("matched"), F.lit(False).alias("asked"))
        turns = both.filter("_batch IS NOT NULL").repartitionById(width, (F.col("_batch") % width).cast("int")).sortWithinPartitions("_batch", "seq")
        rounds = -(-batches // width)
        asked = turns.mapInPandas(lambda frames: _in_rounds(frames, client, fail_limit, rounds, width), PLACED, barrier=True)
        out = written(asked).unionByName(alone)
    out = out.withColumn("lateral_offset_m", haversine_m(F.col("lat"), F.col("lon"), F.col("snapped_lat"), F.col("snapped_lon")))
    return out.select("user_id", "trip_id", "seq", "snapped_lat", "snapped_lon", F.col("timestamp").alias("snapped_time"), "confidence", "matched", "asked", "lateral_offset_m")


PLACED = "user_id string, trip_id string, lat double, lon double, timestamp timestamp, seq int, snapped_lat double, snapped_lon double, confidence double, matched boolean, asked boolean"


def _answered(table: pa.Table, starts: np.ndarray, client: Client) -> pa.RecordBatch:
    """PLACED of a lot of whole batches in order, each of two points at least asked for by itself."""
    lat, lon, at = (table[c].to_pylist() for c in ("lat", "lon", "_at"))
    places, sure, asked, seq = [], [], [], []
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        n = hi - lo
        answer = client(lat[lo:hi], lon[lo:hi], at[lo:hi]) if n > 1 else None
        found, confidence = answer or ([None] * n, None)
        places += found
        sure += [None if f is None else confidence for f in found]
        asked += [n > 1] * n
        seq += range(n)
    snapped = [[own if f is None else f[k] for f, own in zip(places, column)] for k, column in enumerate((lat, lon))]
    columns = [*(table[c] for c in ("user_id", "trip_id", "lat", "lon", "timestamp")), pa.array(seq, pa.int32()), *(pa.array(c, pa.float64()) for c in (*snapped, sure)), pa.array([f is not None for f in places]), pa.array(asked)]
    return pa.table(columns, names=[c.split()[0] for c in PLACED.split(", ")]).combine_chunks().to_batches()[0]


def _placed(pdf: pd.DataFrame, answer, asked: bool) -> pd.DataFrame:
    """PLACED of a batch's points and the service's answer."""
    pdf = pdf.sort_values("seq")
    found, sure = answer or ([None] * len(pdf), None)
    places = [f or own for f, own in zip(found, zip(pdf["lat"], pdf["lon"]))]
    return pdf[["user_id", "trip_id", "lat", "lon", "timestamp", "seq"]].assign(snapped_lat=[p[0] for p in places], snapped_lon=[p[1] for p in places], confidence=[sure if f else None for f in found], matched=[f is not None for f in found], asked=asked)


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """The batches of sorted rows one by one."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        for number, rows in frame.groupby("_batch", sort=True):
            if held and held[0]["_batch"].iloc[0] != number:
                yield int(held[0]["_batch"].iloc[0]), pd.concat(held)
                held = []
            held.append(rows)
    if held:
        yield int(held[0]["_batch"].iloc[0]), pd.concat(held)


def _in_rounds(frames: Iterator[pd.DataFrame], client: Client, limit: int, rounds: int, width: int) -> Iterator[pd.DataFrame]:
    """A task's batches, one a round; in round r the tasks hold batches r * width to (r + 1) * width - 1 between them.

    All tasks take part in every round until the limit is reached, whether they have a batch left or not.
    """
    context = BarrierTaskContext.get()
    waiting, failed, down = _batches(frames), 0, limit <= 0
    for turn in range(rounds):
        batch = next(waiting, None)
        if down:
            if batch is not None:
                yield _placed(batch[1], None, False)
            continue
        answer = _ask(client, batch[1]) if batch else None
        told = context.allGather("" if batch is None else f"{batch[0]} {int(answer is None)}")
        lost = sorted(int(number) for number, bad in (t.split() for t in told if t) if bad == "1")
        down = failed + len(lost) >= limit
        last = lost[limit - failed - 1] if down else None
        failed += len(lost)
        if batch is not None:
            asked = last is None or batch[0] <= last
            yield _placed(batch[1], answer if asked else None, asked)


def _ask(client: Client, pdf: pd.DataFrame):
    pdf = pdf.sort_values("seq")
    return client(pdf["lat"].tolist(), pdf["lon"].tolist(), pdf["_at"].tolist())
