"""Trips of a stream of points: whole trips by keyed state and event time, or session windows that count points."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.geo import EARTH_M

TRIPS = "user_id string, trip_seq int, trip_id string, start_time timestamp, end_time timestamp, points long, distance_m double, duration_s double, avg_speed_kmh double, start_lat double, start_lon double, end_lat double, end_lon double"
#: A user's state: points that may still be preceded by others, the last point before them, the last one that passed the speed filter, and the open trip.
STATE = "waiting_us array<long>, waiting_id array<long>, waiting_lat array<double>, waiting_lon array<double>, last_us long, last_lat double, last_lon double, kept_us long, seq int, start_us long, end_us long, points long, distance_m double, start_lat double, start_lon double, end_lat double, end_lon double"


def session_trips(points: DataFrame, gap_min: float = 30.0, late: str = "2 hours") -> DataFrame:
    """user_id, start_time, end_time, points of each session; works alike on a stream and on a table.

    A session goes on while the gap isn't longer than the threshold, and a stream gives it out once the watermark has
    passed its end.
    """
    timed = points.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)
    # A session window is half-open; the extra millisecond keeps points exactly one gap apart together.
    window = F.session_window("timestamp", f"{int(gap_min * 60_000) + 1} milliseconds")
    return timed.groupBy("user_id", window.alias("w")).agg(F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"), F.count(F.lit(1)).alias("points")).drop("w")


class Track:
    """One user's trips so far, taken on point by point in time order; it lives in the stream's state between batches."""

    def __init__(self, gap_us: float, max_speed_kmh: float | None, state: tuple | None = None):
        self.gap_us, self.cap = gap_us, max_speed_kmh
        self.waiting = list(zip(*state[:4])) if state else []
        self.last = state[4:7] if state else (None, None, None)
        self.kept_us, self.seq = state[7:9] if state else (None, -1)
        self.trip = list(state[9:]) if state and state[9] is not None else None

    def packed(self) -> tuple:
        columns = [list(c) for c in zip(*self.waiting)] if self.waiting else [[], [], [], []]
        return (*columns, *self.last, self.kept_us, self.seq, *(self.trip or [None] * 8))

    def settle(self, upto_us: int) -> Iterator[tuple]:
        """Takes on the waiting points up to a time that no earlier point can follow any more, and gives out trips that they or the time itself close."""
        self.waiting.sort(key=lambda p: (p[0], p[1], p[2] is None, p[2] or 0.0, p[3] or 0.0))
        while self.waiting and self.waiting[0][0] <= upto_us:
            yield from self.take(self.waiting.pop(0))
        if self.trip and upto_us - self.kept_us > self.gap_us:  # whatever comes is later than upto_us
            yield self.closed()

    def take(self, point: tuple) -> Iterator[tuple]:
        us, _, lat, lon = point
        before_us, before_lat, before_lon = self.last
        step = 0.0 if before_us is None or None in (lat, lon, before_lat, before_lon) else metres(before_lat, before_lon, lat, lon)
        pause = 0.0 if before_us is None else (us - before_us) / 1e6
        self.last = (us, lat, lon)
        if self.cap is not None and pause > 0 and step / pause * 3.6 > self.cap:
            return
        if self.kept_us is None or us - self.kept_us > self.gap_us:
            if self.trip:
                yield self.closed()
            self.seq += 1
            self.trip = [us, us, 0, 0.0, lat, lon, lat, lon]
            step = 0.0
        self.kept_us = us
        self.trip[1:4] = us, self.trip[2] + 1, self.trip[3] + step
        self.trip[6:8] = lat, lon

    def closed(self) -> tuple:
        trip, self.trip = (self.seq, *self.trip), None
        return trip


def metres(a_lat: float, a_lon: float, b_lat: float, b_lon: float) -> float:
    """Great-circle metres between two places; not a number where there is none."""
    try:
        a, b = math.radians(a_lat), math.radians(b_lat)
        h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin((math.radians(b_lon) - math.radians(a_lon)) / 2) ** 2
        return 2.0 * EARTH_M * math.atan2(math.sqrt(h), math.sqrt(1 - h))
    except ValueError:  # an infinite coordinate
        return math.nan


def trip_stream(points: DataFrame, gap_min: float = 30.0, min_distance_m: float = 100.0, max_speed_kmh: float | None = 200.0, late: str = "2 hours") -> DataFrame:
    """The trips of segment_trips (motion, speed filter, gaps, least distance) of a stream of user_id, timestamp, lat, lon and event_id if it has one.

    A point waits in its user's state until the watermark, the latest time seen less `late`, has passed it, for an earlier one may
    still come; equal times go by event_id. Then it is taken on in time order. A trip is given out, once, when a point beyond the gap is taken on, or
    when the watermark itself is beyond the gap (an event-time timer wakes users that nothing more comes for). Points that are behind the watermark
    when they come are left out, and so are rows without a user or time: whatever order the others come in, the trips are those of the
    table of all of them. Numbers go on over the whole stream, those of trips that are too short included. A user's state is
    its waiting points and one open trip.
    """
    own = F.col("event_id").cast("long") if "event_id" in points.columns else F.lit(0).cast("long")
    timed = points.filter("user_id IS NOT NULL AND timestamp IS NOT NULL").select(F.col("user_id").cast("string").alias("user_id"), F.col("timestamp").cast("timestamp").alias("timestamp"), own.alias("event_id"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    timed = timed.withWatermark("timestamp", late)
    timed = timed.withColumn("_us", F.unix_micros("timestamp"))
    gap_us = gap_min * 60e6

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        track = Track(gap_us, max_speed_kmh, state.get if state.exists else None)
        passed = state.getCurrentWatermarkMs() * 1000
        for batch in batches:
            us, number = batch["_us"].to_numpy(), batch["event_id"]
            fresh = us > passed
            numbers = lambda c: [None if v != v else v for v in batch[c].to_numpy(float)[fresh].tolist()]
            own = (number.fillna(0) if number.hasnans else number).to_numpy()[fresh]
            track.waiting.extend(zip(us[fresh].tolist(), map(int, own.tolist()), numbers("lat"), numbers("lon")))
        done = [t for t in track.settle(passed) if t[4] >= min_distance_m]
        wake = track.waiting[0][0] if track.waiting else track.kept_us + int(gap_us) if track.trip else None
        state.update(track.packed())
        if wake is not None:
            state.setTimeoutTimestamp(max(wake // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if done:
            seq, start, end, n, metre, *places = zip(*done)
            seconds = (np.array(end) - np.array(start)) / 1e6
            out = pd.DataFrame({"user_id": key[0], "trip_seq": seq, "trip_id": [f"{key[0]}-{s}" for s in seq], "start_time": pd.to_datetime(start, unit="us"), "end_time": pd.to_datetime(end, unit="us"), "points": n, "distance_m": metre, "duration_s": seconds, "avg_speed_kmh": [m / s * 3.6 if s > 0 else 0.0 for m, s in zip(metre, seconds)]})
            yield out.assign(**dict(zip(("start_lat", "start_lon", "end_lat", "end_lon"), places)))

    return timed.groupBy("user_id").applyInPandasWithState(run, TRIPS, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def watch(spark, folder: str, schema: str, out: str, checkpoint: str, gap_min: float = 30.0):
    """A running query from a folder of Parquet points to a folder of sessions."""
    return session_trips(spark.readStream.schema(schema).parquet(folder), gap_min).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).start(out)


def trips_so_far(points: DataFrame, folder: str, gap_min: float = 30.0, min_distance_m: float = 100.0, late: str = "2 hours") -> DataFrame:
    """The trips that a stream has closed once it has taken all that is there now; the stream's state stays below `folder` and it can go on from there."""
    stream = trip_stream(points, gap_min, min_distance_m, late=late).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/state")
    query = stream.trigger(availableNow=True).start(f"{folder}/trips")
    query.awaitTermination()
    return points.sparkSession.read.schema(TRIPS).parquet(f"{folder}/trips")


def watch_trips(spark, folder: str, schema: str, out: str, checkpoint: str, gap_min: float = 30.0, min_distance_m: float = 100.0, late: str = "2 hours", files: int | None = None):
    """A running query from a folder of Parquet points to a folder of whole trips, `files` files a batch at most."""
    stream = spark.readStream.schema(schema)
    points = (stream.option("maxFilesPerTrigger", files) if files else stream).parquet(folder)
    return trip_stream(points, gap_min, min_distance_m, late=late).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).start(out)
