"""A points table, and matched traces, derived from the `events` table by fixed arithmetic that every SQL engine evaluates alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GAP_MIN = 720.0
D = "CAST({} AS DOUBLE)".format
#: Three places a user, a metre-scale spread around them, and a far jump every 97th event.
LAT = f"{D('39.9')} + {D('user_id % 10')} / {D(100)} + CASE WHEN event_type IN ('view', 'click') THEN {D(0)} WHEN event_type = 'signup' THEN {D('0.05')} ELSE {D('0.02')} END + {D('event_id % 21 - 10')} / {D(20000)} - CASE WHEN event_id % 97 = 0 THEN {D(30)} ELSE {D(0)} END"
LON = f"{D('116.4')} + {D('user_id % 7')} / {D(100)} + CASE WHEN event_type IN ('view', 'click') THEN {D(0)} WHEN event_type = 'signup' THEN {D('0.01')} ELSE {D('0.03')} END + {D('event_id % 17 - 8')} / {D(20000)}"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, timestamp, event_id, lat, lon."""
    return as_points(spark.read.parquet(f"{sf_dir}/events.parquet"))


def point_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a stream that reads the table's files."""
    return as_points(spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(f"{sf_dir}/events.parquet*"))


def as_points(table: DataFrame) -> DataFrame:
    return table.selectExpr("CAST(user_id AS STRING) AS user_id", "CAST(ts AS TIMESTAMP) AS timestamp", "event_id", f"{LAT} AS lat", f"{LON} AS lon")


def matched(trip_points: DataFrame, late_s: int = 1) -> DataFrame:
    """A matched trace of points that have a trip: each moved by some metres, every tenth unmatched, their times up to `late_s` - 1 seconds late."""
    w = Window.partitionBy("trip_id").orderBy("timestamp", "event_id")
    df = trip_points.withColumn("seq", (F.row_number().over(w) - 1).cast("int"))
    return df.selectExpr("user_id", "trip_id", "seq", f"lat + {D('event_id % 5 - 2')} / {D(50000)} AS snapped_lat", f"lon + {D('event_id % 3 - 1')} / {D(50000)} AS snapped_lon", f"timestamp + make_interval(0, 0, 0, 0, 0, 0, event_id % {late_s}) AS snapped_time", f"{D('event_id % 100')} / {D(100)} AS confidence", "event_id % 10 <> 0 AS matched", f"{D('event_id * 37 % 360')} AS heading_deg")
