"""Joins that Spark has no operator for: intervals within a key, and points within a distance.

Both become equi-joins on buckets with the exact condition behind them, so they are hash or sort-merge joins that
shuffle on a fine key, never nested loops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _buckets(start: Column, end: Column, seconds: int) -> Column:
    number = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / (seconds * 1_000_000)).cast("long")
    return F.sequence(number(start), number(end))


def interval_join(left: DataFrame, right: DataFrame, key: str, left_span: tuple[str, str], right_span: tuple[str, str], bucket_s: int = 86_400) -> DataFrame:
    """Pairs of one key whose closed intervals meet.

    Each interval goes to every time bucket it touches; a pair is given in the bucket where its overlap begins, so once.
    A key with very many intervals is thereby spread over its days.
    """
    (ls, le), (rs, re) = left_span, right_span
    one = left.filter(F.col(ls) <= F.col(le)).withColumn("_bucket", F.explode(_buckets(F.col(ls), F.col(le), bucket_s)))
    two = right.filter(F.col(rs) <= F.col(re)).withColumn("_bucket", F.explode(_buckets(F.col(rs), F.col(re), bucket_s)))
    begin = F.greatest(F.col(ls), F.col(rs))
    here = F.floor(F.unix_micros(begin.cast("timestamp")) / (bucket_s * 1_000_000)).cast("long") == F.col("_bucket")
    return one.join(two, [key, "_bucket"]).filter((F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le)) & here).drop("_bucket")


def grid_join(left: DataFrame, right: DataFrame, radius: float, keys: list[str], left_xy: tuple[str, str], right_xy: tuple[str, str]) -> DataFrame:
    """Pairs with equal keys at most `radius` apart in the plane: cells of that side, the right side sent to its nine neighbours."""
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    one = left.withColumns({"_cx": cell(left_xy[0]), "_cy": cell(left_xy[1])})
    two = right.withColumn("_n", F.explode(around)).withColumns({"_cx": cell(right_xy[0]) + F.col("_n.i"), "_cy": cell(right_xy[1]) + F.col("_n.j")}).drop("_n")
    gap = F.pow(F.col(left_xy[0]) - F.col(right_xy[0]), 2.0) + F.pow(F.col(left_xy[1]) - F.col(right_xy[1]), 2.0)
    return one.join(two, [*keys, "_cx", "_cy"]).filter(gap <= radius * radius).drop("_cx", "_cy")
