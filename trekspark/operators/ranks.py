"""Running sums, ranks and quantiles that don't gather a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import written


def running_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """df with each named sum running over a key's rows in the order given, this row included.

    Rows are range-partitioned by key and order and written; a part's rows are summed in its own task, and what lies before
    a part is added from one row per part and key. So a key with a third of all rows is worked by many tasks.
    """
    names = list(sums)
    placed = df.withColumns({f"_v_{c}": v for c, v in sums.items()}).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = written(placed.withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy("_part", *keys).agg(*[F.sum(f"_v_{c}").alias(f"_t_{c}") for c in names])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_b_{c}") for c in names])
    inside = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = placed.withColumns({f"_r_{c}": F.sum(f"_v_{c}").over(inside) for c in names})
    match = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = run.join(before, match).withColumns({c: F.col(f"_r_{c}") + F.col(f"_b_{c}") for c in names})
    return out.select(*df.columns, *names)


def split_quantiles(df: DataFrame, keys: list[str], value: str, shares: tuple[float, ...]) -> DataFrame:
    """keys, n (rows with a value), q: the exact linear quantiles of each key's values, as an array in the order of `shares`.

    Values are counted first and the counts summed over ranges, so no task holds a key's values.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    run = running_sums(counts, keys, [value], {"_upto": F.col("_c")})
    totals = counts.groupBy(*keys).agg(F.sum("_c").alias("n")).select("n", *[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)])
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_t{i}"))
    place = lambda share: F.lit(share) * (F.col("n") - 1)
    at = lambda index: F.min(F.when(F.col("_upto") > index, F.col(value)))
    ends = [at(r(place(s))).alias(f"_{m}{i}") for i, s in enumerate(shares) for m, r in (("lo", F.floor), ("hi", F.ceil))]
    out = run.join(totals, match).groupBy(*keys, "n").agg(*ends)
    part = lambda i, s: F.col(f"_lo{i}") + (place(s) - F.floor(place(s))) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))
    return out.select(*keys, "n", F.array(*[part(i, s) for i, s in enumerate(shares)]).alias("q"))


def whole_quantiles(df: DataFrame, value: str, shares: tuple[float, ...] = (0.5,)) -> DataFrame:
    """One row, q: the exact quantiles of all of a table's values by split_quantiles; null if it has none."""
    found = split_quantiles(df.select(value).withColumn("_all", F.lit(1)), ["_all"], value, shares)
    return found.agg(F.first("q").alias("q"))


def quantiles(value: str, shares: tuple[float, ...], accuracy: int | None = None) -> Column:
    """An array of linear quantiles, exact; or approximate ones of bounded memory if an accuracy is given."""
    at = F.array(*[F.lit(s) for s in shares])
    return F.percentile(value, at) if accuracy is None else F.percentile_approx(value, at, accuracy)
