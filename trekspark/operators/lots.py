"""Small groups worked many at a time: a task's sorted rows in lots of whole groups, instead of one call for each group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import written

#: Points of a user that is worked in a lot with others; a larger one is worked in parts.
SMALL = 2048


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and where each group begins and the last one ends, from batches in which a group's rows follow each other.

    The group that is open at a batch's end waits for the next batch, so a task holds a batch and one group.
    """
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        starts = _starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, int(starts[-1])).combine_chunks(), starts
        held = table.slice(int(starts[-1])) if table.num_rows else None
    if held is not None and held.num_rows:
        yield held.combine_chunks(), np.array([0, held.num_rows])


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    rows = list(zip(*(table[k].to_pylist() for k in keys)))
    return np.array([i for i, row in enumerate(rows) if i == 0 or row != rows[i - 1]], np.int64)


def by_size(placed: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of users with at most `most` rows, those of the others; None if there are none), without rows that have no user."""
    known = placed.filter("user_id IS NOT NULL")
    large = written(known.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select("user_id"))
    if large.isEmpty():
        return known, None
    return known.join(large, "user_id", "left_anti"), known.join(large, "user_id", "left_semi")


def labelled_lots(small: DataFrame, label) -> DataFrame:
    """The rows with clusters, what label(x and y of many users in order of rank, where each user begins) gives for each setting: numbers, -1 for none. Written."""
    columns = ["user_id", "rank", "timestamp", "lat", "lon"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["user_id"]):
            found = label(np.column_stack([table["x"].to_numpy(), table["y"].to_numpy()]), starts)  # (points, settings)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel().astype(np.int32)))
            yield from pa.table([*(table[c] for c in columns), lists], names=[*columns, "clusters"]).to_batches()

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in small.select(*columns).schema)
    rows = small.select(*columns, "x", "y").repartition("user_id").sortWithinPartitions("user_id", "rank")
    return written(rows.mapInArrow(run, f"{ddl}, clusters array<int>"))


def setting(lots: DataFrame, k: int) -> DataFrame:
    """The rows of labelled_lots() with cluster, that of the k-th setting; null for none."""
    cluster = F.get("clusters", F.lit(k))
    return lots.select("user_id", "rank", "timestamp", "lat", "lon", F.when(cluster >= 0, cluster).alias("cluster"))
