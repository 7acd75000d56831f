"""Best-fit packing by patterns and non-negative least squares.

Documents become token pieces of at most `size` tokens. Only the histogram of piece lengths (at most `size` rows) comes
to the driver. There, patterns of one to four lengths that fill a sequence are enumerated, their repeat counts are
fitted to the histogram by non-negative least squares, rounded to what the histogram holds, and the residual lengths
are packed best-fit in decreasing order. The plan is a slot table whose size depends on `size` alone; pieces find their slot by their
rank among the pieces of equal length, counted in salted groups.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, only, stored, texts_of
from .tokens import encoder, with_end

SALTS = 128
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of each row's ids followed by `end_id`.

    A null text counts as empty and gives one piece of the end id alone; repeated rows each give their pieces; a null
    doc_id is kept as null; an empty table gives no rows; other columns aren't read.
    """

    def run(batches):
        for batch in bounded(batches, limit=2 << 20):  # beside a JVM that has grown in the stages before
            ids, at = with_end(*encoder(tokenizer).batch(texts_of(batch)), end_id)
            raw = ids.astype("<u4").tobytes()
            n = np.diff(at)
            count = -(-n // size)
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * size
            length = np.minimum(size, n[doc] - start)
            lo = (at[:-1][doc] + start) * 4
            view = memoryview(raw)
            crc = [zlib.crc32(view[a:b]) for a, b in zip(lo.tolist(), (lo + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return only(docs, "doc_id", "text").mapInArrow(run, PIECE_SCHEMA)


def patterns(counts: np.ndarray, size: int, partners: int = 12) -> list[tuple[int, ...]]:
    """Few-length patterns that fill `size` as well as lengths in the histogram can; counts[L] is the number of pieces of length L.

    Each length meets `partners` lengths spread over the histogram's mass, and the longest length that still fits
    closes the sequence. So at most size * (1 + 2 * partners) patterns come out, whatever the data.
    """
    have = np.flatnonzero(counts)
    if not len(have):
        return []
    fits = np.zeros(size + 1, np.int64)  # the longest present length that is at most this
    fits[have] = have
    fits = np.maximum.accumulate(fits)
    mass = np.cumsum(counts[have])
    spread = np.unique(have[np.searchsorted(mass, np.linspace(1, mass[-1], partners))])
    found = {(int(length),) for length in have if size - length < have[0]}
    for a in have:
        rest = size - a
        if c := fits[rest]:
            found.add(tuple(sorted((int(a), int(c)))))
        for b in spread:
            left = rest - b
            if left >= 0 and (c := fits[left]):
                found.add(tuple(sorted((int(a), int(b), int(c)))))
                more = left - c
                if more and (d := fits[more]):
                    found.add(tuple(sorted((int(a), int(b), int(c), int(d)))))
    return sorted(found)


def nnls(columns: list[tuple[int, ...]], target: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 that brings sum of x times the columns' length counts near to target, by accelerated projected gradient."""
    rows = np.array([v for c in columns for v in c])
    cols = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    scale = 1 / np.sqrt(np.maximum(target, 1.0))  # errors count against the root of a length's count
    forward = lambda x: np.bincount(rows, x[cols], len(target)) * scale
    back = lambda r: np.bincount(cols, (r * scale)[rows], len(columns))
    v = np.ones(len(columns))
    for _ in range(20):
        v = back(forward(v))
        top = np.linalg.norm(v)
        v /= top
    goal, x, y, t = target * scale, np.zeros(len(columns)), np.zeros(len(columns)), 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(forward(y) - goal) / (1.05 * top))
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / u * (new - x)
        x, t = new, u
    return x


def best_fit(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: equal sequences are filled together, so time follows the lengths, not the pieces."""
    open_bins: dict[int, list] = defaultdict(list)  # room left: [lengths, number of such sequences]
    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        while n:
            room = min((r for r, bins in open_bins.items() if r >= length and bins), default=None)
            if room is None:
                room = size
                open_bins[size].append([(), -(-n // (size // length))])
            inside, k = open_bins[room].pop()
            each = room // length
            full = min(k, n // each)
            if full:
                open_bins[room - each * length].append([inside + (length,) * each, full])
            else:
                full, each = 1, n
                open_bins[room - n * length].append([inside + (length,) * n, 1])
            n -= full * each
            if k > full:
                open_bins[room].append([inside, k - full])
            if not inside and n == 0:
                open_bins[size] = []
    return [(tuple(x), k) for bins in open_bins.values() for x, k in bins if x]


def plan(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how often it is made), which together hold every piece of the histogram."""
    left = counts.astype(np.int64).copy()
    made: list[tuple[tuple[int, ...], int]] = []
    columns = patterns(left, size)
    if columns:
        x = nnls(columns, left.astype(float))
        fill = np.array([sum(c) for c in columns])
        for i in np.lexsort((-x, -fill)):
            need = np.unique(columns[i], return_counts=True)
            k = min(int(x[i] + 0.5), int((left[need[0]] // need[1]).min()))
            if k and fill[i] >= 0.98 * size:
                left[need[0]] -= k * need[1]
                made.append((columns[i], k))
    return made + best_fit(left, size)


def slots(made: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Rows (length, lo, hi, first, offset): the pieces of this length with ranks lo..hi-1 go to sequences first + rank - lo."""
    used: dict[int, int] = defaultdict(int)
    rows, first = [], 0
    for lengths, k in made:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], used[length] + k, first, offset))
            used[length] += k
            offset += length
        first += k
    return pd.DataFrame(rows, columns=["slot_length", "lo", "hi", "first", "offset"]).astype("int64")


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. See cut_pieces() for odd rows.

    Pieces of one length are ranked in SALTS groups and the groups' sizes are summed, so a length that a third of all
    rows share is ranked by many tasks.
    """
    spark = docs.sparkSession
    cut = stored(cut_pieces(docs, tokenizer, size, end_id).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int")), "pieces")
    groups = cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    groups = stored(groups, "lengths")
    counts = np.zeros(size + 1, np.int64)
    for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `size` rows
        counts[r["length"]] = r["n"]
    table = slots(plan(counts, size))
    seats = spark.createDataFrame(table, "slot_length long, lo long, hi long, first long, offset long")
    before = groups.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).select(F.col("length").alias("of_length"), F.col("salt").alias("of_salt"), F.coalesce("before", F.lit(0)).alias("before"))
    ranked = cut.withColumn("within", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1)
    ranked = ranked.join(before, (F.col("length") == F.col("of_length")) & (F.col("salt") == F.col("of_salt"))).withColumn("rank", F.col("before") + F.col("within"))
    placed = ranked.join(F.broadcast(seats), (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset")
