"""Shared helpers of the training-data operators: scratch folders, bounded Arrow batches, crc32 buckets."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: UTF-8 bytes of text that a Python task works on at a time; a longer single text makes a batch of its own.
BATCH_BYTES = 4 << 20
#: ASCII white space, as the word definitions of the operators count it.
SPACE_CLASS = r"\x20\x09-\x0D"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir; only where that is unset, in local mode, below a temporary folder of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="trekspark-")
        spark.sparkContext.setCheckpointDir(base)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


#: Scratch folders that this process has named and not cleared, in order.
_made: list[str] = []


def scratch_mark() -> int:
    """A place in the order of scratch folders: those named from now on come behind it."""
    return len(_made)


def clear_scratch(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> int:
    """Deletes the scratch folders named behind a mark and says how many; but for those that `keep` reads. Results that read the others must be done."""
    files = keep.inputFiles() if keep is not None else []
    if keep is not None and not files:  # it can't be told what it reads
        return 0
    gone = [path for path in _made[since:] if not any(f"/{path.rsplit('/', 1)[-1]}/" in f for f in files)]
    for path in gone:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _made[since:] = [path for path in _made[since:] if path not in gone]
    return len(gone)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared scratch folder and reads it back: a cut of lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most `limit` text bytes (one row at least), small neighbours merged, so Python memory doesn't follow the row count."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lens = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lens)
        at = 0
        while at < batch.num_rows:
            room = limit - size + (ends[at - 1] if at else 0)
            to = int(np.searchsorted(ends, room, side="right"))
            if to <= at and not held:
                to = at + 1
            if to > at:
                held.append(batch.slice(at, to - at))
                size += int(ends[to - 1] - (ends[at - 1] if at else 0))
                at = to
            if at < batch.num_rows or size >= limit:
                yield _merged(held)
                held, size = [], 0
    if held:
        yield _merged(held)
    _give_back()


def _give_back() -> None:
    """Returns freed memory to the system at a task's end; a reused Python worker else keeps its peak."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def _merged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column, null as empty."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.string()), "")


def crc_bucket(doc_id, buckets: int):
    """crc32 of the id's decimal text, modulo `buckets`; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(buckets)


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns named by their place (`_0`, `_1`, ...), and the new name of each, so that no name of a caller's column meets an operator's own.

    `result.toDF(*docs.columns)` gives the names back.
    """
    names = [f"_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def only(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that columns of any other name, clashing or not, never meet an operator's own."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])
