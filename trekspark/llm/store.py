"""Content-addressed store of token ids.

Rolling hashes over the ids cut each document's stream into chunks, so equal passages give equal chunks wherever they
stand. A chunk is named by the BLAKE2b digest of its ids and stored once; a document is a recipe of digests with a
Merkle root over them, and each recipe file has a Merkle root over its documents in the manifest.

Layout below a path: stored/kind=1 (chunks by digest: n, payload: zstandard over little-endian ids of `width` bytes),
stored/kind=0 (recipes as they were cut), recipes/ (files in ascending doc_id order: part, doc_id, start, n_tokens,
digests, lens, root), manifest/ (part, first_start, documents, tokens, root).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, only, scratch, texts_of
from .tokens import encoder, with_end

WINDOW, LEAST, MOST, MEAN_BITS = 8, 96, 2048, 9
#: Documents of a recipe file.
PART_ROWS = 1_000_000
#: Merkle leaves and inner nodes are hashed under different prefixes.
LEAF, NODE = b"\x00", b"\x01"


def digest_of(ids: bytes) -> bytes:
    return hashlib.blake2b(ids, digest_size=16).digest()


def merkle(leaves: Iterable[bytes]) -> bytes:
    """Root over the leaves; an odd node goes up unchanged, no leaves give the digest of nothing."""
    level = [digest_of(LEAF + x) for x in leaves] or [digest_of(b"")]
    while len(level) > 1:
        level = [digest_of(NODE + b"".join(level[i : i + 2])) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def cut_points(ids: np.ndarray, at: np.ndarray) -> list[list[int]]:
    """Ends of each document's chunks. An end depends on the WINDOW ids before it and on the chunk's own start alone."""
    x = ids.astype(np.uint64) + np.uint64(1)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    h = x.copy()
    for k in range(1, WINDOW):
        h[k:] += x[:-k] << np.uint64(k) if k < len(x) else np.uint64(0)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    hits = np.flatnonzero(h >> np.uint64(64 - MEAN_BITS) == 0) + 1
    first = np.searchsorted(hits, at)
    hits, out = hits.tolist(), []
    for d, (lo, hi) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        ends, last = [], lo
        for e in [*hits[first[d] : first[d + 1]], hi]:
            if e != hi and (e - last < LEAST or e >= hi):
                continue
            while e - last > MOST:
                last += MOST
                ends.append(last)
            if e > last:
                ends.append(e)
                last = e
        out.append(ends)
    return out


STAGED = "kind int, doc_id long, n long, digests array<binary>, lens array<long>, root binary, payload binary"
STORED = "doc_id long, n long, digests array<binary>, lens array<long>, root binary, payload binary, rows long, kind int"


def cut_chunks(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> DataFrame:
    """One row of kind 0 per document (its recipe) and of kind 1 per chunk, chunks once a batch."""

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in bounded(batches):
            ids, at = with_end(*encoder(tokenizer).batch(texts_of(batch)), end_id)
            raw = memoryview(ids.astype(f"<u{width}").tobytes())
            seen: dict[bytes, tuple[int, bytes]] = {}
            recipes, sizes, roots = [], [], []
            for lo, ends in zip(at[:-1].tolist(), cut_points(ids, at)):
                names, lens = [], []
                for e in ends:
                    part = raw[lo * width : e * width]
                    names.append(name := digest_of(part))
                    lens.append(e - lo)
                    if name not in seen:
                        seen[name] = (e - lo, squeeze.compress(part))
                    lo = e
                recipes.append(names)
                sizes.append(lens)
                roots.append(merkle(names))
            m, k = len(recipes), len(seen)
            doc = batch.column(0).cast(pa.int64())
            columns = [
                [0] * m + [1] * k,
                pa.concat_arrays([doc, pa.nulls(k, pa.int64())]),
                np.concatenate([np.diff(at), [n for n, _ in seen.values()]]).astype(np.int64),
                recipes + [[name] for name in seen],
                sizes + [None] * k,
                roots + [None] * k,
                [None] * m + [p for _, p in seen.values()],
            ]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            names = ["kind", "doc_id", "n", "digests", "lens", "root", "payload"]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return only(docs, "doc_id", "text").mapInArrow(run, STAGED)


def write_store(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, width: int = 2, parts: int | None = None) -> str:
    """Writes the store of all rows and returns its path.

    A null text counts as empty and is stored as the end id alone; repeated rows get a recipe each and share chunks; a null
    doc_id sorts first; an empty table gives empty folders; other columns aren't read. `width` is 2 for vocabularies
    of at most 65,536 ids, else 4; a width too small for the vocabulary raises.
    """
    spark = docs.sparkSession
    if max(encoder(tokenizer).whole.get_vocab_size() - 1, end_id) >> (8 * width):
        raise ValueError(f"ids of {tokenizer} don't fit in {width} bytes")
    staged = cut_chunks(docs, tokenizer, end_id, width).withColumn("key", F.coalesce("root", F.col("digests")[0]))
    # One shuffle for both kinds: chunks meet by digest, recipes by document and root, where repeated rows are counted.
    once = staged.groupBy("kind", "doc_id", "key").agg(*[F.first(c).alias(c) for c in ("n", "digests", "lens", "root", "payload")], F.count(F.lit(1)).alias("rows"))
    once.drop("key").write.option("compression", "uncompressed").partitionBy("kind").parquet(f"{path}/stored")
    read = spark.read.schema(STORED).parquet(f"{path}/stored").filter("kind = 0")
    if not parts:  # a part's entries are worked by one task
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(read.agg(F.sum("rows")).first()[0] or 0) // PART_ROWS))
    again = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))
    ordered = read.select("doc_id", F.col("n").alias("n_tokens"), "digests", "lens", "root", again.alias("row")).drop("row").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "root")
    ordered = ordered.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
    ordered.write.parquet(f"{path}/ordered")
    ordered = spark.read.schema(ordered.schema).parquet(f"{path}/ordered")
    totals = ordered.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))  # a row per part
    before = totals.select(F.col("part").alias("of"), F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    recipes = ordered.withColumn("inside", inside).join(F.broadcast(before), F.col("part") == F.col("of")).withColumn("start", F.col("before") + F.col("inside"))
    recipes.select("part", "doc_id", "start", "n_tokens", "digests", "lens", "root").sortWithinPartitions("part", "start").write.parquet(f"{path}/recipes")
    _manifest(read_recipes(spark, path)).write.parquet(f"{path}/manifest")
    _remove(spark.sparkContext, f"{path}/ordered")
    return path


def _remove(sc: SparkContext, path: str) -> None:
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


RECIPE = "part int, doc_id long, start long, n_tokens long, digests array<binary>, lens array<long>, root binary"


def read_recipes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECIPE).parquet(f"{path}/recipes")


def read_chunks(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """Stored chunks with their ids (little-endian unsigned 32-bit), checked against their names; a damaged one raises."""

    def run(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in bounded(batches, "payload"):
            names, ids = batch.column(0).to_pylist(), []
            for name, n, payload in zip(names, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = open_.decompress(payload, max_output_size=n * width)
                if digest_of(raw) != name or len(raw) != n * width:
                    raise ValueError(f"chunk {name.hex()} is damaged")
                ids.append(np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["digest", "n", "ids"])

    chunks = spark.read.schema(STORED).parquet(f"{path}/stored").filter("kind = 1").select(F.col("digests")[0].alias("digest"), "n", "payload")
    return chunks.mapInArrow(run, "digest binary, n long, ids binary")


def _manifest(recipes: DataFrame) -> DataFrame:
    def roots(table: pa.Table) -> pa.Table:
        table = table.sort_by("start")
        return pa.table({"part": table["part"][:1], "first_start": table["start"][:1], "documents": pa.array([table.num_rows]), "tokens": pa.array([sum(table["n_tokens"].to_pylist())]), "root": pa.array([merkle(table["root"].to_pylist())], pa.binary())})

    return recipes.select("part", "start", "n_tokens", "root").groupBy("part").applyInArrow(roots, "part int, first_start long, documents long, tokens long, root binary")


def verify(spark: SparkSession, path: str) -> DataFrame:
    """Parts whose recipes don't give the manifest's root, documents, tokens and first place, or that only one of both has; none if all is well."""
    now = _manifest(_checked(read_recipes(spark, path)))
    whole = F.struct(*now.columns[1:])
    written = spark.read.schema(now.schema).parquet(f"{path}/manifest").select("part", whole.alias("written"))
    return now.select("part", whole.alias("now")).join(written, "part", "full").filter(~F.col("now").eqNullSafe(F.col("written"))).select("part")


def _check(recipes: pa.RecordBatch) -> None:
    for names, root in zip(recipes.column("digests").to_pylist(), recipes.column("root").to_pylist()):
        if merkle(names) != root:
            raise ValueError("a recipe doesn't give its Merkle root")
    count = pc.list_value_length(recipes.column("lens")).to_numpy()
    at = np.concatenate([[0], np.cumsum(count)])
    ends = np.concatenate([[0], np.cumsum(recipes.column("lens").flatten().to_numpy())])
    if (count != pc.list_value_length(recipes.column("digests")).to_numpy()).any() or (np.diff(ends[at]) != recipes.column("n_tokens").to_numpy()).any():
        raise ValueError("a recipe's chunk lengths don't give its number of ids")


def _checked(recipes: DataFrame) -> DataFrame:
    """The same recipes; raises where a root isn't that of the digests."""

    def run(batches):
        for batch in batches:
            _check(batch)
            yield batch

    return recipes.mapInArrow(run, recipes.schema)


ENTRIES = "doc_id long, start long, n_tokens long, chunks int, pos int, digest binary, n long, behind long"


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """A row per document and chunk of the recipes, checked against their roots, with the number of ids that follow the chunk in its document."""

    def run(batches):
        for batch in batches:
            _check(batch)
            lens = batch.column("lens")
            count = pc.list_value_length(lens).to_numpy()
            row = pa.array(np.repeat(np.arange(len(count)), count))
            n = lens.flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(n)])
            behind = np.repeat(ends[np.cumsum(count)], count) - ends[1:]
            pos = np.arange(len(n)) - np.repeat(np.cumsum(count) - count, count)
            columns = [batch.column(c).take(row) for c in ("doc_id", "start", "n_tokens")]
            columns += [pa.array(np.repeat(count, count).astype(np.int32)), pa.array(pos.astype(np.int32)), batch.column("digests").flatten(), pa.array(n), pa.array(behind)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "chunks", "pos", "digest", "n", "behind"])

    return read_recipes(spark, path).mapInArrow(run, ENTRIES)


def reconstruct(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of every document, joined from its chunks."""
    entries = _entries(spark, path).drop("n", "behind")
    joined = entries.join(read_chunks(spark, path, width).drop("n"), "digest", "left").withColumn("ids", F.coalesce("ids", F.raise_error(F.lit("a chunk is missing")).cast("binary")))
    parts = joined.groupBy("doc_id", "start", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("pos", "ids"))).alias("parts"))
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return parts.select("doc_id", "start", "n_tokens", ids.alias("ids"))


def _steps() -> np.ndarray:
    """steps[k][b][v]: what byte b of value v of a crc32 becomes behind 2**k further zero bytes."""
    one = np.array([zlib.crc32(b"\0", 1 << i) ^ zlib.crc32(b"\0") for i in range(32)], np.uint32)
    out = np.zeros((48, 4, 256), np.uint32)
    for k in range(48):
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        for b in range(4):
            out[k, b] = np.bitwise_xor.reduce(np.where(bits, one[8 * b : 8 * b + 8], 0).astype(np.uint32), axis=1)
        one = _step(out[k], one)
    return out


def _step(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


def shifted(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Each crc32's part in the crc32 of a string that goes on for zeros[i] bytes: these parts' exclusive or is the whole's."""
    out, steps = crc.astype(np.uint32), _steps()
    for k in range(int(zeros.max(initial=0)).bit_length()):
        on = (zeros >> k) & 1 == 1
        out[on] = _step(steps[k], out[on])
    return out


def checksums(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone.

    Every stored chunk is read, checked and summed once; a document's crc32 is put together from its chunks' (crc32 is
    linear), so no payload is shuffled. Recipes are checked against their Merkle roots and numbers of ids on the way, and
    before that the parts against the manifest. What is damaged or missing raises.
    """
    if bad := [row.part for row in verify(spark, path).limit(10).collect()]:
        raise ValueError(f"parts {bad} don't give the manifest's entries")

    def sums(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([zlib.crc32(x) for x in batch.column(2).to_pylist()], pa.int64())], names=["digest", "stored_n", "crc"])

    def place(batches):
        for batch in batches:
            crc = batch.column("crc").to_numpy().astype(np.uint32)
            part = shifted(crc, batch.column("behind").to_numpy() * 4).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(part)], names=["doc_id", "start", "n_tokens", "chunks", "part_crc"])

    stored = read_chunks(spark, path, width).mapInArrow(sums, "digest binary, stored_n long, crc long")
    crc = F.when(F.col("n") == F.col("stored_n"), F.col("crc")).otherwise(F.raise_error(F.lit("a chunk is missing")).cast("long"))
    joined = _entries(spark, path).join(stored, "digest", "left").select("doc_id", "start", "n_tokens", "chunks", crc.alias("crc"), "behind")
    parts = joined.mapInArrow(place, "doc_id long, start long, n_tokens long, chunks int, part_crc long")
    whole = parts.groupBy("doc_id", "start", "n_tokens", "chunks").agg(F.bit_xor("part_crc").alias("ids_crc32"), F.count(F.lit(1)).alias("found"))
    complete = F.when(F.col("found") == F.col("chunks"), F.col("ids_crc32")).otherwise(F.raise_error(F.lit("a chunk is missing")).cast("long"))
    return whole.select("doc_id", "start", "n_tokens", complete.alias("ids_crc32"))


def content_addressed(docs: DataFrame, tokenizer: str, end_id: int = 2, width: int = 2) -> DataFrame:
    """Writes the store of all rows into the scratch folder and returns checksums() of what is read back."""
    spark = docs.sparkSession
    return checksums(spark, write_store(docs, tokenizer, scratch(spark, "store"), end_id, width), width)
