"""Target-distribution importance resampling over hashed runs of words.

Each bounded batch of texts becomes one stream of word ids with a gap after each text. Its suffix array, sorted to the depth
of the longest run, brings equal runs of words together: where neighbouring suffixes share at least k words (their LCP),
they begin with the same run of k words. Such a run is hashed once, however often it occurs, and its bucket is scattered
back to its occurrences. Each text keeps the buckets of all its features, so words are read and hashed once; counts
and scores are taken from the stored buckets.

What crosses tasks is at most one count a bucket and task, and for the ranks one count a score: scores are whole numbers of
thousandths of logarithms, so there are tens of thousands of different ones at most, whatever the corpus.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, only, stored, texts_of

BUCKETS, LONGEST, LEAST_WORDS, SHARE, SEED = 10_000, 1, 20, 10, 2024

#: Lower case for A-Z alone; bytes of words: digits, letters, and all bytes beyond ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(ids of all texts' words in order, words of each text, the different words by id). Words never cross texts."""
    own = texts.cast(pa.binary()).to_pylist()
    data = _LOWER[np.frombuffer(b"\n".join([*own, b""]), np.uint8)]
    inside = _INSIDE[data]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8)]))
    first = np.flatnonzero(edge == 1)
    letters = data[inside]
    upto = np.concatenate([[0], np.cumsum(inside)])
    offsets = np.append(upto[first], len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())]).dictionary_encode()
    ends = np.cumsum([len(t) + 1 for t in own])
    counts = np.diff(np.concatenate([[0], np.searchsorted(first, ends)]))
    return words.indices.to_numpy().astype(np.int64), counts, words.dictionary.to_pylist()


def suffix_array(ids: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the words in the order of their suffixes' first `depth` words, LCP with the suffix before, at most `depth`).

    A text's end ends its suffixes and sorts before any word; no LCP reaches beyond it.
    """
    room = np.repeat(np.cumsum(counts), counts) - np.arange(len(ids))  # words from here to the text's end
    ahead = lambda k: np.where(room > k, np.append(ids[k:], np.full(min(k, len(ids)), -1)), -1) if k else ids
    columns = [ahead(k) for k in range(depth)]
    order = np.lexsort(columns[::-1]) if depth > 1 else np.argsort(ids, kind="stable")
    lcp, equal = np.zeros(len(ids), np.int64), np.ones(max(0, len(ids) - 1), bool)
    for column in columns:
        sorted_column = column[order]
        equal &= (sorted_column[1:] == sorted_column[:-1]) & (sorted_column[1:] >= 0)
        lcp[1:] += equal
    return order, lcp


def features(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(buckets of all features, text by text and run length by run length, features of each text, words of each text, runs hashed)."""
    ids, counts, words = word_ids(texts)
    order, lcp = suffix_array(ids, counts, longest)
    room = np.repeat(np.cumsum(counts), counts) - np.arange(len(ids))
    text = np.repeat(np.arange(len(counts)), counts)
    found, owner, hashed = [], [], 0
    for k in range(1, longest + 1):
        whole = room[order] >= k  # suffixes that have k words; those of one run stand together
        places = order[whole]
        begins = np.flatnonzero(lcp[whole] < k)  # too short suffixes sort before all that begin alike, so a run begins where LCP < k
        runs = [zlib.crc32(b" ".join([words[j] for j in ids[p : p + k].tolist()])) % buckets for p in places[begins].tolist()]
        hashed += len(runs)
        own = np.zeros(len(ids), np.int64)
        own[places] = np.repeat(np.array(runs, np.int64), np.diff(np.append(begins, len(places))))
        found.append(own[room >= k])
        owner.append(text[room >= k])
    owners = np.concatenate(owner)
    return np.concatenate(found)[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(counts)), counts, hashed


def bucketed(texts: DataFrame, key: str, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """key, n_words, features (their buckets as packed little-endian 32-bit integers) of each row of key, text."""
    kind = texts.schema[key].dataType.simpleString()

    def run(batches):
        for batch in bounded(batches):
            found, n, words, _ = features(texts_of(batch), longest, buckets)
            at = np.concatenate([[0], np.cumsum(n)]) * 4
            packed = found.astype("<u4").tobytes()
            rows = pa.array([packed[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words.astype(np.int64)), rows], names=[key, "n_words", "features"])

    return only(texts, key, "text").mapInArrow(run, f"`{key}` {kind}, n_words long, features binary")


def counted(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket. Each task sends at most one row a bucket, and `buckets` rows reach the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(packed, "<u4"), minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["bucket", "n"])

    table = rows.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of the B buckets."""
    s_all, t_all, b = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + b) / ((s + 1) * (t_all + b)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighed(rows: DataFrame, key: str, gain: np.ndarray) -> DataFrame:
    """key, n_words, n_features, weight: the floored mean gain of a row's features, 0 if it has none."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n, weight = [], []
            for packed in batch.column(2).to_pylist():
                own = np.frombuffer(packed, "<u4")
                n.append(len(own))
                weight.append(int(shared.value[own].sum()) // len(own) if len(own) else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(weight, pa.int64())], names=[key, "n_words", "n_features", "weight"])

    return rows.select(key, "n_words", "features").mapInArrow(run, f"`{key}` {kind}, n_words long, n_features long, weight long")


def drawn(rows: DataFrame, share: int = SHARE, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of rows with doc_id, n_words, n_features, weight.

    The score adds Gumbel noise from a hash of the id, so the highest scores are a sample without replacement by weight.
    Of the N rows with `least` words and an id, floor(share * N / 100) get ranks. Rows before a score are
    known from the counts of scores, so a row is ranked among the rows of its own score alone, equal rows counted first.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = stored(rows.withColumn("score", F.col("weight") + noise), "scored")
    fit = (F.col("n_words") >= least) & F.col("score").isNotNull()
    counts = rows.filter(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow()  # one row a score
    order = np.argsort(-counts["score"].to_numpy())
    score, n = counts["score"].to_numpy()[order], counts["n"].to_numpy()[order]
    before = np.cumsum(n) - n
    take = share * int(n.sum()) // 100
    reach = before < take
    spark = rows.sparkSession
    places = spark.createDataFrame(pa.table({"_score": score[reach].astype(np.int64), "_before": before[reach].astype(np.int64)}))
    same = rows.filter(fit).join(F.broadcast(places), F.col("score") == F.col("_score")).groupBy("score", "_before", "doc_id", "n_features", "weight").agg(F.count(F.lit(1)).alias("_copies"))
    own = Window.partitionBy("score").orderBy("doc_id", "n_features", "weight").rowsBetween(Window.unboundedPreceding, -1)
    last = F.col("_before") + F.coalesce(F.sum("_copies").over(own), F.lit(0)) + F.col("_copies")
    chosen = same.withColumn("_last", last).withColumn("rank", F.explode(F.sequence(F.col("_last") - F.col("_copies") + 1, "_last")))
    chosen = chosen.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    rest = rows.filter(~fit | (F.col("score") < (int(score[reach][-1]) if take else 1 << 62))).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return chosen.select(*columns).unionByName(rest.select(*columns))


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, share: int = SHARE, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of docs (doc_id, text), drawn towards the texts of target (item_id, text).

    Features are all runs of 1 to `longest` words. Null and empty texts have none: weight 0. Texts with fewer than `least`
    words are scored, but never drawn. A null id has no noise: score and rank are null. Repeated rows are scored and drawn each
    by itself and stand next to each other. An empty corpus gives no rows; an empty target gives the same formula with no
    counts. Ties in score go to the smaller id. Other columns aren't read.
    """
    rows = stored(bucketed(docs, "doc_id", longest, buckets), "buckets")
    gain = gains(counted(rows, buckets), counted(bucketed(target, "item_id", longest, buckets), buckets))
    return drawn(weighed(rows, "doc_id", gain), share, least, seed)


def sample(docs: DataFrame, target: DataFrame, **settings: int) -> DataFrame:
    """The rows of docs whose ids are drawn, with all their columns, whatever they are called; rows of one id are drawn together."""
    from .common import numbered

    rows, names = numbered(docs)
    ranks = resample(docs, target, **settings).filter("rank IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct()
    return rows.join(ranks, F.col(names["doc_id"]) == F.col("_id"), "left_semi").toDF(*docs.columns)
