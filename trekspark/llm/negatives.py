"""Hard negatives by distributed radix selection.

Vectors are made whole numbers, so a score, the inner product of two, is a whole number too. Anchors are a stated set
of rows; each anchor meets all rows, blocks of anchors against groups of rows that stream through a task. A window is a range of
scores of one anchor, of which the first k rows are wanted. In each pass tasks count the window's rows by the leading
digit of their distance from its upper end; the summed histogram tells the digit that holds the kth row, which the next
pass divides by the next digit, until that digit's rows are few or of one score. Then rows from there on are gathered, and
nothing else is: no task or window ever holds all its rows.

Rows of the kth score itself may be many (a vector that a third of all rows hold). Each task keeps its k smallest ids of
them per window, which loses none of the first k.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import only, stored

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
#: Bits of a digit, rows of the kth row's digit that are gathered without dividing it further, and the largest score that doubles hold exactly.
DIGIT, FEW, EXACT = 8, 64, 1 << 53
#: Anchors of a block, scores computed at a time in a task, and groups of rows at most (more tasks come from more blocks).
ANCHORS, CELLS, GROUPS = 4096, 1 << 21, 64

ROWS = "block int, part int, kind int, id long, slot long, label long, q array<int>, hi long, lo long, same boolean"


def whole(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, q, norm (sum of squares) of the rows that take part, one row an id: its smallest by label and vector."""
    x = F.col("embedding")
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    one = only(rows, "vec_id", "embedding", "label").filter(fit).select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").cast("long").alias("label"), q.alias("q")).alias("row"))
    one = one.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.q")
    norm = F.aggregate("q", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    return one.withColumn("norm", norm)


class Block:
    """The windows of a block of anchors, by the dimension of their vectors."""

    def __init__(self, table: pa.Table):
        ids, slots, labels, hi, lo = (table[c].to_numpy() for c in ("id", "slot", "label", "hi", "lo"))
        same = table["same"].to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(table["q"]).to_numpy()
        self.by_size = {}
        self.ids, self.slots = ids, slots
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            anchors, first, where = np.unique(ids[own], return_index=True, return_inverse=True)
            rank = np.zeros(len(own), np.int64)  # place of a window among its anchor's
            order = np.argsort(where, kind="stable")
            starts = np.searchsorted(where[order], where[order])
            rank[order] = np.arange(len(own)) - starts
            wide = int(rank.max()) + 1
            window = np.full((len(anchors), wide), -1)
            low, high = np.ones((len(anchors), wide)), np.zeros((len(anchors), wide))
            window[where, rank], low[where, rank], high[where, rank] = own, lo[own], hi[own]
            low[window < 0], high[window < 0] = np.inf, -np.inf
            lists = table["q"].combine_chunks().take(pa.array(own[first]))
            matrix = lists.flatten().to_numpy().astype(float).reshape(len(anchors), size)
            self.by_size[size] = (anchors, labels[own][first], same[own][first], matrix, window, low, high)

    def hits(self, batch: pa.RecordBatch):
        """(windows, ids, scores, distances from the windows' upper ends) of the rows of a batch that lie in a window, CELLS scores at a time."""
        sizes = pc.list_value_length(batch["q"]).to_numpy()
        row_ids, row_labels = batch["id"].to_numpy(), batch["label"].to_numpy()
        for size, (anchors, labels, same, matrix, window, low, high) in self.by_size.items():
            own = np.flatnonzero(sizes == size)
            step = max(1, CELLS // max(1, len(anchors)))
            for at in range(0, len(own), step):
                rows = own[at : at + step]
                vectors = batch["q"].take(pa.array(rows)).flatten().to_numpy().astype(float).reshape(len(rows), size)
                scores = matrix @ vectors.T
                alike = labels[:, None] == row_labels[rows][None, :]
                fit = (alike == same[:, None]) & (scores >= low.min(1)[:, None]) & (scores <= high.max(1)[:, None])
                a, r = np.nonzero(fit)
                score = scores[a, r]
                for w in range(window.shape[1]):
                    inside = (score >= low[a, w]) & (score <= high[a, w]) & (anchors[a] != row_ids[rows][r])
                    who, row, value = a[inside], r[inside], score[inside]
                    yield window[who, w], row_ids[rows][row], value.astype(np.int64), (high[who, w] - value).astype(np.int64)


def _streamed(batches, add, done):
    """Calls add(block, state, batch) for each batch of rows behind its block's windows, and yields done(block, state) when a block's rows end."""
    held, block, state, name = [], None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch["block"].to_numpy(), batch["part"].to_numpy(), batch["kind"].to_numpy()])
        edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows]):
            piece, (n, p, kind) = batch.slice(a, b - a), key[:, a].tolist()
            if (n, p) != name:
                if state is not None:
                    yield done(block, state)
                held, block, state, name = [], None, None, (n, p)
            if kind == 0:
                held.append(piece)
            else:
                if block is None and held:
                    block, state, held = Block(pa.Table.from_batches(held)), {}, []
                if block is not None:
                    add(block, state, piece)
    if state is not None:
        yield done(block, state)


def _dealt(rows: DataFrame, windows: DataFrame, blocks: int, groups: int) -> DataFrame:
    """Each block of windows, then the rows of a group, in one partition for each block and group."""
    nothing = F.lit(None)
    left = windows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select("block", "part", F.lit(0).alias("kind"), "id", "slot", "label", "q", "hi", "lo", "same")
    right = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("block", "part", F.lit(1).alias("kind"), F.col("vec_id").alias("id"), nothing.cast("long").alias("slot"), "label", "q", nothing.cast("long").alias("hi"), nothing.cast("long").alias("lo"), nothing.cast("boolean").alias("same"))
    return left.unionByName(right).repartitionById(blocks * groups, F.col("block") * groups + F.col("part")).sortWithinPartitions("block", "part", "kind")


def histograms(rows: DataFrame, windows: DataFrame, blocks: int, groups: int, shift: int) -> DataFrame:
    """id, slot, digit, n: how many rows of a window have each digit of their distance from its upper end."""
    digits = 1 << DIGIT

    def add(block, state, batch):
        total = state.setdefault("n", np.zeros(len(block.ids) * digits, np.int64))
        for window, _, _, far in block.hits(batch):
            total += np.bincount(window * digits + (far >> shift), minlength=len(total))

    def done(block, state):
        full = np.flatnonzero(state["n"])
        w = full // digits
        return pa.RecordBatch.from_arrays([pa.array(block.ids[w]), pa.array(block.slots[w]), pa.array((full % digits).astype(np.int64)), pa.array(state["n"][full])], names=["id", "slot", "digit", "n"])

    counts = _dealt(rows, windows, blocks, groups).mapInArrow(lambda b: _streamed(b, add, done), "id long, slot long, digit long, n long")
    return counts.groupBy("id", "slot", "digit").agg(F.sum("n").alias("n"))


def gathered(rows: DataFrame, windows: DataFrame, blocks: int, groups: int, k: int) -> DataFrame:
    """id, slot, rank, other, score: the first k rows of each window, by score and then id."""

    def add(block, state, batch):
        for window, ids, score, _ in block.hits(batch):
            if "w" in state:
                window, ids, score = (np.concatenate([state[c], x]) for c, x in (("w", window), ("id", ids), ("s", score)))
            order = np.lexsort((ids, -score, window))
            window, ids, score = window[order], ids[order], score[order]
            keep = np.arange(len(window)) - np.searchsorted(window, window) < k
            state["w"], state["id"], state["s"] = window[keep], ids[keep], score[keep]

    def done(block, state):
        w = state.get("w", np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays([pa.array(block.ids[w]), pa.array(block.slots[w]), pa.array(state.get("id", w)), pa.array(state.get("s", w))], names=["id", "slot", "other", "score"])

    found = _dealt(rows, windows, blocks, groups).mapInArrow(lambda b: _streamed(b, add, done), "id long, slot long, other long, score long")
    rank = F.row_number().over(Window.partitionBy("id", "slot").orderBy(F.desc("score"), "other"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def first_of(rows: DataFrame, windows: DataFrame, blocks: int, groups: int, k: int, span: int) -> DataFrame:
    """id, slot, rank, other, score of the first k rows of each window (block, id, slot, label, q, hi, lo, same), whose ranges are at most `span` wide."""
    places = windows.select("id", "slot", F.col("lo").alias("least"))
    open_, settled = windows.select("id", "slot", "hi", "lo", F.lit(k).cast("long").alias("need")), None
    shift = max(0, span.bit_length() - DIGIT)
    frame = windows.drop("hi", "lo")
    while True:
        seen = histograms(rows, frame.join(open_.drop("need"), ["id", "slot"]), blocks, groups, shift)
        upto = F.sum("n").over(Window.partitionBy("id", "slot").orderBy("digit"))  # at most a digit's values
        at = open_.join(seen, ["id", "slot"]).withColumn("upto", upto).filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
        width = 1 << shift
        top = F.col("hi") - F.col("digit") * width
        at = stored(at.select("id", "slot", top.alias("hi"), F.greatest("lo", top - width + 1).alias("lo"), (F.col("need") - F.col("upto") + F.col("n")).alias("need"), "n"), "digits")
        settled = at.select("id", "slot", "lo") if settled is None else settled.unionByName(at.select("id", "slot", "lo"))
        if shift == 0:
            break
        open_ = at.filter(F.col("n") > FEW).drop("n")
        if open_.isEmpty():
            break
        shift = max(0, shift - DIGIT)
    # Each pass raises a window's lower end; windows with fewer than k rows keep theirs.
    ends = places.join(settled.groupBy("id", "slot").agg(F.max("lo").alias("reached")), ["id", "slot"], "left").select("id", "slot", F.coalesce("reached", "least").alias("lo"))
    return gathered(rows, windows.drop("lo").join(ends, ["id", "slot"]), blocks, groups, k)


def mine(rows: DataFrame, anchor: Column, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the rows (vec_id, embedding, label) that `anchor` (a condition on vec_id) names.

    A row's score is its whole-number inner product with the anchor. Positives are the anchor's first `positives` other rows of
    its label; negatives the first `negatives` rows of other labels with low * positive <= 100 * negative <= high * positive.
    Ties go to the smaller id. Rows without id, label or vector, or with a missing or endless component, take no part; rows that repeat an
    id count once, by the smallest label and vector. Vectors meet those of their own length alone; empty ones score 0.
    Anchors without positives, and positives without negatives, give no rows, as does an empty table. Scores that
    don't fit 53 bits are refused. Other columns aren't read.
    """
    groups = min(GROUPS, max(4, rows.sparkSession.sparkContext.defaultParallelism))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    kept = stored(whole(rows, scale).withColumn("part", part), "vectors")
    known = kept.agg(F.max("norm").alias("norm"), F.sum(anchor.cast("long")).alias("anchors")).first()
    bound = int(known["norm"] or 0)
    if bound >= EXACT:
        raise ValueError("inner products don't fit 53 bits; give a smaller scale")
    blocks = max(1, -(-(known["anchors"] or 0) // ANCHORS))
    kept = kept.select("part", "vec_id", "label", F.col("q").cast("array<int>").alias("q"))
    block = F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.lit(blocks)).cast("int").alias("block")
    anchors = kept.filter(anchor).select(block, F.col("vec_id").alias("id"), "label", "q")
    around = anchors.select("*", F.col("id").alias("slot"), F.lit(bound).cast("long").alias("hi"), F.lit(-bound).cast("long").alias("lo"), F.lit(True).alias("same"))
    near = stored(first_of(kept, around, blocks, groups, positives, 2 * bound), "positives")
    upper, lower = F.expr(f"CAST(floor({high} * CAST(score AS DECIMAL(20)) / 100) AS LONG)"), F.expr(f"CAST(ceil({low} * CAST(score AS DECIMAL(20)) / 100) AS LONG)")
    pairs = near.select("id", F.col("other").alias("slot"), F.col("score").alias("positive_score"), upper.alias("hi"), lower.alias("lo")).filter("hi >= lo")
    beyond = anchors.join(pairs.drop("positive_score"), "id").withColumn("same", F.lit(False))
    far = first_of(kept, beyond, blocks, groups, negatives, 2 * bound)
    named = far.select(F.col("id").alias("anchor_id"), F.col("slot").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    scores = pairs.select(F.col("id").alias("anchor_id"), F.col("slot").alias("positive_id"), "positive_score")
    return named.join(scores, ["anchor_id", "positive_id"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
