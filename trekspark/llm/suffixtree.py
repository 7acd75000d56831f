"""Language model scoring by a probabilistic suffix tree over bytes.

The tree is learned from counts of every (DEPTH + 1)-gram of the training texts. A context is retained if it occurs LEAST
times at least, however large the corpus, and its next-symbol distribution diverges from that of the context one symbol
shorter. Distributions are smoothed towards the shorter context's, which weighs PRIOR times the different symbols seen. A text is scored by always predicting from the longest
retained suffix of what came before. The contexts grow with the corpus, so they are never gathered: each block of text sends
its different grams, packed by the last CUT symbols of their contexts, to the tasks that hold these contexts, which merge all blocks'
counts, retain contexts, and send each block the probabilities of its own grams. Lists of TOGETHER blocks are combined on the way there
and parted on the way back, so a task meets each different gram a few times, not once a block. Contexts shorter than CUT are the same for all
such tasks; their grams are a table that the alphabet bounds. Words and their counts travel in the same way.

A text's symbols are its words' bytes, A-Z in lower case, each word closed by a space, and one end, so the model is a distribution over word sequences like the base it stands beside.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, crc_bucket, only, stored, texts_of

DEPTH, LEAST, DIVERGENCE, PRIOR = 6, 2, 0.5, 6.0
BITS = 8
SEGMENT = 256
BLOCK_BYTES = 4 << 20
#: Context symbols by which grams find their task, and blocks whose lists are combined before they meet there.
CUT, TOGETHER = 3, 512


def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """(symbol of each byte, log10 of a byte's share in its symbol). Symbol 0 is the end; each byte has a symbol of its own, but A-Z have those of a-z."""
    own = [b for b in range(256) if not 65 <= b <= 90]
    symbol = np.zeros(256, np.uint8)
    symbol[own] = np.arange(1, len(own) + 1)
    symbol[65:91] = symbol[97:123]
    assert len(own) < 1 << BITS and BITS * (DEPTH + 1) < 64
    return symbol, np.zeros(256)


SYMBOL, INSIDE = _alphabet()
COUNT = int(SYMBOL.max()) + 1


def tidy(texts: pa.Array) -> pa.Array:
    """The texts with one space for each run of white space between words, and none around them; what stream() and words_of() read."""
    return pc.utf8_trim(pc.replace_substring_regex(texts, r"[\x09-\x0D ]+", " "), " ")


def stream(clean: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all tidy texts, log10 shares inside their symbols, offsets). Each text begins with DEPTH end symbols and closes with one."""
    clean = pc.if_else(pc.equal(clean, ""), "", pc.binary_join_element_wise(clean, " ", ""))
    clean = clean.cast(pa.binary())
    n = pc.binary_length(clean).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = np.frombuffer(b"".join(clean.to_pylist()), np.uint8)
    at = np.concatenate([[0], np.cumsum(n + DEPTH + 1)])
    out, share = np.zeros(int(at[-1]), np.uint8), np.zeros(int(at[-1]), np.float32)
    to = np.repeat(at[:-1] + DEPTH - (np.cumsum(n) - n), n) + np.arange(len(raw))
    out[to], share[to] = SYMBOL[raw], INSIDE[raw]
    return out, share, at


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return stream(tidy(texts))


def words_of(clean: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets of each tidy text's words, the words' codes, the different words), A-Z in lower case."""
    parts = pc.split_pattern(pc.ascii_lower(clean), " ")
    at = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary
    keep = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[codes] if len(codes) else np.zeros(0, bool)
    return np.concatenate([[0], np.cumsum(keep)])[at - at[0]], codes[keep], words


def codes_of(s: np.ndarray) -> np.ndarray:
    """The (DEPTH + 1)-gram that begins at each symbol, oldest symbol in the highest bits."""
    code = np.zeros(len(s) - DEPTH if len(s) > DEPTH else 0, np.int64)
    for k in range(DEPTH + 1):
        code |= s[k : k + len(code)].astype(np.int64) << (BITS * (DEPTH - k))
    return code


def tidy_grams(clean: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The different (DEPTH + 1)-grams of tidy texts and their counts."""
    s, _, at = stream(clean)
    code = codes_of(s)
    inside = np.ones(len(code), bool)
    for k in range(1, DEPTH + 1):  # a gram's last symbol must be a predicted one, not the padding before the next text
        cut = at[1:-1] - k
        inside[cut[cut < len(code)]] = False
    return np.unique(code[inside], return_counts=True)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return tidy_grams(tidy(texts))


def last_symbols(clean: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The different last CUT symbols of the (DEPTH + 1)-grams of tidy texts and their counts."""
    s, _, at = stream(clean)
    code = np.zeros(max(0, len(s) - CUT + 1), np.uint32)
    for k in range(CUT):
        code = (code << BITS) | s[k : k + len(code)]
    inside = np.ones(len(s), bool)
    for k in range(DEPTH):
        inside[at[:-1] + k] = False
    code, n = np.unique(code[inside[CUT - 1 :]], return_counts=True)
    return code.astype(np.int64), n


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def released(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def by_task(code: np.ndarray, tasks: int) -> np.ndarray:
    """Number of the task of each gram, by the last CUT symbols of its context."""
    ctx = (code >> BITS) & ((1 << (BITS * CUT)) - 1)
    return ((ctx * 2654435761 % (1 << 32)) >> 8) % tasks


def shares_of(task: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Each task and the places that go to it, in order."""
    order = np.argsort(task, kind="stable")
    names, first = np.unique(task[order], return_index=True)
    return list(zip(names.tolist(), np.split(order, first[1:])))


def short_grams(docs: DataFrame) -> DataFrame:
    """code, n of every gram of CUT symbols in rows of doc_id, text, learned: how often it occurs in the learned rows."""

    def run(batches):
        for batch in bounded(batches):
            learned, texts = batch.column(2), tidy(texts_of(batch))
            for part, times in ((texts.filter(learned), 1), (texts.filter(pc.invert(learned)), 0)):
                if len(part):
                    code, n = last_symbols(part)
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n * times)], names=["code", "n"])

    return docs.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def levels(table: DataFrame, depth: int, least: int = LEAST, divergence: float = DIVERGENCE) -> DataFrame:
    """code, n, total (of its context), p of every gram of the table (code, n) of `depth` + 1 symbols: its last symbol's probability behind the longest retained suffix of the others.

    From the empty context to the longest, each length's grams meet those one symbol shorter, which bring their counts and
    the probability so far; all that is gathered for a context are its at most COUNT next symbols.
    """
    context = Window.partitionBy("ctx")
    below = None
    for d in range(depth + 1):
        low = (1 << (BITS * (d + 1))) - 1
        level = table.groupBy(F.col("code").bitwiseAND(F.lit(low)).alias("code")).agg(F.sum("n").alias("n")) if d < depth else table.select("code", "n")
        if below is None:
            level = level.select("*", F.lit(0).cast("long").alias("n_short"), F.lit(0).cast("long").alias("total_short"), F.lit(1 / COUNT).alias("p_short"))
        else:
            short = below.select(F.col("code").alias("short"), F.col("n").alias("n_short"), F.col("total").alias("total_short"), F.col("p").alias("p_short"))
            level = level.withColumn("short", F.col("code").bitwiseAND(F.lit(low >> BITS))).join(short, "short").drop("short")
        level = level.withColumn("ctx", F.shiftright("code", BITS)).withColumn("total", F.sum("n").over(context)).withColumn("kinds", F.sum((F.col("n") > 0).cast("long")).over(context))
        if d:
            term = F.when(F.col("n") > 0, F.col("n") * F.log((F.col("n") / F.col("total")) / (F.col("n_short") / F.col("total_short")))).otherwise(0.0)
            keep = (F.col("total") >= least) & (F.sum(term).over(context) >= divergence)
        else:
            keep = F.col("total") > 0
        prior = PRIOR * F.col("kinds")
        p = F.when(keep, (F.col("n") + prior * F.col("p_short")) / (F.col("total") + prior)).otherwise(F.col("p_short"))
        below = level.select("code", "n", "total", p.alias("p"))
    return below


@dataclass
class Low:
    """The sorted grams of CUT symbols, their counts, their contexts' counts, and their probabilities."""

    code: np.ndarray
    n: np.ndarray
    total: np.ndarray
    p: np.ndarray


def probabilities(code: np.ndarray, n: np.ndarray, low: Low, least: int = LEAST, divergence: float = DIVERGENCE) -> np.ndarray:
    """Probability of each of the sorted (DEPTH + 1)-grams, given all grams of their contexts' last CUT symbols: levels() from CUT symbols of context on."""
    n_before, total_before, p_before, codes_before = low.n, low.total, low.p, low.code
    for d in range(CUT, DEPTH + 1):
        if d < DEPTH:
            own, where = np.unique(code & ((1 << (BITS * (d + 1))) - 1), return_inverse=True)
            count = np.bincount(where, n, len(own))
        else:
            own, count = code, n.astype(float)
        short = np.searchsorted(codes_before, own & ((1 << (BITS * d)) - 1))
        n_short, total_short, p_short = n_before[short], total_before[short], p_before[short]
        ctx = own >> BITS
        first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
        size = np.diff(np.append(first, len(own)))
        spread = lambda x: np.repeat(np.add.reduceat(x, first), size)  # noqa: E731  a context's grams stand together
        total, seen = spread(count), count > 0
        term = np.zeros(len(own))
        term[seen] = count[seen] * np.log((count[seen] / total[seen]) / (n_short[seen] / total_short[seen]))
        keep = (total >= least) & (spread(term) >= divergence)
        prior = PRIOR * spread(seen.astype(float))
        p = np.where(keep, (count + prior * p_short) / np.where(keep, total + prior, 1.0), p_short)
        n_before, total_before, p_before, codes_before = count, total, p, own
    return p_before


@dataclass
class Tree:
    """step[node, symbol]: next node; dist[node]: row of its longest retained suffix in logp[row, symbol] (log10)."""

    step: np.ndarray
    dist: np.ndarray
    logp: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        """log10 probability of each text. The stream is cut into segments that are walked side by side; a node depends on the last DEPTH symbols alone, so each segment warms up on those before it."""
        s, share, at = symbols(texts)
        if not len(s):
            return np.zeros(0)
        lanes = -(-len(s) // SEGMENT)
        padded = np.zeros(DEPTH + lanes * SEGMENT, np.uint8)
        padded[DEPTH : DEPTH + len(s)] = s
        view = np.lib.stride_tricks.as_strided(padded, (DEPTH + SEGMENT, lanes), (1, SEGMENT))
        node, out = np.zeros(lanes, np.int64), np.zeros((SEGMENT, lanes), np.float32)
        flat_step, flat_logp = self.step.reshape(-1), self.logp.reshape(-1)
        for i in range(DEPTH + SEGMENT):
            now = view[i].astype(np.int64)
            if i >= DEPTH:
                out[i - DEPTH] = flat_logp[self.dist[node] * COUNT + now]
            node = flat_step[node * COUNT + now].astype(np.int64)
        each = out.T.reshape(-1)[: len(s)] + share
        for k in range(DEPTH):
            each[at[:-1] + k] = 0
        return np.add.reduceat(each.astype(np.float64), at[:-1])


def _levels(table: DataFrame) -> DataFrame:
    """d, ctx, next, n: next-symbol counts of every context of each length d up to DEPTH."""
    low = lambda d: (1 << (BITS * d)) - 1
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.shiftright("code", BITS).bitwiseAND(F.lit(low(d))).alias("ctx")) for d in range(DEPTH + 1)]))
    return table.select(each.alias("x"), F.col("code").bitwiseAND(F.lit(low(1))).cast("int").alias("next"), "n").groupBy("x.d", "x.ctx", "next").agg(F.sum("n").alias("n"))


def retained(table: DataFrame, least: int = LEAST, divergence: float = DIVERGENCE) -> DataFrame:
    """d, ctx, next, n of the contexts that are frequent and diverge: n * KL(context || shorter context) is at least `divergence` nats."""
    levels = _levels(table)
    totals = levels.groupBy("d", "ctx").agg(F.sum("n").alias("total"))
    frequent = stored(levels.join(totals, ["d", "ctx"]).filter((F.col("total") >= least) | (F.col("d") == 0)), "contexts")
    up = frequent.select((F.col("d") + 1).alias("d"), F.col("ctx").alias("short"), "next", F.col("n").alias("n_short"), F.col("total").alias("total_short"))
    child = frequent.filter("d > 0").withColumn("short", F.expr(f"ctx & (shiftleft(1L, {BITS} * (d - 1)) - 1)"))
    term = F.col("n") * F.log((F.col("n") / F.col("total")) / (F.col("n_short") / F.col("total_short")))
    far = child.join(up, ["d", "short", "next"]).groupBy("d", "ctx").agg(F.sum(term).alias("gain")).filter(F.col("gain") >= divergence).select("d", "ctx")
    return frequent.join(far, ["d", "ctx"], "left_semi").union(frequent.filter("d = 0"))


def grow(rows: pa.Table) -> Tree:
    """The automaton of the retained contexts; shorter suffixes that weren't retained are passed over."""
    d, ctx, nxt, n = (rows[c].to_numpy() for c in ("d", "ctx", "next", "n"))
    counts: dict[tuple[int, int], int] = {}
    order = np.lexsort((ctx, d))
    d, ctx, nxt, n = d[order], ctx[order], nxt[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (ctx[1:] != ctx[:-1])])) if len(d) else np.zeros(0, int)
    ends = np.append(first[1:], len(d))
    p = np.full((max(1, len(first)), COUNT), 1 / COUNT)
    for row, (a, b) in enumerate(zip(first, ends)):
        length, code = int(d[a]), int(ctx[a])
        counts[length, code] = row
        short = next((counts[k, code & ((1 << (BITS * k)) - 1)] for k in range(length - 1, -1, -1) if (k, code & ((1 << (BITS * k)) - 1)) in counts), None)
        below = p[short] if short is not None else np.full(COUNT, 1 / COUNT)
        prior = PRIOR * (b - a)
        p[row] = prior * below
        np.add.at(p[row], nxt[a:b], n[a:b])
        p[row] /= n[a:b].sum() + prior
    # Nodes are the prefixes of retained contexts, as in a trie; a node's link is its longest proper suffix that is a node.
    nodes: dict[tuple[int, int], int] = {(0, 0): 0}
    children: list[dict[int, int]] = [{}]
    for length, code in counts:
        at = 0
        for k in range(1, length + 1):
            prefix = code >> (BITS * (length - k))
            if (k, prefix) not in nodes:
                nodes[k, prefix] = len(children)
                children.append({})
                children[at][prefix & ((1 << BITS) - 1)] = nodes[k, prefix]
            at = nodes[k, prefix]
    step = np.zeros((len(children), COUNT), np.int32)
    link, dist = np.zeros(len(children), np.int64), np.zeros(len(children), np.int64)
    queue = [0]
    names = {v: k for k, v in nodes.items()}
    for at in queue:
        if at:
            step[at] = step[link[at]]
        dist[at] = counts.get(names[at], dist[link[at]])
        for s, child in children[at].items():
            link[child] = step[link[at], s] if at else 0
            queue.append(child)
        for s, child in children[at].items():
            step[at, s] = child
    return Tree(step, dist, np.log10(p).astype(np.float32))


def learn(docs: DataFrame) -> Tree:
    """The tree of all rows given as one automaton in the driver's memory, for small corpora; score() doesn't build it."""

    def run(batches):
        for batch in bounded(batches):
            yield pa.RecordBatch.from_arrays(list(map(pa.array, grams(texts_of(batch)))), names=["code", "n"])

    table = only(docs, "text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return grow(retained(stored(table, "counts")).toArrow())


def located(clean: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(the tidy texts' different grams in order, how often each occurs, the places of their last symbols in that order, log10 shares of all symbols, offsets of the texts)."""
    s, share, at = stream(clean)
    own = codes_of(s)
    for k in range(1, DEPTH + 1):  # grams of two texts
        cut = at[1:-1] - k
        own[cut[cut < len(own)]] = -1
    order = np.argsort(own)
    own = own[order]
    skip = int(np.searchsorted(own, 0))
    own, order = own[skip:], order[skip:]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    return own[first], np.diff(np.append(first, len(own))), order + DEPTH, share, at


ASKED = "block int, salt int, kind int, task int, items binary, n binary"
PARTS = "doc_id long, held_out boolean, n_tokens long, n_hits long, logs double, score double"


def distinct_words(clean: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """words_of() with the words sorted."""
    at, codes, words = words_of(clean)
    words = words.cast(pa.binary())
    order = np.array(pc.sort_indices(words))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return at, place[codes] if len(codes) else codes, words.take(pa.array(order)).to_pylist()


def ask(table: pa.Table, tasks: int, together: int) -> pa.Table:
    """What a block sends: its different grams and words by task (kinds 0 and 1), with their counts in the block's learned rows."""
    texts, learned = tidy(texts_of(table.combine_chunks().to_batches()[0])), table["learned"].combine_chunks()
    (code, n), (other, _) = tidy_grams(texts.filter(learned)), tidy_grams(texts.filter(pc.invert(learned)))
    every = np.sort(np.concatenate([code, other]))
    every = every[np.concatenate([[True], every[1:] != every[:-1]])] if len(every) else every
    count = np.zeros(len(every), np.uint32)
    count[np.searchsorted(every, code)] = n
    rows = [(0, task, squeezed(every[own]), squeezed(count[own])) for task, own in shares_of(by_task(every, tasks))]
    at, codes, words = distinct_words(texts)
    times = np.bincount(codes, np.repeat(learned.to_numpy(zero_copy_only=False), np.diff(at)), len(words)).astype(np.uint32)
    filled = np.array([i for i, w in enumerate(words) if w], np.int64)
    for task, own in shares_of(np.array([zlib.crc32(words[i]) % tasks for i in filled.tolist()], np.int64)):
        own = filled[own]
        rows.append((1, task, packed_words([words[i] for i in own.tolist()]), squeezed(times[own])))
    kind, task, items, counts = zip(*rows) if rows else ([], [], [], [])
    block = table["block"][0].as_py()
    return pa.table({"block": pa.array([block] * len(rows), pa.int32()), "salt": pa.array([block // together] * len(rows), pa.int32()), "kind": pa.array(kind, pa.int32()), "task": pa.array(task, pa.int32()), "items": pa.array(items, pa.binary()), "n": pa.array(counts, pa.binary())})


def joined_grams(items: list[bytes], counts: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different grams of several packed lists and their counts, some lists at a time."""
    code, n = np.zeros(0, np.int64), np.zeros(0)
    held, size = [], 0
    for i, pair in enumerate(zip(items, counts), 1):
        held.append((released(pair[0], "i8"), released(pair[1], kind)))
        size += len(held[-1][0])
        if size >= 1 << 22 or i == len(items):
            code, where = np.unique(np.concatenate([code, *(c for c, _ in held)]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n, *(x for _, x in held)]), len(code))
            held, size = [], 0
    return code, n.astype(np.int64)


def joined_words(items: list[bytes]) -> tuple[list[int], np.ndarray, list[bytes]]:
    """(words of each packed list, each word's place among the sorted different ones, these)."""
    lists = [zstandard.ZstdDecompressor().decompress(x).split(b"\n") for x in items]
    coded = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode()
    order = np.array(pc.sort_indices(coded.dictionary))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return list(map(len, lists)), place[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order)).to_pylist()


def packed_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def combine(table: pa.Table) -> pa.Table:
    """What several blocks send to a task as one list, each gram or word once."""
    items, counts = table["items"].to_pylist(), table["n"].to_pylist()
    if table["kind"][0].as_py():
        _, place, words = joined_words(items)
        packed, n = packed_words(words), np.bincount(place, np.concatenate([released(x, "u4") for x in counts]), len(words)).astype(np.int64)
    else:
        code, n = joined_grams(items, counts, "u4")
        packed = squeezed(code)
    return table.select(["kind", "task", "salt"]).slice(0, 1).append_column("items", pa.array([packed], pa.binary())).append_column("n", pa.array([squeezed(n)], pa.binary()))


def reply(table: pa.Table, low: Low) -> pa.Table:
    """What a task sends back for each combined list: log10 probabilities of its grams, or counts of its words, in their order."""
    items, counts = table["items"].to_pylist(), table["n"].to_pylist()
    if table["kind"][0].as_py():
        sizes, place, words = joined_words(items)
        parts = np.split(np.bincount(place, np.concatenate([released(x, "i8") for x in counts]), len(words)).astype(np.int64)[place], np.cumsum(sizes)[:-1])
        values = map(squeezed, parts)
    else:
        code, n = joined_grams(items, counts, "i8")
        logp = np.log10(probabilities(code, n, low)).astype(np.float32)
        values = (squeezed(logp[np.searchsorted(code, released(x, "i8"))]) for x in items)
    return table.select(["kind", "task", "salt"]).append_column("items", pa.array(list(values), pa.binary()))


def hand_out(asked: pa.Table, told: pa.Table) -> pa.Table:
    """Each block's part of what came back for the list that its own was combined to."""
    items = asked["items"].to_pylist()
    if asked["kind"][0].as_py():
        sizes, place, _ = joined_words(items)
        values = map(squeezed, np.split(released(told["items"][0].as_py(), "i8")[place], np.cumsum(sizes)[:-1]))
    else:
        code, _ = joined_grams(items, asked["n"].to_pylist(), "u4")
        logp = released(told["items"][0].as_py(), "f4")
        values = (squeezed(logp[np.searchsorted(code, released(x, "i8"))]) for x in items)
    return asked.select(["block", "kind", "task"]).append_column("items", pa.array(list(values), pa.binary()))


def sizes_of(table: pa.Table) -> pa.Table:
    """Tokens and different words of a task's combined words; nothing for its grams, which are passed over unread."""
    if not table["kind"][0].as_py():
        return pa.table({"n": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
    _, place, words = joined_words(table["items"].to_pylist())
    total = np.bincount(place, np.concatenate([released(x, "i8") for x in table["n"].to_pylist()]), len(words))
    return pa.table({"n": pa.array([int(total.sum())]), "v": pa.array([int((total > 0).sum())])})


def answer(own: pa.Table, known: pa.Table, tasks: int) -> pa.Table:
    """PARTS of a block's rows from what the tasks sent back."""
    if not own.num_rows:
        return pa.table({c: pa.array([], t) for c, t in zip(["doc_id", "held_out", "n_tokens", "n_hits", "logs", "score"], [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])})
    texts = tidy(texts_of(own.combine_chunks().to_batches()[0]))
    sent = {(k, t): x for k, t, x in zip(known["kind"].to_pylist(), known["task"].to_pylist(), known["items"].to_pylist())}
    code, times, places, share, bounds = located(texts)
    logp = np.zeros(len(code))
    for task, where in shares_of(by_task(code, tasks)):
        logp[where] = released(sent[0, task], "f4")
    each = share.astype(np.float64)
    each[places] += np.repeat(logp, times)
    at, codes, words = distinct_words(texts)
    c = np.zeros(len(words), np.int64)
    filled = np.array([i for i, w in enumerate(words) if w], np.int64)
    for task, where in shares_of(np.array([zlib.crc32(words[i]) % tasks for i in filled.tolist()], np.int64)):
        c[filled[where]] = released(sent[1, task], "i8")
    summed = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[codes])])[at])
    return pa.table({"doc_id": own["doc_id"], "held_out": own["held_out"], "n_tokens": pa.array(np.diff(at) + 1), "n_hits": pa.array(summed((c > 0).astype(np.int64))), "logs": pa.array(summed(np.log10(c + 1.0))), "score": pa.array(np.add.reduceat(each, bounds[:-1]))})


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learned from rows whose crc32 of the id modulo 7 isn't 2; rows with a null id are neither learned from nor held out.
    Null text counts as empty: one token, the end. Repeated rows repeat; an empty table gives no rows; other
    columns aren't read.

    Rows are dealt by hash into blocks of about BLOCK_BYTES of text, and there are as many tasks as blocks. A block meets its own
    grams' probabilities and words' counts again, so neither a vocabulary, a model nor a hot word's rows are gathered.
    """
    docs = only(docs, "doc_id", "text").withColumn("learned", F.coalesce(crc_bucket("doc_id", 7) != 2, F.lit(False)))
    sizes = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.sum(F.col("learned").cast("long")).alias("ends")).first()
    blocks, ends = max(1, -(-(sizes["b"] or 0) // BLOCK_BYTES)), sizes["ends"] or 0
    table = levels(stored(short_grams(docs), "short-grams"), CUT - 1).orderBy("code").toArrow()  # the alphabet's size to the power of CUT at most
    shared = docs.sparkSession.sparkContext.broadcast(Low(*(table[c].to_numpy().astype(t) for c, t in (("code", np.int64), ("n", float), ("total", float), ("p", float)))))
    held = F.coalesce(crc_bucket("doc_id", 7) == 2, F.lit(False))
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"), "doc_id", "text", "learned", held.alias("held_out"))
    together = TOGETHER
    asked = dealt.groupBy("block").applyInArrow(lambda t: ask(t, blocks, together), ASKED)
    share = ["kind", "task", "salt"]
    lists = asked.groupBy(*share).applyInArrow(combine, "kind int, task int, salt int, items binary, n binary")
    told = lists.groupBy("kind", "task").applyInArrow(lambda t: reply(t, shared.value), "kind int, task int, salt int, items binary")
    known = asked.groupBy(*share).cogroup(told.groupBy(*share)).applyInArrow(hand_out, "block int, kind int, task int, items binary")
    words = lists.groupBy("kind", "task").applyInArrow(sizes_of, "n long, v long")  # not filtered, so that the lists dealt to tasks are the same exchange
    words = words.agg((F.coalesce(F.sum("n"), F.lit(0)) + ends).alias("total"), (F.coalesce(F.sum("v"), F.lit(0)) + int(ends > 0)).alias("kinds"))
    parts = dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(lambda x, y: answer(x, y, blocks), PARTS).crossJoin(F.broadcast(words))  # one row
    base = F.col("logs") + float(np.log10(ends + 1.0)) - F.col("n_tokens") * F.log10(F.col("total") + F.col("kinds") + 1)
    return parts.select("doc_id", "held_out", "n_tokens", (F.col("n_hits") + int(ends > 0)).alias("n_known"), F.col("total").alias("train_tokens"), base.alias("base_score"), "score")
