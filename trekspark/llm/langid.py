"""Language identification in two levels: family first, then one-versus-one linear SVMs between the family's languages.

Features are hashed byte bigrams and trigrams of the folded text (lower case, every run of non-letters a space) as
shares of the text, so a text of any length is scored by summing weights over its bytes in slices. Every language that
occurs is learned; what is learned from is a sample of at most about PER_LANG texts a language, and OTHERS texts of other
families for each family. Each classifier is fitted in a task of its own, and all learned state is a weight matrix of
BUCKETS rows and a column per classifier.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, crc_bucket, numbered, only, stored, texts_of

TRIGRAM_BITS, BIGRAM_BITS = 13, 11
BUCKETS = (1 << TRIGRAM_BITS) + (1 << BIGRAM_BITS)
SLICE = 4 << 20
#: The documented bounds of what is learned from: expected texts per language, and expected texts of other families per family.
PER_LANG, OTHERS = 400, 4_000
UNKNOWN = "und"

# Families of ISO 639 languages. A language that isn't listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt ug uz",
    "indo-aryan": "bn gu hi mr ne pa sa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg mi ms su tl",
}


def family(lang: str) -> str:
    base = lang.lower().replace("_", "-").split("-")[0]
    return next((name for name, members in FAMILIES.items() if base in members.split()), base)


_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _grams(texts: pa.Array):
    """Yields (text of each position's segment start, segment starts, trigram buckets, bigram buckets) for slices of the texts' bytes.

    Each text gets a space before and two behind it, so no gram holds letters of two texts.
    """
    texts = pc.binary_join_element_wise(" ", pc.utf8_lower(texts), "  ", "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    starts = np.concatenate([[0], ends[:-1]])
    first_byte = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset] if len(texts) else 0
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[first_byte : first_byte + ends[-1]] if len(texts) else np.zeros(0, np.uint8)
    for lo in range(0, len(raw), SLICE):
        part = _FOLD[raw[lo : lo + SLICE + 2]]
        n = min(SLICE, len(raw) - lo)
        part = np.concatenate([part, np.full(max(0, n + 2 - len(part)), 32, np.uint8)]).astype(np.uint32)
        two = part[:n] << np.uint32(8) | part[1 : n + 1]
        three = two << np.uint32(8) | part[2 : n + 2]
        tri = (three * np.uint32(2654435761)) >> np.uint32(32 - TRIGRAM_BITS)
        bi = ((two * np.uint32(2246822519)) >> np.uint32(32 - BIGRAM_BITS)) + np.uint32(1 << TRIGRAM_BITS)
        first, last = np.searchsorted(ends, lo, side="right"), np.searchsorted(starts, lo + n)
        cuts = np.maximum(starts[first:last] - lo, 0)
        yield np.arange(first, last), cuts, tri, bi


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """For each text the mean weight of its grams, one column per classifier."""
    out, size = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts))
    for which, cuts, tri, bi in _grams(texts):
        for k in range(weights.shape[1]):
            w = weights[:, k]
            out[which, k] += np.add.reduceat(w[tri] + w[bi], cuts)
        size[which] += np.diff(np.append(cuts, len(tri)))
    return out / np.maximum(size, 1)[:, None]


def _counts(texts: pa.Array) -> list[np.ndarray]:
    """Gram shares of each text, dense; for some texts at a time."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for which, cuts, tri, bi in _grams(texts):
        for d, lo, hi in zip(which, cuts, [*cuts[1:], len(tri)]):
            out[d] += np.bincount(tri[lo:hi], minlength=BUCKETS) + np.bincount(bi[lo:hi], minlength=BUCKETS)
    return list(out / np.maximum(out.sum(axis=1, keepdims=True), 1))


def _svm(at: np.ndarray, share: np.ndarray, first: np.ndarray, y: np.ndarray, steps: int = 80, penalty: float = 1e-4) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and margins of a linear SVM with squared hinge loss, y in {-1, 1}, both classes weighing the same.

    Row i of the sparse features has the values share[first[i]:first[i + 1]] in the columns at[...]; no row is empty.
    """
    times = lambda v: np.add.reduceat(v[at] * share, first[:-1])
    lens = np.diff(first)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, b = np.zeros(BUCKETS), 0.0
    v, c, t = w, b, 1.0
    top = 2 * float((weight * (np.add.reduceat(share * share, first[:-1]) + 1)).sum()) + penalty
    for _ in range(steps):
        miss = np.maximum(0, 1 - y * (times(v) + c)) * y * weight
        new, bias = v + (2 * np.bincount(at, share * np.repeat(miss, lens), BUCKETS) - penalty * v) / top, c + 2 * miss.sum() / top
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / u * (new - w), bias + (t - 1) / u * (bias - b)
        w, b, t = new, bias, u
    return w, b, times(w) + b


def _slope(margin: np.ndarray, y: np.ndarray) -> float:
    """Slope of the logistic curve through the training margins; held between 1 and 8."""
    grid = np.arange(1.0, 8.1, 0.5)
    return float(min(grid, key=lambda a: np.logaddexp(0, -a * margin * y).mean()))


@dataclass
class Model:
    """weights: BUCKETS rows, a column per classifier; families first (one against the rest), then language pairs."""

    langs: list[str]
    families: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray

    def decide(self, texts: pa.Array, first: int, last: int) -> np.ndarray:
        """Logistic values of the classifiers `first` to `last` - 1 for each text."""
        margin = scores(texts, self.weights[:, first:last]) + self.bias[first:last]
        return 1 / (1 + np.exp(-np.clip(margin * self.slope[first:last], -50, 50)))

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language of each text and a score: the family's value times the least of the language's values in its pairs.

        Only the pairs of a text's family are looked at. The language with the largest sum of values wins, of a tie the first by name.
        """
        nf = len(self.families)
        if nf > 1:
            z = self.decide(texts, 0, nf)
            fam = z.argmax(axis=1)
            sure = z[np.arange(len(texts)), fam]
        else:
            fam, sure = np.zeros(len(texts), int), np.ones(len(texts))
        out = np.zeros(len(texts), int)
        for f, name in enumerate(self.families):
            own, members = np.flatnonzero(fam == f), [i for i, x in enumerate(self.langs) if family(x) == name]
            if not len(own) or len(members) == 1:
                out[own] = members[0]
                continue
            pairs = [k for k, (a, _) in enumerate(self.pairs) if a in members]  # one family's pairs stand together
            p = self.decide(texts.take(pa.array(own)), nf + pairs[0], nf + pairs[-1] + 1)
            votes, least = np.zeros((len(own), len(members))), np.ones((len(own), len(members)))
            for k, value in zip(pairs, p.T):
                for lang, v in zip(self.pairs[k], (value, 1 - value)):
                    place = members.index(lang)
                    votes[:, place] += v
                    least[:, place] = np.minimum(least[:, place], v)
            best = votes.argmax(axis=1)
            out[own] = np.array(members)[best]
            sure[own] *= least[np.arange(len(own)), best]
        return [self.langs[i] for i in out], sure


def fit(table: pa.Table) -> pa.Table:
    """One classifier from its rows (job, row, at, share, y): job, weights, bias, slope. Columns are scaled by the root of their mean."""
    table = table.sort_by("row")
    first = np.concatenate([[0], np.cumsum(pc.list_value_length(table["at"]).to_numpy())])
    at, share = (pc.list_flatten(table[c]).to_numpy() for c in ("at", "share"))
    y = table["y"].to_numpy().astype(float)
    scale = 1 / np.sqrt(np.bincount(at, share, BUCKETS) / len(y) + 1e-5)
    w, b, margin = _svm(at, share * scale[at], first, y)
    # Shares were taken over trigrams and bigrams together, scores() sums both over the positions.
    return pa.table({"job": table["job"][:1], "weights": pa.array([(w * scale / 2).astype("<f4").tobytes()], pa.binary()), "bias": pa.array([b]), "slope": pa.array([_slope(margin, y)])})


def train(docs: DataFrame, per_lang: int = PER_LANG, others: int = OTHERS) -> Model | None:
    """Learns from rows with a text, a lang and an id outside the held-out third; None if there are none.

    The number of rows per language is counted over all rows; then each is taken with the chance that gives `per_lang`
    of them, by a hash of its id. A family's classifier meets all its own texts and, by the same means, about `others` of the others.
    """
    known = only(docs, "doc_id", "text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_bucket("doc_id", 3) != 1))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row per language, as the model has
    if not sizes:
        return None
    spark, span = docs.sparkSession, 1 << 40
    names = sorted(sizes)
    families = sorted({family(v) for v in names})
    pairs = [(a, b) for f in families for a, b in itertools.combinations([i for i, v in enumerate(names) if family(v) == f], 2)]
    picked = {v: min(per_lang, n) for v, n in sizes.items()}
    total = sum(picked.values())
    tasks = []  # lang, job, y, chance of a text to take part
    for job, f in enumerate(families if len(families) > 1 else []):
        rest = total - sum(n for v, n in picked.items() if family(v) == f)
        tasks += [(v, job, 1 if family(v) == f else -1, 1.0 if family(v) == f else min(1.0, others / rest)) for v in names]
    for k, (a, b) in enumerate(pairs):
        tasks += [(names[a], len(families) + k, 1, 1.0), (names[b], len(families) + k, -1, 1.0)]

    def features(batches):
        for batch in bounded(batches, limit=1 << 20):
            texts = texts_of(batch)
            hot, values = [], []
            for lo in range(0, len(texts), 256):  # dense rows of so many texts at a time
                rows = _counts(texts.slice(lo, 256))
                hot += [np.flatnonzero(r).astype(np.int32) for r in rows]
                values += [r[h] for r, h in zip(rows, hot[lo:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(hot, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], names=["row", "lang", "at", "share"])

    shares = F.broadcast(spark.createDataFrame([(v, int(span * min(1.0, per_lang / n))) for v, n in sizes.items()], "lang string, below long"))
    chosen = known.join(shares, "lang").filter(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < F.col("below")).select(F.xxhash64("doc_id", "text").alias("row"), "text", "lang")
    weights, bias, slope = (np.zeros(x, np.float32) for x in ((BUCKETS, len(families) + len(pairs)), len(families) + len(pairs), len(families) + len(pairs)))
    if tasks:
        sample = stored(chosen.mapInArrow(features, "row long, lang string, at array<int>, share array<float>"), "languages")
        plan = F.broadcast(spark.createDataFrame(tasks, "lang string, job int, y int, chance double"))  # a row per language and classifier
        taking = F.pmod(F.xxhash64("row", "job"), F.lit(span)) < F.col("chance") * span
        fitted = sample.join(plan, "lang").filter(taking).select("job", "row", "at", "share", "y").groupBy("job").applyInArrow(fit, "job int, weights binary, bias double, slope double")
        for r in fitted.collect():  # BUCKETS floats a classifier
            weights[:, r["job"]], bias[r["job"]], slope[r["job"]] = np.frombuffer(r["weights"], "<f4"), r["bias"], r["slope"]
    return Model(names, families, pairs, weights, bias, slope)


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All columns of docs with lang_pred and score (0 to 1) of the column `text` behind them, replacing columns of these names.

    `und` with score 0 where the text is null or has no letter, or nothing could be learned. Repeated rows get equal
    predictions, an empty table stays empty, and no other column is looked at.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats a classifier
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches):
        for batch in bounded(batches, text, 1 << 20):  # beside a JVM that writes whole rows
            texts = texts_of(batch, text)
            lettered = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
            langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            at = np.flatnonzero(lettered)
            if len(at) and shared.value:
                found, sure = shared.value.predict(texts.take(pa.array(at)))
                score[at] = sure
                for i, lang in zip(at, found):
                    langs[i] = lang
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """doc_id, held_out (crc32 of the id modulo 3 is 1; false for a null id), lang_pred, score of every row."""
    found = identify(only(docs, "doc_id", "text"), train(docs, per_lang))
    return found.select("doc_id", F.coalesce(crc_bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


#: Least score of a document that the pipeline takes for recognised.
RECOGNISED = 0.2


def keep_known(docs: DataFrame, least: float = RECOGNISED) -> DataFrame:
    """The documents whose language is recognised with at least this score, their lang set to the prediction; all other columns as they were, whatever their names.

    Null, empty and letterless texts aren't recognised and go. Each row is judged by its own text alone, so repeated rows stay or go
    together and null ids don't matter. Where no row can be learned from, nothing is recognised; an empty table stays empty.
    """
    rows, name = numbered(docs)
    found = identify(rows, train(docs), name["text"]).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.withColumn(name["lang"], F.col("lang_pred")).select(*rows.columns).toDF(*docs.columns)
