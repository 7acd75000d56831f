"""Exact BPE by backtracking over longest token matches, and decoding by an offset table.

An Aho-Corasick automaton finds every token that stands anywhere in a word. From left to right the longest token at a
place is taken if it is compatible with the token before it: two tokens are compatible if merging by rank would leave
that border standing, which is looked up in a pair table. Else a shorter token is tried, and if none is left, the place
is marked dead and the last token is taken back. Each place dies once at most, so the time is linear in the word, and
the tokens are those of rank-by-rank merging.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import bounded, only, texts_of
from .tokens import PLAIN, WordIds, byte_letters, folding, pieces

#: Token pairs whose compatibility is remembered by one Python worker.
PAIRS = 200_000
#: ASCII and Latin letters, whose normal form and letter class every Unicode version has alike.
FAMILIAR = re.compile("[\\x00-\\x7eß-öø-ÿÀ-ÖØ-Þ]*")


class Backtracker:
    """Encoder and decoder for a byte-level BPE file that folds case and drops white space; another one raises."""

    def __init__(self, path: str):
        if not folding(path):
            raise ValueError(f"{path} isn't a vocabulary that folds case and drops white space")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern)
        self.letters = str.maketrans(byte_letters())
        self._merges([tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])
        names = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for token, i in [*self.vocab.items(), *self.special.items()]:
            names[i] = token
        raw = [n.encode() for n in names]
        self.text = np.frombuffer(b"".join(raw), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        self.library = Tokenizer.from_file(path)
        self.words = WordIds(self.encode_pieces)

    def _merges(self, merges: list[tuple[str, str]]) -> None:
        """Ranks of tokens, the two halves of each, and the automaton over all of them.

        Symbols that end a word are written as one letter behind the alphabet's, so every token is a plain string.
        """
        last = 0x10000
        self.ends = {c: chr(last + k) for k, c in enumerate(byte_letters().values())}
        as_letters = lambda token: token[: -len(self.end) - 1] + self.ends[token[-len(self.end) - 1]] if self.end and token.endswith(self.end) and token != self.end else token
        single = [*byte_letters().values(), *self.ends.values()]
        #: By rank: 0 to len(single) - 1 are single letters, then one number per merge in order.
        self.rank = {c: i for i, c in enumerate(single)}
        self.halves = [(i, i) for i in range(len(single))]
        self.pair: dict[tuple[int, int], int] = {}
        self.ids = [self.vocab.get(self._written(c), -1) for c in single]
        self.singles = len(single)
        for a, b in merges:
            x, y = as_letters(a), as_letters(b)
            i, j = self.rank[x], self.rank[y]
            self.pair.setdefault((i, j), len(self.halves))
            self.rank.setdefault(x + y, len(self.halves))
            self.halves.append((i, j))
            self.ids.append(self.vocab[a[: -len(self.end)] + b if self.end and a.endswith(self.end) else a + b])
        self.find = ahocorasick.Automaton()
        for token, r in self.rank.items():
            self.find.add_word(token, (len(token), r))
        self.find.make_automaton()
        self.fits: dict[int, bool] = {}

    def _written(self, letter: str) -> str:
        return next((c + self.end for c, e in self.ends.items() if e == letter), letter)

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging by rank keeps the border between tokens a and b.

        The merges that made a and b are undone, latest first; at each stage a merge across the border that comes
        before the merge just undone would have happened first.
        """
        key = a << 20 | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            known = self.fits[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        pair, halves, singles = self.pair, self.halves, self.singles
        before = len(halves)  # a merge across the border counts if its rank is below
        while True:
            across = pair.get((a, b), before)
            if across < before:
                return False
            if a < singles and b < singles:
                return True
            # The later of the two merges is undone; of equal ones, the left one was made first, so the right goes first.
            if a > b:
                before, a = a, halves[a][1]
            else:
                before, b = b + 1, halves[b][0]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-split word, given as letters with the end letter in place."""
        whole = self.rank.get(word)
        n = len(word)
        if n == 1:
            return [self.ids[whole]]
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for e, match in self.find.iter(word):
            starts[e - match[0] + 1].append(match)
        dead = bytearray(n + 1)
        out: list[int] = []
        places: list[tuple[int, int]] = []  # (place, how many of its matches are used up)
        at, left = 0, len(starts[0])
        compatible = self.compatible
        while at < n:
            here = starts[at]  # shortest first
            took = False
            while left:
                left -= 1
                size, token = here[left]
                if not dead[at + size] and (not out or compatible(out[-1], token)):
                    out.append(token)
                    places.append((at, left))
                    at += size
                    left = len(starts[at]) if at < n else 0
                    took = True
                    break
            if not took:
                dead[at] = 1
                out.pop()
                at, left = places.pop()
        ids = self.ids
        return [ids[t] for t in out]

    def encode_text(self, text: str) -> list[int]:
        """Ids of any text: special tokens, normal form, lower case, word split, bytes, merges."""
        out: list[int] = []
        for k, part in enumerate(self.special_split.split(text) if self.special_split and "<|" in text else [text]):
            if k % 2:
                out.append(self.special[part])
                continue
            if FAMILIAR.fullmatch(part):
                words = [w.encode().decode("latin-1").translate(self.letters) for w in self.split.findall(part.lower())]
            else:  # normal form, lower case and letter classes by the library's own Unicode tables
                words = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]
            for letters in words:
                out += self.encode_word(letters[:-1] + self.ends[letters[-1]])
        return out

    @staticmethod
    def whole_texts(texts: pa.Array) -> np.ndarray:
        """Which texts may hold special tokens and aren't cut into pieces."""
        return pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)

    def encode_pieces(self, words: list[str]) -> list[list[int]]:
        plain, one, ends, letters = PLAIN.fullmatch, self.encode_word, self.ends, self.letters
        out = []
        for w in words:
            if plain(w):
                w = w if w.isascii() else w.encode().decode("latin-1").translate(letters)
                out.append(one(w[:-1] + ends[w[-1]]))
            else:
                out.append(self.encode_text(w) if w else [])
        return out

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 of each run ids[bounds[i]:bounds[i + 1]]: token texts from the offset table with a space between."""
        n = self.offsets[ids.astype(np.int64) + 1] - self.offsets[ids]
        first = np.zeros(len(ids), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        gap = np.where(first, 0, 1)
        size = n + gap
        ends = np.cumsum(size)
        out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
        to = np.repeat(ends - n - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        out[to] = self.text[np.repeat(self.offsets[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        raw, at = out.tobytes(), np.concatenate([[0], ends])[bounds]
        return [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


@functools.lru_cache(maxsize=2)
def backtracker(path: str) -> Backtracker:
    return Backtracker(path)


def _words_joined(batch_texts: pa.Array, model: Backtracker):
    """For each text: number of ids, the ids as decimal text, the decoded bytes. Different pieces are worked once a batch."""
    offsets, codes, words = pieces(batch_texts)
    rows, values, starts, lens = model.words.table(words)
    n = lens[rows]
    ids = values[np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    bounds = np.concatenate([[0], np.cumsum(n)])
    decoded = model.decode(ids, bounds)
    tens = list(map(str, ids.tolist()))
    b = bounds.tolist()
    decimal = [" ".join(tens[i:j]) for i, j in zip(b[:-1], b[1:])]
    keep = n[codes] > 0
    kept = codes[keep]
    at = np.concatenate([[0], np.cumsum(keep)])[offsets]
    total = np.concatenate([[0], np.cumsum(n[codes])])[offsets]
    return kept, at, np.diff(total), decimal, decoded


def encode(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """doc_id, ids (array of token ids) and decoded text of every row.

    Null text counts as empty: no ids, empty decoded text. Repeated rows repeat, a null doc_id stays null, an empty table
    gives no rows, other columns aren't read.
    """

    def run(batches):
        for batch in bounded(batches):
            model = backtracker(path)
            lists = [model.encode_text(x) for x in texts_of(batch).to_pylist()]
            flat = np.array([i for x in lists for i in x], np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32())), pa.array([x.decode() for x in model.decode(flat, bounds)], pa.string())], names=["doc_id", "ids", "decoded"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; odd rows as in encode(). Ids aren't sent to the JVM."""

    def run(batches):
        for batch in bounded(batches, limit=4 << 20):
            model = backtracker(path)
            texts = texts_of(batch)
            special = model.whole_texts(texts)
            hard = np.flatnonzero(special).tolist()
            soft = pc.if_else(pa.array(special), "", texts) if hard else texts
            kept, at, n, decimal, decoded = _words_joined(soft, model)
            ids_hex, text_hex, counts = [], [], n.tolist()
            get, back = decimal.__getitem__, decoded.__getitem__
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                words = kept[lo:hi].tolist()
                ids_hex.append(hashlib.sha256(" ".join(map(get, words)).encode()).hexdigest())
                text_hex.append(hashlib.sha256(b" ".join(map(back, words))).hexdigest())
            for i in hard:
                whole = np.array(model.encode_text(texts[i].as_py()), np.int64)
                counts[i] = len(whole)
                ids_hex[i] = hashlib.sha256(" ".join(map(str, whole.tolist())).encode()).hexdigest()
                text_hex[i] = hashlib.sha256(model.decode(whole, np.array([0, len(whole)]))[0]).hexdigest()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex), pa.array(text_hex)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
