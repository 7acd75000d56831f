"""Token ids of whole texts with the tokenizers library, each different word encoded once a batch.

In vocabularies that fold case and drop white space before the merges, white space separates words, so a text's ids are
the ids of its space-separated pieces in order. A batch is split and dictionary-encoded in Arrow, unknown pieces go
through the library, and the documents' ids are gathered with numpy. Texts that hold "<|" may contain special tokens and
are encoded whole by the library, and so are all texts with any other vocabulary.
"""

from __future__ import annotations

import functools
import json
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that are remembered between batches of one Python worker; later ones are encoded again when they come back.
MEMO = 200_000
#: A run of these behind a letter or digit is a token run of its own; splitting it off leaves fewer different pieces.
TAIL = r"([a-z0-9ß-öø-ÿ])([.,!?;:|#$%&*]+)(?:[ \n]|$)"
PLAIN = re.compile("[a-zß-öø-ÿ]+")
# Fixed value: how the folding vocabularies split a text into words.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def folding(path: str) -> bool:
    """Whether a vocabulary file folds case, drops white space and marks special tokens by `<|`, so that its texts can be encoded piece by piece."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    normal = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["pattern"] == {"Regex": WORD_SPLIT} and not steps[1]["add_prefix_space"]
    return normal == ["NFC", "Replace", "Lowercase"] and split and all(t["content"].startswith("<|") for t in spec["added_tokens"])


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: itself if visible, else the next from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


def ragged(values: np.ndarray, starts: np.ndarray, lens: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The slices values[starts[c]:starts[c] + lens[c]] for each code, one after the other."""
    n = lens[codes]
    total = int(n.sum())
    before = np.cumsum(n) - n
    return values[np.repeat(starts[codes] - before, n) + np.arange(total)]


def pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Offsets of each text's pieces, the pieces' codes, and the different pieces. Upper-case ASCII is folded."""
    texts = pc.replace_substring_regex(pc.ascii_lower(texts), TAIL, r"\1 \2 ")
    parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    return offsets - offsets[0], coded.indices.to_numpy(), coded.dictionary.to_pylist()


class WordIds:
    """Ids of pieces by `encode` (a list of strings to lists of ids), with a bounded memory of earlier ones."""

    def __init__(self, encode, memo: int = MEMO):
        self.encode, self.memo = encode, memo
        self.known: dict[str, int] = {}
        self.values, self.starts, self.lens = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def table(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row of each word, values, starts, lens): the ids of word i are the slice of row[i]."""
        get = self.known.get
        rows = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(rows < 0)
        values, starts, lens = self.values, self.starts, self.lens
        if len(new):
            fresh = [words[i] for i in new]
            lists = self.encode(fresh)
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(n.sum()))
            rows[new] = len(lens) + np.arange(len(new))
            starts = np.concatenate([starts, len(values) + np.cumsum(n) - n])
            values, lens = np.concatenate([values, flat]), np.concatenate([lens, n])
            if len(self.known) + len(new) <= self.memo:
                self.known.update(zip(fresh, rows[new].tolist()))
                self.values, self.starts, self.lens = values, starts, lens
        return rows, values, starts, lens


class Encoder:
    """Ids as the library gives them for add_special_tokens=False, without truncation and padding."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = self.whole.model
        self.letters = str.maketrans(byte_letters())
        self.words = WordIds(self._encode)
        self.by_piece = folding(path)

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Words of plain lower-case letters go straight to the library's model, all others through its whole chain."""
        out: list = [None] * len(words)
        odd = []
        model, letters, plain = self.model.tokenize, self.letters, PLAIN.fullmatch
        for i, w in enumerate(words):
            if plain(w):
                out[i] = [t.id for t in model(w if w.isascii() else w.encode().decode("latin-1").translate(letters))]
            elif w:
                odd.append(i)
            else:
                out[i] = ()
        if odd:
            for i, e in zip(odd, self.whole.encode_batch_fast([words[i] for i in odd], add_special_tokens=False)):
                out[i] = e.ids
        return out

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets of the texts in them)."""
        hard = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False) if self.by_piece else np.ones(len(texts), bool)
        soft = pc.if_else(pa.array(hard), "", texts) if hard.any() else texts
        offsets, codes, words = pieces(soft)
        rows, values, starts, lens = self.words.table(words)
        codes = rows[codes]
        ends = np.concatenate([[0], np.cumsum(lens[codes])])
        ids, at = ragged(values, starts, lens, codes), ends[offsets]
        if hard.any():
            lists = [ids[at[i] : at[i + 1]] for i in range(len(texts))]
            for i, e in zip(np.flatnonzero(hard), self.whole.encode_batch_fast(texts.filter(pa.array(hard)).to_pylist(), add_special_tokens=False)):
                lists[i] = np.array(e.ids, np.uint32)
            ids = np.concatenate(lists) if lists else ids
            at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        return ids, at.astype(np.int64)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary file and Python worker."""
    return Encoder(path)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same documents with `end_id` behind each."""
    out = np.full(len(ids) + len(offsets) - 1, end_id, np.uint32)
    keep = np.ones(len(out), bool)
    new = offsets + np.arange(len(offsets))
    keep[new[1:] - 1] = False
    out[keep] = ids
    return out, new
