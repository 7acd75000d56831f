"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes for what they miss.

The field is trained on the driver from a small labelled table (templates below), with forward-backward in numpy, and
decoded by Viterbi over batches of windows. A window is every run of words within REACH of a word that isn't plain
letters, long runs in parts that overlap; words outside all windows are plain and stay untagged. Texts without any digit, @, = or _ have no window and no
pattern, so one scan settles them.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, numbered, only, texts_of

#: In the order in which spans of one start are listed; the first four have base patterns.
KINDS = ("email", "ip", "card", "phone", "id", "iban", "secret")
TAGS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))
REACH, BUCKETS, CUES = 3, 4096, 64
#: Words of a window that are decoded together, and further words on both sides of them that only lend their context.
PART, LEND = 192, 32
MARKS = r"[0-9@=_]"

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A leftmost match can only begin at the first digit of a run, so looking behind changes nothing but the time.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Words that announce a value, by the feature they share.
CUE_WORDS = {
    "secret": "token secret password passwd passphrase pwd apikey api_key api-key credential credentials bearer key kennwort passwort clave contraseña motdepasse jeton",
    "phone": "phone tel telephone mobile cell call fax telefon telefono teléfono téléphone",
    "mail": "email e-mail mail correo courriel",
    "card": "card visa mastercard amex credit karte tarjeta carte",
    "ip": "ip host server address addr",
    "id": "ssn social security passport dni nif national",
    "iban": "iban account konto cuenta compte",
    "sign": "= := : == is",
}

# The labelled table's sentences. A name in braces is a value of that kind (n_ ones are untagged).
TEMPLATES = """
the {email} was here|write to {email} about that|{email}|contact me at {email} , or later|mail : {email} now
from {ip} to|the host {ip} is down|ip = {ip}|server {ip} answers|in {ip} and {ip}
card {card} was charged|pay with {card} today|{card}|visa : {card} ok|the {card} of|my number is {card} {n_year}|visa {card} {n_count}|{card} {n_year} {n_word}|{n_count} {card} {n_count}|{card} {card}|{n_word} {card} {n_count} {n_word}|{n_year} {card} , {n_word}
call {phone} now|phone : {phone}|tel {phone} or {phone}|{phone}|the {phone} was|fax {phone} and more
ssn {id} on file|social security {id}|id : {id}|my ssn is {id} today|passport no {id}
iban {iban} please|to account {iban}|iban : {iban} and|{iban}|account {iban} , {secret}|send it to {iban} today|{iban} {n_word} of
token = {secret} is|token = {secret}|password : {secret} now|the secret = {secret}|api_key = {secret} the|key = {secret}|bearer {secret}|{secret} {n_word} {n_word}|{n_word} {secret}|use {secret} for it|{n_word} , {secret} , {n_word}
the {n_word} of {n_word}|in {n_year} there was|version {n_version} of the|license , version {n_version}|at {n_time} on {n_date}|about {n_count} of {n_count}
{n_count} {n_bar} {n_count} {n_bar} {n_count}|the {n_money} price|{n_percent} of all|call {n_word} now|token of {n_word}|the key is {n_word}|{n_count} = {n_count}|x = {n_count}|on {n_date}
the years {n_year} {n_year} {n_year} {n_year} {n_year}|{n_year} {n_year} {n_year} {n_word}|{n_word} {n_count} {n_count} {n_count} {n_count} {n_word}
{n_word} {secret} {n_word}|{n_word} {n_word} {secret} {n_word} {n_word}|{n_word} {iban} {n_word}|{n_word} {n_word} {iban} {n_word}|{n_word} {id} {n_word}|{n_word} {phone} {n_word} {n_word}|{n_word} {card} {n_word}
page {n_count} , line {n_count}|room {n_code} was|isbn {n_code}|{n_word} = {n_word}|a card of {n_word}|no. {n_count}|the {n_long} of|order {n_long} came|user_{n_word} is|{n_word}_{n_word} = {n_count}|at {n_word} @ {n_word}|id = {n_count}|{n_word} {n_bar} {n_long} {n_bar} {n_word}|{n_bar} {n_long} {n_bar}|{n_long}
"""


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def with_check(digits: str) -> str:
    """The digits and the one that makes them pass."""
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def without_check(digits: str) -> str:
    """The digits; if they pass, with another last one."""
    return digits[:-1] + str((int(digits[-1]) + 1) % 10) if luhn(digits) else digits


def grouped(digits: str, between: str) -> str:
    """A card number in groups of four, those of fifteen in four, six and five."""
    cuts = (0, 4, 10, 15) if len(digits) == 15 else range(0, len(digits) + 4, 4)
    return between.join(filter(None, (digits[a:b] for a, b in zip(cuts, cuts[1:])))) if between else digits


#: Sizes of the groups of digits in which cards are written, behind the first four.
GROUPS = {(4, 4, n) for n in (2, 3, 4)} | {(4, 4, 4, n) for n in (1, 2, 3)} | {(6, 4), (6, 5)}


def cards_in_groups(words: list[str]) -> list[tuple[int, int]]:
    """(first, behind the last) of words that are groups of digits and together a number that passes, leftmost first; no word but the last is closed by punctuation."""
    plain = [w[slice(*core(w))] for w in words]
    out, at = [], 0
    while at < len(words):
        to = at
        if len(plain[at]) == 4 and plain[at].isascii() and plain[at].isdigit() and words[at].endswith(plain[at]):
            for n in (3, 4, 5):
                own = plain[at : at + n]
                if len(own) == n and tuple(map(len, own[1:])) in GROUPS and all(w.isascii() and w.isdigit() for w in own) and all(w == c for w, c in zip(words[at + 1 : at + n - 1], own[1:-1])) and words[at + n - 1].startswith(own[-1]) and luhn("".join(own)) and not all(w[:2] in ("19", "20") for w in own):  # a list of years isn't one
                    to = at + n
                    break
        if to > at:
            out.append((at, to))
        at = max(to, at + 1)
    return out


def _value(kind: str, rng: np.random.Generator) -> str:
    """One made-up value of a kind, by rule."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(rng.choice(list("abcdeilmnorstu"), rng.integers(2, 9)))
    pick = lambda *options: options[rng.integers(len(options))]
    end = pick("", "", ".", ",", "###", "!!")
    hexes = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    made = {
        "email": lambda: pick(word(), f"{word()}.{digits(2)}", word().upper(), f"{word()}_{word()}") + f"@{word()}{digits(1)}." + pick(f"{word()}.com", "com", "org", "de", "COM"),
        "ip": lambda: ".".join(str(rng.integers(1, 256)) for _ in range(4)),
        "card": lambda: grouped(with_check(digits(rng.choice([13, 14, 15, 15, 15, 18]))), pick("", "", "-", " ", " ")),
        "phone": lambda: pick(f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}", f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", f"+{digits(2)} {digits(3)} {digits(7)}"),
        "id": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
        "iban": lambda: pick("DE", "FR", "ES", "GB") + digits(2) + pick("", " ") + pick(digits(18), " ".join(digits(4) for _ in range(4)), " ".join(digits(4) for _ in range(4)) + " " + digits(2)),
        "secret": lambda: pick("", '"', '"', "'") + pick(hexes(40), hexes(40).upper(), hexes(32), hexes(64), "sk_" + hexes(24), hexes(20), "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), rng.integers(19, 30))) + "7X", "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"), rng.integers(20, 44))) + "4k"),
        "n_word": word,
        "n_bar": lambda: "|",
        "n_year": lambda: str(rng.integers(1000, 2100)),
        "n_version": lambda: pick(f"{digits(1)}.{digits(1)}", digits(1), f"{digits(1)}.{digits(1)}.{digits(2)}", f"v{digits(1)}.{digits(1)}"),
        "n_time": lambda: f"{digits(2)}:{digits(2)}",
        "n_date": lambda: pick(f"20{digits(2)}-{digits(2)}-{digits(2)}", f"{digits(2)}.{digits(2)}.20{digits(2)}", f"{digits(1)}/{digits(1)}/20{digits(2)}"),
        "n_count": lambda: digits(rng.integers(1, 7)),
        "n_money": lambda: pick("$", "€", "") + digits(2) + "." + digits(2),
        "n_percent": lambda: digits(2) + "%",
        "n_code": lambda: pick(f"{word()}{digits(2)}", f"{digits(2)}{word()}", f"{digits(3)}-{digits(1)}", f"A{digits(3)}"),
        "n_long": lambda: without_check(digits(rng.integers(8, 20))),
    }[kind]()
    if kind == "secret" and made[0] in "\"'":
        made += made[0]
    return made + end


def labelled(copies: int = 5, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """The labelled table: words and tags of each sentence, a few hundred in all."""
    out = []
    for number, template in enumerate(TEMPLATES.strip().replace("\n", "|").split("|")):
        template, rng = template.strip(), np.random.default_rng([seed, number])
        for _ in range(copies if "{" in template else 0):
            words, tags = [], []
            for part in template.split():
                kind = re.search(r"\{(\w+)\}", part)
                text = re.sub(r"\{(\w+)\}", lambda m: _value(m[1], rng), part)
                for k, w in enumerate(text.split(" ")):
                    words.append(w)
                    tags.append(f"{'BI'[k > 0]}-{kind[1]}" if kind and kind[1] in KINDS else "O")
            out.append((words, tags))
    return out


def core(word: str) -> tuple[int, int]:
    """Place of the word without wrapping punctuation; a leading + or ( stays."""
    left = len(word) - len(word.lstrip("\"'<[{,;:!?#*$%&|>"))
    right = len(word.rstrip("\"'>]},;:!?.#*$%&|<"))
    return (left, right) if left < right else (0, 0)


def shape(word: str) -> tuple[int, int, bool, bool]:
    """(bucket of the word's shape, bucket of its cue, whether punctuation closes it, whether it's letters alone). Letter runs lose their length, digit runs keep theirs up to 9.

    Long runs of letters and digits mixed are one shape, by whether they are all hexadecimal. A number of 14 to 19 digits that passes the card check
    has a shape of its own; see shapes_of() for one in several words.
    """
    return _remembered(word) if len(word) <= 64 else _shape(word)


def _shape(word: str) -> tuple[int, int, bool, bool]:
    lo, hi = core(word)
    w = word[lo:hi] or word
    cue = next((k + 1 for k, words in enumerate(CUE_WORDS.values()) if w.lower() in words.split()), 0)
    if re.fullmatch(r"[0-9](?:-?[0-9]){13,37}", w) and len(w) - w.count("-") <= 19 and luhn(w.replace("-", "")):
        s = "card"
    elif re.fullmatch(r"(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]{16,}", w):
        s = "hex"
    elif re.fullmatch(r"(?=.*[0-9])(?=.*[A-Za-z])[0-9A-Za-z_-]{20,}", w):
        s = "mixed"
    elif re.fullmatch(r"[^\W\d_]+(?:['-][^\W\d_]+)*", w):
        s = "w"
    else:
        s = re.sub(r"[0-9]+", lambda m: f"d{min(9, len(m[0]))}", re.sub(r"[^\W\d_]+", "x", w))
        s = re.sub(r"(.)\1{2,}", r"\1\1", s)
    return zlib.crc32(s.encode()) % BUCKETS, cue, 0 < hi < len(word), s == "w"


#: Buckets of the first and the other words of a card number in groups.
HEAD, TAIL = (zlib.crc32(name) % BUCKETS for name in (b"card head", b"card tail"))


def shapes_of(words: list[str]) -> list[tuple[int, int, bool, bool]]:
    """shape() of each word, but for those that are together a card number."""
    out = [shape(w) for w in words]
    for first, end in cards_in_groups(words):
        for k in range(first, end):
            out[k] = (HEAD if k == first else TAIL, *out[k][1:])
    return out


_remembered = functools.lru_cache(maxsize=100_000)(_shape)


class Field:
    """Weights: shape of the word itself and of its neighbours, cue of the word and of the two before it, tag to tag."""

    def __init__(self):
        t = len(TAGS)
        self.parts = {"own": np.zeros((BUCKETS, t)), "before": np.zeros((BUCKETS, t)), "after": np.zeros((BUCKETS, t)), "cue": np.zeros((CUES, t)), "cue1": np.zeros((CUES, t)), "cue2": np.zeros((CUES, t))}
        self.step = np.zeros((t, t))
        #: A tag I-k may only follow B-k or I-k.
        self.allowed = np.array([[not b.startswith("I-") or a[2:] == b[2:] for b in TAGS] for a in TAGS])
        self.start = np.array([not b.startswith("I-") for b in TAGS])

    @staticmethod
    def features(shapes: np.ndarray, cues: np.ndarray) -> dict[str, np.ndarray]:
        """Feature rows for padded windows (n, length); 0 stands for nothing beside the window."""
        moved = lambda x, k: np.pad(x, ((0, 0), (max(k, 0), max(-k, 0))))[:, max(-k, 0) : x.shape[1] + max(-k, 0)]
        return {"own": shapes, "before": moved(shapes, 1), "after": moved(shapes, -1), "cue": cues, "cue1": moved(cues, 1), "cue2": moved(cues, 2)}

    def emissions(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        return sum(self.parts[k][r] for k, r in rows.items())

    def viterbi(self, shapes: np.ndarray, cues: np.ndarray, lens: np.ndarray, closed: np.ndarray | None = None) -> np.ndarray:
        """Best tags (n, length) of all windows at once. No value goes on behind a word that is `closed`."""
        e = self.emissions(self.features(shapes, cues))
        if closed is not None:
            e[:, 1:][closed[:, :-1]] += np.where(self.start, 0, -1e9)
        n, length, t = e.shape
        step = np.where(self.allowed, self.step, -1e9)
        best = e[:, 0] + np.where(self.start, 0, -1e9)
        back = np.zeros((n, length, t), np.int8)
        for i in range(1, length):
            paths = best[:, :, None] + step[None]
            back[:, i] = paths.argmax(axis=1)
            best = np.where((i < lens)[:, None], paths.max(axis=1) + e[:, i], best)
        out = np.zeros((n, length), np.int8)
        tag = best.argmax(axis=1)
        for i in range(length - 1, -1, -1):
            inside = i < lens
            out[inside, i] = tag[inside]
            if i:
                tag = np.where(inside, back[np.arange(n), i, tag], tag)
        return out


def fit(table: list[tuple[list[str], list[str]]], rounds: int = 80, rate: float = 0.25, penalty: float = 2e-4) -> Field:
    """Maximum likelihood with a quadratic penalty: forward-backward over all sentences at once, Adam steps."""
    field, n, length = Field(), len(table), max(len(w) for w, _ in table)
    shapes, cues, gold = (np.zeros((n, length), np.int64) for _ in range(3))
    lens = np.array([len(w) for w, _ in table])
    for i, (words, tags) in enumerate(table):
        for j, (own, t) in enumerate(zip(shapes_of(words), tags)):
            shapes[i, j], cues[i, j], *_ = own
            gold[i, j] = TAGS.index(t)
    rows = Field.features(shapes, cues)
    live = np.arange(length)[None] < lens[:, None]
    aim = np.eye(len(TAGS))[gold] * live[:, :, None]
    pairs = np.zeros_like(field.step)
    both = live[:, 1:] & live[:, :-1]
    np.add.at(pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    # Only rows that occur are moved; positions of one row are summed by sorting once.
    uses = {k: np.unique(r[live], return_inverse=True) for k, r in rows.items()}
    adam = {k: (np.zeros((len(u), len(TAGS))), np.zeros((len(u), len(TAGS)))) for k, (u, _) in uses.items()} | {"step": (np.zeros_like(field.step), np.zeros_like(field.step))}

    def moved(key: str, weights: np.ndarray, grad: np.ndarray, k: int) -> np.ndarray:
        m, v = adam[key]
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        return weights + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)

    for k in range(1, rounds + 1):
        e = field.emissions(rows)
        step = np.where(field.allowed, field.step, -1e9)
        shift = lambda x: np.log(np.exp(x - (m := x.max(axis=1, keepdims=True))).sum(axis=1)) + m[:, 0]
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0] + np.where(field.start, 0, -1e9)
        for i in range(1, length):
            ahead[:, i] = np.where(live[:, i, None], shift(ahead[:, i - 1, :, None] + step[None]) + e[:, i], ahead[:, i - 1])
        for i in range(length - 2, -1, -1):
            ahead_of = (step[None] + (e[:, i + 1] + behind[:, i + 1])[:, None, :]).transpose(0, 2, 1)
            behind[:, i] = np.where(live[:, i + 1, None], shift(ahead_of), behind[:, i + 1])
        total = shift(ahead[np.arange(n), lens - 1][:, :, None])[:, 0]
        p = np.exp(ahead + behind - total[:, None, None]) * live[:, :, None]
        joint = np.exp(np.minimum(ahead[:, :-1, :, None] + step + (e + behind)[:, 1:, None, :] - total[:, None, None, None], 0)) * both[:, :, None, None]
        gap = (aim - p)[live]
        for key, (used, where) in uses.items():
            grad = np.zeros((len(used), len(TAGS)))
            np.add.at(grad, where, gap)
            field.parts[key][used] = moved(key, field.parts[key][used], grad / n - penalty * field.parts[key][used], k)
        field.step = moved("step", field.step, (pairs - joint.sum(axis=(0, 1))) / n - penalty * field.step, k)
    return field


@functools.lru_cache(maxsize=1)
def trained() -> Field:
    """The field of the built-in table; the same in every process."""
    return fit(labelled())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) by the fixed patterns, leftmost and without overlap in each kind."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        left = len(text[last:at].rstrip(LOCAL)) + last
        after = text.find("@", at + 1)
        done = at + 1
        if left < at and (m := DOMAIN.match(text, at)):
            out.append((left, 0, m.end()))
            done = m.end()
        last, at = done, after
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def windows(text: str) -> list[list[tuple[int, int]]]:
    """Runs of word places within REACH of a word with a mark, in order and not overlapping."""
    places = [m.span() for m in WORD.finditer(text)]
    mark = re.compile(MARKS)
    runs: list[list[int]] = []
    for i, (a, b) in enumerate(places):
        if mark.search(text, a, b):
            lo, hi = max(0, i - REACH), min(len(places), i + REACH + 1)
            if runs and lo <= runs[-1][1]:
                runs[-1][1] = hi
            else:
                runs.append([lo, hi])
    return [places[lo:hi] for lo, hi in runs]


def _tags(texts: list[str], jobs: list[tuple[int, list[tuple[int, int]]]], model: Field) -> list[np.ndarray]:
    """Tags of each window (text, places of its words), decoded in parts of like length; a part keeps the tags of its own PART words."""
    out = [np.zeros(len(w), np.int8) for _, w in jobs]
    parts = [(k, max(0, p - LEND), min(len(w), p + PART + LEND), p) for k, (_, w) in enumerate(jobs) for p in range(0, len(w), PART)]
    parts.sort(key=lambda x: x[2] - x[1])
    at = 0
    while at < len(parts):
        to = at + 1
        while to < len(parts) and (to - at) * (parts[to][2] - parts[to][1]) < 20_000:
            to += 1
        own, at = parts[at:to], to
        longest = own[-1][2] - own[-1][1]
        shapes, cues, closed = np.zeros((len(own), longest), np.int64), np.zeros((len(own), longest), np.int64), np.zeros((len(own), longest), bool)
        for i, (k, lo, hi, _) in enumerate(own):
            d, w = jobs[k]
            text = texts[d]
            for j, own_shape in enumerate(shapes_of([text[a:b] for a, b in w[lo:hi]])):
                shapes[i, j], cues[i, j], closed[i, j], plain = own_shape
                if plain and j:  # no value goes on with letters alone
                    closed[i, j - 1] = True
        tags = model.viterbi(shapes, cues, np.array([hi - lo for _, lo, hi, _ in own]), closed)
        for (k, lo, hi, p), row in zip(own, tags):
            end = min(hi, p + PART)
            out[k][p:end] = row[p - lo : end - lo]
    return out


def field_spans(texts: list[str], model: Field) -> list[list[tuple[int, int, int]]]:
    """Spans that the field tags in each text: a word tagged as a beginning and those tagged as going on behind it."""
    jobs = [(d, w) for d, text in enumerate(texts) for w in windows(text)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (d, w), row in zip(jobs, _tags(texts, jobs, model)):
        text = texts[d]
        for j in np.flatnonzero(row).tolist():
            kind = (int(row[j]) - 1) // 2
            if row[j] == 2 * kind + 2 and j and row[j - 1] in (2 * kind + 1, 2 * kind + 2):
                continue  # goes on in the span before
            k = j + 1
            while k < len(w) and row[k] == 2 * kind + 2:
                k += 1
            start = w[j][0] + core(text[slice(*w[j])])[0]
            end = w[k - 1][0] + (core(text[slice(*w[k - 1])])[1] or w[k - 1][1] - w[k - 1][0])
            if any(c.isdigit() or c == "@" for c in text[start:end]):
                out[d].append((start, kind, end))
    return out


def all_spans(texts: list[str], model: Field) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; a span of the field that meets a base span is left out."""
    out = []
    for text, more in zip(texts, field_spans(texts, model)):
        base = base_spans(text)
        merged, k = list(base), 0
        reach = sorted((a, b) for a, _, b in base)
        for a, kind, b in sorted(more):
            while k < len(reach) and reach[k][1] <= a:
                k += 1
            if k == len(reach) or reach[k][0] >= b:
                merged.append((a, kind, b))
        out.append((base, sorted(merged)))
    return out


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def _marked(texts: pa.Array) -> np.ndarray:
    return np.flatnonzero(pc.match_substring_regex(texts, MARKS).to_numpy(zero_copy_only=False))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row.

    Null text counts as empty (zeros, digest of nothing, no spans); repeated rows repeat, a null id stays null, an empty
    table gives no rows, other columns aren't read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained())  # a few MB, whatever the data

    def run(batches):
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in bounded(batches):
            texts = texts_of(batch)
            counts = np.zeros((4, len(texts)), np.int64)
            digest, spans = [nothing] * len(texts), [""] * len(texts)
            at = _marked(texts)
            for i, (base, every) in zip(at, all_spans(texts.take(pa.array(at)).to_pylist(), shared.value)):
                for _, kind, _ in base:
                    counts[kind, i] += 1
                digest[i] = hashlib.sha256(_written(base).encode()).hexdigest()
                spans[i] = _written(every)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts), pa.array(digest), pa.array(spans)], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns with each span of `text` replaced by its kind in angle brackets, and n_chars, if there, counted anew.

    No row goes: null texts stay null, empty and clean ones stay as they are, repeated rows are changed alike, other columns are carried
    as they were, whatever their names; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    rows, name = numbered(docs)

    def run(batches):
        for batch in bounded(batches, name["text"]):
            where = batch.schema.get_field_index(name["text"])
            texts = batch.column(where)
            at = _marked(texts_of(batch, name["text"]))
            if len(at):
                old = texts.take(pa.array(at)).to_pylist()
                new = dict(zip(at.tolist(), (masked(t, every) for t, (_, every) in zip(old, all_spans(old, shared.value)))))
                texts = pa.array([new.get(i, t) for i, t in enumerate(texts.to_pylist())], texts.type)
            yield batch.set_column(where, batch.schema.field(where), texts)

    clean = rows.mapInArrow(run, rows.schema)
    if "n_chars" in name:
        clean = clean.withColumn(name["n_chars"], F.length(name["text"]).cast(rows.schema[name["n_chars"]].dataType))
    return clean.toDF(*docs.columns)
