"""Progressive JPEG as a media column: bytes are kept losslessly as DCT coefficients, and decoded to RGB tensors.

coefficients() accumulates the scans of progressive files (spectral selection and successive approximation, with
restart intervals) into coefficient arrays, inverse-transforms them in numpy, upsamples the chroma planes and gives
full-resolution RGB tensors. Many files are decoded at once: every restart interval of every file is a lane, and all
lanes of like scans walk through their bits side by side.

encode() writes a payload's bytes as coefficients of 4:2:0 images. Bytes are counted from CENTRE, where a text's letters
lie, and moved two away from zero, so no coefficient of the payload vanishes in the first approximation; blocks behind
the payload are zero.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import bounded, only, scratch, texts_of

UNIT, FILL, CENTRE = 576, b"\xff", 108
#: Restart interval of the files written: blocks of an AC scan, MCUs of a DC scan.
RESTART = 8
#: Text bytes that a task works on at a time; arrays of about 60 times this size are held.
LIMIT = 2 << 20
#: Payload bytes of one file at most; a longer payload goes on in further files.
PART = 1820 * UNIT
MOST_HIGH = 4095  # MCUs; a JPEG side has 16 bits


def zigzag() -> np.ndarray:
    """Row-major place of each coefficient in scan order."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))
    return np.array([8 * r + c for r, c in cells])


ZIGZAG = zigzag()


def huffman(lengths: dict[int, int]) -> tuple[bytes, list[int], dict[int, tuple[int, int]]]:
    """(16 counts, symbols in order, code and length of each symbol) of the canonical code with these lengths."""
    order = sorted(lengths, key=lambda s: (lengths[s], s))
    codes, code, last = {}, 0, 0
    for s in order:
        code <<= lengths[s] - last
        last = lengths[s]
        codes[s] = (code, last)
        code += 1
    assert code < 1 << last  # the code of ones alone stays free
    return bytes(sum(v == n for v in lengths.values()) for n in range(1, 17)), order, codes


# The codes of the files written, by rule: sizes without a run are short, ends of blocks and short runs are longer.
DC_CODE = huffman({s: 4 for s in range(12)})
AC_CODE = huffman({r << 4 | s: 4 if r == 0 and 1 <= s <= 7 else 7 if (r, s) in [(0, 0), (15, 0), *((1, s) for s in range(1, 8))] else 10 for r in range(16) for s in range(11) if s or r in (*range(15), 15)})


def coefficient(b: np.ndarray) -> np.ndarray:
    v = (b.astype(np.int16) - CENTRE + 128) % 256 - 128
    return np.where(v < 0, v - 2, v + 2).astype(np.int16)


def original(c: np.ndarray) -> np.ndarray:
    return ((np.where(c < 0, c + 2, c - 2) + CENTRE) % 256).astype(np.uint8)


def _size(v: np.ndarray) -> np.ndarray:
    """Bits of the magnitude of each value."""
    return np.ceil(np.log2(np.abs(v.astype(np.float64)) + 1)).astype(np.int64)


def _bits(v: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(v < 0, v + (1 << size) - 1, v)


@functools.lru_cache(maxsize=1)
def _ac_tokens() -> tuple[np.ndarray, np.ndarray]:
    """(bits, length) of the first AC scan's token of each byte value."""
    c = coefficient(np.arange(256, dtype=np.uint8)).astype(np.int64)
    v = np.sign(c) * (np.abs(c) >> 1)
    size = _size(v)
    code = np.array([AC_CODE[2][int(s)] for s in size])
    return (code[:, 0] << size) | _bits(v, size), code[:, 1] + size


def _pack(values: np.ndarray, lens: np.ndarray, lane_of: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all lanes one after the other, bytes of each lane): each lane is closed with ones to a whole byte."""
    total = np.bincount(lane_of, lens, lanes).astype(np.int64)
    size = -(-total // 8)
    base = (np.cumsum(size) - size) * 8
    before = np.cumsum(lens) - lens
    first = np.concatenate([[0], np.cumsum(total)[:-1]])
    at = base[lane_of] + before - first[lane_of]
    words = int(size.sum()) // 4 + 2
    word, shift = at >> 5, 64 - (at & 31) - lens
    v = values.astype(np.uint64) << shift.astype(np.uint64)
    out = np.bincount(word, (v >> np.uint64(32)).astype(np.float64), words) + np.bincount(word + 1, (v & np.uint64(0xFFFFFFFF)).astype(np.float64), words)[:words]
    raw = np.frombuffer(out.astype(np.uint32).astype(">u4").tobytes(), np.uint8)[: int(size.sum())].copy()
    spare = (8 - total % 8) % 8
    ends = np.cumsum(size)[size > 0] - 1
    raw[ends] |= ((1 << spare[size > 0]) - 1).astype(np.uint8)
    return raw, size


def _framed(raw: np.ndarray, size: np.ndarray, lanes_of: np.ndarray) -> list[bytes]:
    """Entropy-coded data of each file (lanes_of: lanes per file): FF bytes stuffed, restart markers between lanes."""
    last = np.cumsum(lanes_of) - 1
    marked = np.ones(len(size), bool)
    marked[last] = False
    turn = np.arange(len(size)) - np.repeat(last - lanes_of + 1, lanes_of)
    ends = np.cumsum(size)
    full = raw == 255
    extra = full.astype(np.int64)
    np.add.at(extra, ends - 1, np.where(marked, 2, 0))
    to = np.arange(len(raw)) + np.cumsum(extra) - extra
    out = np.zeros(len(raw) + int(extra.sum()), np.uint8)
    out[to] = raw
    place = to[ends[marked] - 1] + 1 + full[ends[marked] - 1]
    out[place], out[place + 1] = 255, 0xD0 + turn[marked] % 8
    data, stop = out.tobytes(), np.concatenate([[0], (to + 1 + extra)[ends[last] - 1]]).tolist()
    return [data[a:b] for a, b in zip(stop[:-1], stop[1:])]


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 255, marker, len(body) + 2) + body


def _start(parts: list[tuple[int, int, int]], ss: int, se: int, ah: int, al: int) -> bytes:
    return _segment(0xDA, bytes([len(parts)]) + b"".join(bytes([c, dc << 4 | ac]) for c, dc, ac in parts) + bytes([ss, se, ah << 4 | al]))


#: The scans written: (component or None for all, first and last coefficient, approximation before and after).
SCRIPT = [(None, 0, 0, 0, 1), *((c, a, b, 0, 1) for a, b in ((1, 5), (6, 63)) for c in range(3)), *((c, 1, 63, 1, 0) for c in range(3)), (None, 0, 0, 1, 0)]


def grid(blocks: int) -> tuple[int, int]:
    """(columns, rows) of MCUs for so many blocks, six to an MCU."""
    mcus = max(1, -(-blocks // 6))
    wide = -(-mcus // MOST_HIGH)
    return wide, -(-mcus // wide)


def encode(payloads: list[bytes]) -> list[bytes]:
    """A progressive file for each payload, whose length is a positive multiple of UNIT."""
    n = np.array([len(p) // 64 for p in payloads])
    shape = [grid(int(b)) for b in n]
    mcus = np.array([w * h for w, h in shape])
    total = int(mcus.sum())
    blocks = np.zeros((total * 6, 64), np.uint8)
    live = np.zeros(total * 6, bool)
    starts = (np.cumsum(mcus) - mcus) * 6
    place = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    blocks[place] = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, 64)
    live[place] = True
    coef0 = np.where(live, coefficient(blocks[:, 0]), 0).astype(np.int64)
    mcu_file = np.repeat(np.arange(len(n)), mcus)
    mcu_in = np.arange(total) - np.repeat(np.cumsum(mcus) - mcus, mcus)
    data: list[list[bytes]] = []

    def lanes_for(units: np.ndarray, file: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        per = -(-units // RESTART)
        return (np.cumsum(per) - per)[file] + inside // RESTART, per

    lane, per = lanes_for(mcus, mcu_file, mcu_in)
    # DC, first: differences along each component, begun anew in each lane.
    dc = (coef0 >> 1).reshape(-1, 6)
    fresh = np.concatenate([[True], lane[1:] != lane[:-1]])
    before = np.concatenate([np.zeros((1, 6), np.int64), dc[:-1]])
    before[fresh] = 0
    diff = dc.copy()
    diff[:, 1:4] -= dc[:, 0:3]
    diff[:, 0] -= before[:, 3]
    diff[:, 4:] -= before[:, 4:]
    diff = diff.reshape(-1)
    size = _size(diff)
    code = np.array([DC_CODE[2][s] for s in range(12)])[size]
    data.append(_framed(*_pack((code[:, 0] << size) | _bits(diff, size), code[:, 1] + size, np.repeat(lane, 6), int(per.sum())), per))
    dc_lanes = np.repeat(lane, 6), per
    # Blocks of each component in its scan order; files are one after the other in each.
    wide = np.repeat([w for w, _ in shape], mcus)
    row, col = mcu_in // wide, mcu_in % wide
    orders, files, inner = [], [], []
    for c in range(3):
        if c == 0:
            y = np.arange(4)
            r, q = 2 * row[:, None] + y // 2, 2 * col[:, None] + y % 2
            spot = (r * (2 * wide[:, None]) + q).reshape(-1)
            owner, source = np.repeat(mcu_file, 4), (np.arange(total)[:, None] * 6 + y).reshape(-1)
        else:
            spot, owner, source = mcu_in, mcu_file, np.arange(total) * 6 + 3 + c
        count = mcus * (4 if c == 0 else 1)
        order = np.empty(len(spot), np.int64)
        order[(np.cumsum(count) - count)[owner] + spot] = source
        orders.append(order)
        files.append(np.repeat(np.arange(len(n)), count))
        inner.append(np.arange(len(order)) - np.repeat(np.cumsum(count) - count, count))
    bits, lens = _ac_tokens()
    end_code, end_len = AC_CODE[2][0]
    for c, ss, se, ah, _ in SCRIPT[1:-1]:
        order = orders[c]
        lane, per = lanes_for(mcus * (4 if c == 0 else 1), files[c], inner[c])
        on = live[order]
        if ah:
            low = (np.abs(coefficient(blocks[order])) & 1)[:, 1:]
            v, k = np.empty((len(order), 64), np.int64), np.ones((len(order), 64), np.int64)
            v[:, 0], k[:, 0], v[:, 1:] = end_code, end_len, low
            k[~on, 1:] = 0
            v[~on, 1:] = 0
            # Up to 32 corrections make one token.
            weights = 1 << np.arange(31, -1, -1)
            token = np.stack([v[:, 0], (v[:, 1:33] * weights).sum(axis=1), (v[:, 33:64] * weights[1:]).sum(axis=1)], axis=1)
            length = np.stack([k[:, 0], np.where(on, 32, 0), np.where(on, 31, 0)], axis=1)
            data.append(_framed(*_pack32(token, length, lane, int(per.sum())), per))
            continue
        b = blocks[order][:, ss : se + 1]
        v, k = bits[b], lens[b]
        v[~on], k[~on] = 0, 0
        v[~on, 0], k[~on, 0] = end_code, end_len
        data.append(_framed(*_pack(v.reshape(-1), k.reshape(-1), np.repeat(lane, se - ss + 1), int(per.sum())), per))
    data.append(_framed(*_pack(coef0 & 1, np.ones(len(coef0), np.int64), dc_lanes[0], int(dc_lanes[1].sum())), dc_lanes[1]))
    out = []
    for i, (w, h) in enumerate(shape):
        parts = [b"\xff\xd8", _segment(0xFE, struct.pack(">Q", len(payloads[i]))), _head(w, h)]
        for (c, ss, se, ah, al), files_data in zip(SCRIPT, data):
            ids = [(j + 1, 0, 0) for j in range(3)] if c is None else [(c + 1, 0, 0)]
            parts += [_start(ids, ss, se, ah, al), files_data[i]]
        out.append(b"".join(parts) + b"\xff\xd9")
    return out


def _pack32(token: np.ndarray, length: np.ndarray, lane: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """_pack() for rows of several tokens of up to 32 bits each, halved so that a token and its shift stay in 64 bits."""
    hi = np.maximum(length - 16, 0)
    lo = np.minimum(length, 16)
    v = np.stack([token >> lo, token & ((1 << lo) - 1)], axis=2).reshape(-1)
    return _pack(v, np.stack([hi, lo], axis=2).reshape(-1), np.repeat(lane, 2 * token.shape[1]), lanes)


@functools.lru_cache(maxsize=256)
def _head(wide: int, high: int) -> bytes:
    table = lambda kind, code: bytes([kind << 4]) + code[0] + bytes(code[1])
    frame = struct.pack(">BHHB", 8, 16 * high, 16 * wide, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    return _segment(0xDB, b"\0" + b"\1" * 64) + _segment(0xC2, frame) + _segment(0xC4, table(0, DC_CODE) + table(1, AC_CODE)) + _segment(0xDD, struct.pack(">H", RESTART))


@dataclass
class Scan:
    file: int
    parts: tuple[int, ...]
    band: tuple[int, int, int, int]
    tables: tuple
    restart: int
    data: bytes


@dataclass
class Image:
    """One file's frame: size, components as (id, horizontal, vertical, quantiser), quantisers, place of its blocks."""

    width: int = 0
    height: int = 0
    parts: list = field(default_factory=list)
    quant: dict = field(default_factory=dict)
    comment: bytes = b""
    base: list = field(default_factory=list)

    def cells(self, c: int) -> tuple[int, int, int, int]:
        """Blocks of component c: (columns, rows) with MCU padding, then without, as scans of one component count them."""
        hm, vm = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        _, h, v, _ = self.parts[c]
        mw, mh = -(-self.width // (8 * hm)), -(-self.height // (8 * vm))
        return mw * h, mh * v, -(-(-(-self.width * h // hm)) // 8), -(-(-(-self.height * v // vm)) // 8)


_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")


def parse(data: bytes, number: int) -> tuple[Image, list[Scan]]:
    """The frame and the scans of one file; anything but a progressive 8-bit file raises ValueError."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    image, scans, tables, restart, at = Image(), [], {}, 0, 2
    while at + 4 <= len(data):
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        if marker == 0xD9:
            break
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            k = 0
            while k < len(body):
                wide = body[k] >> 4
                step = 128 if wide else 64
                image.quant[body[k] & 15] = np.frombuffer(body[k + 1 : k + 1 + step], ">u2" if wide else np.uint8).astype(np.int64)
                k += 1 + step
        elif marker == 0xC2:
            bits, image.height, image.width, count = struct.unpack(">BHHB", body[:6])
            if bits != 8:
                raise ValueError("8 bits a sample are read")
            image.parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(count)]
        elif marker in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("only progressive Huffman files are read")
        elif marker == 0xC4:
            k = 0
            while k < len(body):
                counts = body[k + 1 : k + 17]
                total = sum(counts)
                tables[body[k]] = (counts, body[k + 17 : k + 17 + total])
                k += 17 + total
        elif marker == 0xDD:
            restart = int.from_bytes(body, "big")
        elif marker == 0xFE:
            image.comment = body
        elif marker == 0xDA:
            count = body[0]
            ids = [p[0] for p in image.parts]
            parts = tuple(ids.index(body[1 + 2 * i]) for i in range(count))
            ss, se, near = body[1 + 2 * count : 4 + 2 * count]
            kinds = tuple((tables.get(body[2 + 2 * i] >> 4) if ss == 0 else tables.get(16 | body[2 + 2 * i] & 15)) for i in range(count))
            end = _MARKER.search(data, at)
            stop = end.start() if end else len(data)
            scans.append(Scan(number, parts, (ss, se, near >> 4, near & 15), kinds, restart, data[at:stop]))
            at = stop
    return image, scans


@functools.lru_cache(maxsize=64)
def _lookup(table: tuple[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and code length by the next 16 bits."""
    counts, symbols = table
    sym, length, code, k = np.zeros(1 << 16, np.int64), np.ones(1 << 16, np.int64), 0, 0
    for bits in range(1, 17):
        for _ in range(counts[bits - 1]):
            lo = code << (16 - bits)
            sym[lo : lo + (1 << (16 - bits))], length[lo : lo + (1 << (16 - bits))] = symbols[k], bits
            code, k = code + 1, k + 1
        code <<= 1
    return sym, length


class Bits:
    """Entropy-coded data of many scans without stuffing, as lanes; at[i] is lane i's place in bits."""

    def __init__(self, scans: list[Scan]):
        raw = np.frombuffer(b"".join(s.data + b"\xff\xd0" for s in scans) + b"\0" * 16, np.uint8)
        after = np.concatenate([[0], raw[:-1] == 255])
        mark = (after == 1) & (raw >= 0xD0) & (raw <= 0xD7)
        drop = mark | ((after == 1) & (raw == 0))
        drop[:-1] |= mark[1:]
        kept = np.cumsum(~drop) - ~drop
        ends = np.flatnonzero(mark)  # a restart, or the mark put behind each scan
        clean = np.concatenate([raw[~drop], np.zeros(16, np.uint8)]).astype(np.uint64)
        n = len(clean) - 8
        self.words = clean[:n] << np.uint64(32)
        for k in range(1, 5):
            self.words |= clean[k : n + k] << np.uint64(32 - 8 * k)
        self.at = np.concatenate([[0], kept[ends[:-1] + 1]]) * 8 if len(ends) else np.zeros(0, np.int64)

    def peek(self, at: np.ndarray, n) -> np.ndarray:
        """The next n bits (up to 32) at each place."""
        word = self.words[at >> 3]  # 40 bits
        return ((word >> (np.uint64(40) - (at & 7).astype(np.uint64) - np.asarray(n, np.uint64))) & ((np.uint64(1) << np.asarray(n, np.uint64)) - np.uint64(1))).astype(np.int64)


def _lanes(units: np.ndarray, restart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scan of each lane, units of each lane) for scans of so many units (blocks or MCUs)."""
    step = np.where(restart > 0, restart, np.maximum(units, 1))
    per = np.maximum(1, -(-units // step))
    scan = np.repeat(np.arange(len(units)), per)
    inside = np.arange(len(scan)) - np.repeat(np.cumsum(per) - per, per)
    return scan, np.minimum(step[scan], units[scan] - inside * step[scan])


def _extend(v: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where((size > 0) & (v < (1 << np.maximum(size - 1, 0))), v - (1 << size) + 1, v)


def _dc_scan(scans: list[Scan], images: list[Image], coefs: np.ndarray) -> None:
    """Scans of the DC coefficient, of one or more components; blocks come in MCU order."""
    spots, parts, units = [], [], []
    for s in scans:
        image = images[s.file]
        if len(s.parts) == 1:
            wide, _, cols, rows = image.cells(s.parts[0])
            at = (np.arange(rows)[:, None] * wide + np.arange(cols)).reshape(-1, 1) + image.base[s.parts[0]]
            kind = np.zeros(1, np.int64)
        else:
            _, h, v, _ = image.parts[s.parts[0]]
            wide, high, _, _ = image.cells(s.parts[0])
            my, mx = np.divmod(np.arange((wide // h) * (high // v)), wide // h)
            at, kind = [], []
            for j, c in enumerate(s.parts):
                _, h, v, _ = image.parts[c]
                dy, dx = np.divmod(np.arange(h * v), h)
                at.append((my[:, None] * v + dy) * image.cells(c)[0] + mx[:, None] * h + dx + image.base[c])
                kind += [j] * (h * v)
            at, kind = np.concatenate(at, axis=1), np.array(kind)
        spots.append(at.reshape(-1))
        parts.append(kind)
        units.append(len(at))
    bits = Bits(scans)
    kind, units = parts[0], np.array(units)
    scan, count = _lanes(units, np.array([s.restart for s in scans]))
    spot = np.concatenate(spots)
    start = np.concatenate([[0], np.cumsum(count * len(kind))[:-1]])
    _, _, ah, al = scans[0].band
    at = bits.at.copy()
    if ah:
        n = count * len(kind)
        lane = np.repeat(np.arange(len(n)), n)
        where = at[lane] + np.arange(len(lane)) - np.repeat(np.cumsum(n) - n, n)
        coefs[spot, 0] |= (bits.peek(where, 1) << al).astype(np.int16)
        return
    tables = [_lookup(t) for t in scans[0].tables]
    last = np.zeros((len(count), len(scans[0].parts)), np.int64)
    for i in range(int(count.max(initial=0)) * len(kind)):
        on = np.flatnonzero(count * len(kind) > i)
        j = kind[i % len(kind)]
        sym, length = tables[j]
        code = bits.peek(at[on], 16)
        size, used = sym[code], length[code]
        last[on, j] += _extend(bits.peek(at[on] + used, size), size)
        at[on] += used + size
        coefs[spot[start[on] + i], 0] = last[on, j] << al


def _ac_setup(scans: list[Scan], images: list[Image]):
    spots, units = [], []
    for s in scans:
        wide, _, cols, rows = images[s.file].cells(s.parts[0])
        spots.append((np.arange(rows)[:, None] * wide + np.arange(cols)).reshape(-1) + images[s.file].base[s.parts[0]])
        units.append(cols * rows)
    scan, count = _lanes(np.array(units), np.array([s.restart for s in scans]))
    bits = Bits(scans)
    return np.concatenate(spots), np.cumsum(count) - count, count, bits, bits.at.copy(), _lookup(scans[0].tables[0])


def _ac_first(scans: list[Scan], images: list[Image], coefs: np.ndarray) -> None:
    """First scans of a band: each step reads one symbol in every lane that isn't through."""
    spot, start, count, bits, at, (sym, length) = _ac_setup(scans, images)
    ss, se, _, al = scans[0].band
    flat = coefs.reshape(-1)
    block, stop, k = start.copy(), start + count, np.full(len(count), ss)
    live = np.flatnonzero(block < stop)
    at, block, stop, k = at[live], block[live], stop[live], k[live]
    while len(at):
        code = bits.peek(at, 16)
        s, used = sym[code], length[code]
        run, size = s >> 4, s & 15
        more = np.where(size > 0, size, np.where(run < 15, run, 0))
        value = bits.peek(at + used, more)
        at = at + used + more
        hit = size > 0
        k = k + np.where(hit, run, 0)
        to = spot[block] * 64 + k
        flat[to[hit]] = (_extend(value, size)[hit] << al).astype(np.int16)
        end = ~hit & (run < 15)
        k = np.where(end, se + 1, np.where(hit, k + 1, k + 16))
        over = k > se
        block = block + np.where(end, (1 << run) + value, over)
        k = np.where(over, ss, k)
        done = block >= stop
        if done.any():
            at, block, stop, k = at[~done], block[~done], stop[~done], k[~done]


def _ac_refine(scans: list[Scan], images: list[Image], coefs: np.ndarray) -> None:
    """Refining scans of a band. A symbol's corrections are noted in the walk and made for all lanes together after it."""
    spot, start, count, bits, at, (sym, length) = _ac_setup(scans, images)
    ss, se, _, al = scans[0].band
    flat = coefs.reshape(-1)
    had = np.packbits(coefs[spot] != 0, axis=1, bitorder="little").view("<u8")[:, 0]
    block, stop = start.copy(), start + count
    k, runs = np.full(len(count), ss), np.zeros(len(count), np.int64)
    live = block < stop
    at, block, stop, k, runs = (x[live] for x in (at, block, stop, k, runs))
    notes, news, one = [], [], np.uint64(1)
    above = lambda k: ~((one << k.astype(np.uint64)) - one)  # noqa: E731  bits from k on
    band = above(np.array([ss]))[0] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> np.uint64(63 - se))
    while len(at):
        ask = runs == 0
        code = bits.peek(at, 16)
        s, used = np.where(ask, sym[code], 0), np.where(ask, length[code], 0)
        run, size = s >> 4, s & 15
        end = ~ask | ((size == 0) & (run < 15))
        more = np.where(ask & end, run, np.where(size > 0, 1, 0))
        value = bits.peek(at + used, more)
        at = at + used + more
        runs = np.where(ask & end, (1 << run) + value, runs)
        mask = had[block]
        zeros = ~mask & above(k) & band
        for turn in range(int(run[~end].max(initial=0))):
            on = ~end & (run > turn)
            zeros[on] &= zeros[on] - one
        low = zeros & (~zeros + one)
        target = np.where(end | (zeros == 0), se + 1, np.bitwise_count(low - one).astype(np.int64))
        passed = mask & above(k) & band & ((one << np.minimum(target, 63).astype(np.uint64)) - one | np.where(target > 63, one << np.uint64(63), np.uint64(0)))
        n = np.bitwise_count(passed).astype(np.int64)
        some = n > 0
        notes.append((spot[block[some]], passed[some], n[some], at[some]))
        at = at + n
        made = ~end & (size > 0) & (target <= se)
        news.append((spot[block[made]] * 64 + target[made], np.where(value[made] == 1, 1, -1) << al))
        k = target + 1
        over = k > se
        runs = np.where(end, runs - 1, runs)
        block = block + over
        k = np.where(over, ss, k)
        done = block >= stop
        if done.any():
            at, block, stop, k, runs = (x[~done] for x in (at, block, stop, k, runs))
    if notes:
        cell, passed, n, where = (np.concatenate(x) for x in zip(*notes))
        hits = np.unpackbits(passed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        row, col = np.nonzero(hits)
        bit = bits.peek(where[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n), 1)
        to = cell[row] * 64 + col
        flat[to] += (np.sign(flat[to]) * (bit << al)).astype(np.int16)
    for to, v in news:
        flat[to] = v


def coefficients(files: list[bytes]) -> tuple[list[Image], np.ndarray]:
    """Frames, and the accumulated coefficients of all files' blocks in scan order; image.base says where a component's begin."""
    images, groups, total = [], {}, 0
    for number, data in enumerate(files):
        image, scans = parse(data, number)
        for c in range(len(image.parts)):
            image.base.append(total)
            wide, high, _, _ = image.cells(c)
            total += wide * high
        images.append(image)
        for s in scans:
            # For each coefficient a file's scans go from coarse to fine, and bands don't meet otherwise: so scans of
            # all files may be taken by approximation, coarse first.
            of = tuple((c, *image.parts[c][1:3]) for c in s.parts) if s.band[0] == 0 else ()
            groups.setdefault((-s.band[3], s.band, of, s.tables), []).append(s)
    coefs = np.zeros((total, 64), np.int16)
    for key in sorted(groups, key=lambda g: g[0]):
        scans = groups[key]
        walk = _dc_scan if scans[0].band[0] == 0 else _ac_refine if scans[0].band[2] else _ac_first
        walk(scans, images, coefs)
    return images, coefs


@functools.lru_cache(maxsize=1)
def _cosines() -> np.ndarray:
    """The inverse transform's matrix in 1/8192 steps: sums of its products are whole numbers below 2**53, so the result doesn't depend on the order of addition."""
    u = np.arange(8)
    m = np.cos((2 * u[None, :] + 1) * u[:, None] * np.pi / 16) / 2
    m[0] /= np.sqrt(2)
    return np.round(m * 8192)


def planes(image: Image, coefs: np.ndarray) -> list[np.ndarray]:
    """Samples (0 to 255) of each component, with the padding of its blocks."""
    out = []
    for c, (_, _, _, q) in enumerate(image.parts):
        wide, high, _, _ = image.cells(c)
        blocks = np.zeros((wide * high, 64))
        blocks[:, ZIGZAG] = coefs[image.base[c] : image.base[c] + wide * high] * image.quant[q]
        m = _cosines()
        rows = (blocks.reshape(-1, 8) @ m).reshape(-1, 8, 8).transpose(0, 2, 1)
        samples = (rows.reshape(-1, 8) @ m).reshape(-1, 8, 8).transpose(0, 2, 1)
        flat = np.clip(np.floor(samples / (8192 * 8192) + 128.5), 0, 255).astype(np.uint8)
        out.append(flat.reshape(high, wide, 8, 8).transpose(0, 2, 1, 3).reshape(high * 8, wide * 8))
    return out


def rgb(image: Image, coefs: np.ndarray) -> np.ndarray:
    """Full-resolution RGB tensor (height, width, 3); a single component is grey."""
    hm, vm = max(p[1] for p in image.parts), max(p[2] for p in image.parts)
    full = []
    for plane, (_, h, v, _) in zip(planes(image, coefs), image.parts):
        y, x = np.arange(image.height) * v // vm, np.arange(image.width) * h // hm
        full.append(plane[y[:, None], x[None, :]] if (h, v) != (hm, vm) else plane[: image.height, : image.width])
    if len(full) == 1:
        return np.stack(full * 3, axis=2)
    y, cb, cr = (p.astype(np.int32) for p in full[:3])
    cb, cr = cb - 128, cr - 128
    # The JFIF colour matrix in 1/65536 steps.
    out = np.stack([y + ((91881 * cr + 32768) >> 16), y - ((22554 * cb + 46802 * cr + 32768) >> 16), y + ((116130 * cb + 32768) >> 16)], axis=2)
    return np.clip(out, 0, 255).astype(np.uint8)


def payload_of(image: Image, coefs: np.ndarray) -> bytes:
    """The payload that encode() stored."""
    n = struct.unpack(">Q", image.comment)[0] // 64
    wide, high = image.width // 16, image.height // 16
    m = np.arange(wide * high)
    row, col = m // wide, m % wide
    y = np.arange(4)
    order = np.concatenate([(2 * row[:, None] + y // 2) * (2 * wide) + 2 * col[:, None] + y % 2 + image.base[0], m[:, None] + image.base[1], m[:, None] + image.base[2]], axis=1).reshape(-1)[:n]
    return original(coefs[order]).tobytes()


def padded(text: bytes) -> bytes:
    return text + FILL * (-len(text) % UNIT if text else UNIT)


def parts_of(payload: bytes) -> list[bytes]:
    """A payload in pieces of at most PART bytes, each of which is a file of its own."""
    return [payload[i : i + PART] for i in range(0, len(payload), PART)]


class Row:
    """What is gathered of one text while its files pass by; its tensor is the files' tensors on top of each other."""

    def __init__(self, files: list[bytes], whole: bool):
        self.files, self.whole = files, whole
        self.payload, self.media, self.tensors = hashlib.sha256(), hashlib.sha256(), []
        self.payload_bytes = self.media_bytes = self.width = self.height = self.crc = 0
        self.tail, self.sums = b"", np.zeros(3, np.int64)

    def add(self, data: bytes, image: Image, coefs: np.ndarray) -> None:
        back, tensor = payload_of(image, coefs), rgb(image, coefs)
        self.payload.update(back)
        self.media.update(data)
        self.payload_bytes, self.media_bytes, self.tail = self.payload_bytes + len(back), self.media_bytes + len(data), (self.tail + back)[-32:]
        self.width, self.height = image.width, self.height + image.height
        raw = tensor.tobytes()
        self.sums, self.crc = self.sums + tensor.reshape(-1, 3).sum(axis=0, dtype=np.int64), zlib.crc32(raw, self.crc)
        if self.whole:
            self.tensors.append(raw)

    def feature(self) -> str:
        return f"{self.width}x{self.height}:{':'.join(map(str, self.sums * 100 // (self.width * self.height)))}:{self.crc:08x}"


def _shares(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """Ranges of items with at most `limit` bytes together, or one item."""
    out, at, held = [], 0, 0
    for i, n in enumerate(sizes):
        if i > at and held + n > limit:
            out.append((at, i))
            at, held = i, 0
        held += n
    return [*out, (at, len(sizes))] if sizes else []


def encoded(texts: list[bytes]) -> list[list[bytes]]:
    """The files of each text, made from about LIMIT bytes of payload at a time however long one is."""
    jobs = [(i, part) for i, t in enumerate(texts) for part in parts_of(padded(t))]
    out: list[list[bytes]] = [[] for _ in texts]
    for lo, hi in _shares([len(p) for _, p in jobs], LIMIT):
        for (i, _), data in zip(jobs[lo:hi], encode([p for _, p in jobs[lo:hi]])):
            out[i].append(data)
    return out


def decoded(files: list[list[bytes]], whole: bool = False) -> list[Row]:
    """What the texts' files hold, read from about LIMIT bytes of them at a time."""
    rows = [Row(own, whole) for own in files]
    jobs = [(r, data) for r in rows for data in r.files]
    for lo, hi in _shares([len(d) for _, d in jobs], LIMIT):
        images, coefs = coefficients([d for _, d in jobs[lo:hi]])
        for (row, data), image in zip(jobs[lo:hi], images):
            row.add(data, image, coefs)
    return rows


def stored_rows(texts: list[bytes], whole: bool = False) -> list[Row]:
    return decoded(encoded(texts), whole)


def media(docs: DataFrame) -> DataFrame:
    """doc_id, media (progressive JPEG of the text's padded UTF-8; beyond PART bytes, files one after the other), width, height, rgb (the decoded tensor's bytes, row by row).

    Null text counts as empty (a payload of fill alone); repeated rows repeat; a null id stays null; an empty table gives
    no rows; other columns aren't read.
    """

    def run(batches):
        for batch in bounded(batches, limit=LIMIT):
            rows = stored_rows([t.encode() for t in texts_of(batch).to_pylist()], whole=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b"".join(r.files) for r in rows], pa.binary()), pa.array([r.width for r in rows], pa.int32()), pa.array([r.height for r in rows], pa.int32()), pa.array([b"".join(r.tensors) for r in rows], pa.binary())], names=["doc_id", "media", "width", "height", "rgb"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, media binary, width int, height int, rgb binary")


STORED = "doc_id long, n_bytes long, files array<binary>"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def write_media(docs: DataFrame, path: str) -> str:
    """Writes doc_id, n_bytes and files (the progressive JPEG files of each text) as Parquet and returns the path; odd rows as in media()."""

    def run(batches):
        for batch in bounded(batches, limit=LIMIT):
            texts = [t.encode() for t in texts_of(batch).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(encoded(texts), pa.list_(pa.binary()))], names=["doc_id", "n_bytes", "files"])

    only(docs, "doc_id", "text").mapInArrow(run, STORED).write.option("compression", "zstd").parquet(path)
    return path


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The features of what write_media() wrote, from the stored bytes alone."""

    def run(batches):
        for batch in batches:
            for lo, hi in _shares(batch.column("n_bytes").to_pylist(), LIMIT):
                own = batch.slice(lo, hi - lo)
                rows = decoded(own.column("files").to_pylist())
                columns = [[r.payload_bytes for r in rows], [r.payload.hexdigest() for r in rows], [zlib.crc32(r.tail) for r in rows], [r.media_bytes for r in rows], [r.media.hexdigest() for r in rows], [r.feature() for r in rows]]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("n_bytes"), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return spark.read.schema(STORED).parquet(path).mapInArrow(run, FEATURES)


def features(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature of every row; odd rows as in media().

    The files are written below the scratch folder and read back; the payload comes from their coefficients. feature is the tensor's size, channel
    means in 1/100 and crc32.
    """
    spark = docs.sparkSession
    return read_features(spark, write_media(docs, scratch(spark, "media")))
