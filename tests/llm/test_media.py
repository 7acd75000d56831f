"""Progressive JPEG: round trips, general scans from a plain encoder, colours and odd rows."""

import hashlib
import struct

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from trekspark.llm import jpeg

from .conftest import ODD


@settings(max_examples=25, deadline=None)
@given(st.lists(st.binary(max_size=1500), min_size=1, max_size=4))
def test_payloads_come_back(texts):
    payloads = [jpeg.padded(t) for t in texts]
    images, coefs = jpeg.coefficients(jpeg.encode(payloads))
    assert [jpeg.payload_of(i, coefs) for i in images] == payloads


class Writer:
    """A plain bit-by-bit progressive encoder of one grey component, with runs of empty blocks, for the decoder's sake."""

    def __init__(self):
        self.bits = ""

    def symbol(self, code, s):
        value, n = code[2][s]
        self.bits += format(value, f"0{n}b")

    def extra(self, v, n):
        self.bits += format(v, f"0{n}b") if n else ""

    def data(self):
        b = self.bits + "1" * (-len(self.bits) % 8)
        return bytes(int(b[i : i + 8], 2) for i in range(0, len(b), 8)).replace(b"\xff", b"\xff\x00")


AC = jpeg.huffman({r << 4 | s: 9 for r in range(16) for s in range(11)})


def magnitude(v, n):
    return v if v >= 0 else v + (1 << n) - 1


def first_scan(blocks, ss, se, al):
    w, run = Writer(), 0

    def flush():
        nonlocal run
        if run:
            n = run.bit_length() - 1
            w.symbol(AC, n << 4)
            w.extra(run - (1 << n), n)
            run = 0

    for b in blocks:
        zeros, wrote = 0, False
        for k in range(ss, se + 1):
            v = int(np.sign(b[k])) * (abs(int(b[k])) >> al)
            if v == 0:
                zeros += 1
                continue
            flush()
            while zeros > 15:
                w.symbol(AC, 0xF0)
                zeros -= 16
            n = abs(v).bit_length()
            w.symbol(AC, zeros << 4 | n)
            w.extra(magnitude(v, n), n)
            zeros, wrote = 0, True
        if zeros:
            run += 1
    flush()
    return w.data()


def refine_scan(blocks, ss, se, al):
    w, run, pending = Writer(), 0, ""

    def flush():
        nonlocal run, pending
        if run:
            n = run.bit_length() - 1
            w.symbol(AC, n << 4)
            w.extra(run - (1 << n), n)
            w.bits += pending
            run, pending = 0, ""

    for b in blocks:
        a = [abs(int(v)) >> al for v in b]
        last = max((k for k in range(ss, se + 1) if a[k] == 1), default=-1)
        zeros, held = 0, ""
        for k in range(ss, se + 1):
            if a[k] == 0:
                zeros += 1
                continue
            while zeros > 15 and k <= last:
                flush()
                w.symbol(AC, 0xF0)
                w.bits += held
                zeros, held = zeros - 16, ""
            if a[k] > 1:
                held += str(a[k] & 1)
                continue
            flush()
            w.symbol(AC, zeros << 4 | 1)
            w.bits += "1" if b[k] > 0 else "0"
            w.bits += held
            zeros, held = 0, ""
        if zeros or held:
            run += 1
            pending += held
    flush()
    return w.data()


def grey_file(blocks, wide, high):
    dc = jpeg.DC_CODE
    w, before = Writer(), 0
    for b in blocks:
        v = int(b[0]) >> 1
        n = abs(v - before).bit_length()
        w.symbol(dc, n)
        w.extra(magnitude(v - before, n), n)
        before = v
    table = lambda kind, code: bytes([kind << 4]) + code[0] + bytes(code[1])
    out = b"\xff\xd8" + jpeg._segment(0xDB, b"\0" + b"\1" * 64) + jpeg._segment(0xC2, struct.pack(">BHHB", 8, 8 * high, 8 * wide, 1) + bytes([1, 0x11, 0])) + jpeg._segment(0xC4, table(0, dc) + table(1, AC))
    one = [(1, 0, 0)]
    out += jpeg._start(one, 0, 0, 0, 1) + w.data()
    for ss, se in ((1, 20), (21, 63)):
        out += jpeg._start(one, ss, se, 0, 2) + first_scan(blocks, ss, se, 2)
    for al in (1, 0):
        out += jpeg._start(one, 1, 63, al + 1, al) + refine_scan(blocks, 1, 63, al)
    low = Writer()
    low.bits = "".join(str(int(b[0]) & 1) for b in blocks)
    return out + jpeg._start(one, 0, 0, 1, 0) + low.data() + b"\xff\xd9"


def test_general_scans_are_accumulated():
    rng = np.random.default_rng(5)
    for density in (0.02, 0.2, 0.7):
        files, want = [], []
        for wide, high in ((3, 2), (5, 4), (1, 1)):
            blocks = np.where(rng.random((wide * high, 64)) < density, rng.integers(-60, 61, (wide * high, 64)), 0).astype(np.int16)
            blocks[:, 0] = rng.integers(-100, 100, wide * high)
            blocks[rng.random(len(blocks)) < 0.4, 1:] = 0
            files.append(grey_file(blocks, wide, high))
            want.append(blocks)
        images, coefs = jpeg.coefficients(files)
        assert (coefs == np.concatenate(want)).all()
        assert [(i.width, i.height) for i in images] == [(24, 16), (40, 32), (8, 8)]


def test_transform_and_colours():
    image = jpeg.Image(16, 16, [(1, 2, 2, 0), (2, 1, 1, 0), (3, 1, 1, 0)], {0: np.ones(64, np.int64)}, b"", [0, 4, 5])
    coefs = np.zeros((6, 64), np.int16)
    coefs[:4, 0] = 8 * (76 - 128)
    coefs[4, 0], coefs[5, 0] = 8 * (85 - 128), 8 * (255 - 128)
    tensor = jpeg.rgb(image, coefs)
    assert tensor.shape == (16, 16, 3) and (abs(tensor.astype(int) - [254, 0, 0]) <= 1).all()
    rng = np.random.default_rng(1)
    coefs[:4] = rng.integers(-30, 30, (4, 64))
    u = np.arange(8)
    basis = np.cos((2 * u[None] + 1) * u[:, None] * np.pi / 16) * np.where(u == 0, np.sqrt(0.125), 0.5)[:, None]
    grid = np.zeros(64)
    grid[jpeg.ZIGZAG] = coefs[0]
    want = np.clip(basis.T @ grid.reshape(8, 8) @ basis + 128, 0, 255)
    assert abs(jpeg.planes(image, coefs)[0][:8, :8] - want).max() <= 0.51


def test_features_of_odd_rows(odd):
    rows = jpeg.features(odd).collect()
    assert len(rows) == len(ODD)
    want = sorted((str(i), len(b := (t or "").encode()), hashlib.sha256(jpeg.padded(b)).hexdigest()) for i, t in ODD)
    assert sorted((str(r.doc_id), r.n_bytes, r.payload_sha256) for r in rows) == want
    same = {(r.media_sha256, r.feature) for r in rows if r.doc_id in (4, 7)}
    assert len(same) == 1 and jpeg.features(odd.limit(0)).count() == 0
    one = jpeg.media(odd.filter("doc_id = 2")).first()
    assert len(one.rgb) == 3 * one.width * one.height


def test_long_payloads_go_on_in_further_files(monkeypatch):
    text = "the river runs past the old mill ".encode() * 300
    whole = jpeg.stored_rows([text, b""], whole=True)
    monkeypatch.setattr(jpeg, "PART", 4 * jpeg.UNIT)
    monkeypatch.setattr(jpeg, "LIMIT", 6 * jpeg.UNIT)
    cut = jpeg.stored_rows([text, b""], whole=True)
    for a, b in zip(whole, cut):
        assert (a.payload.hexdigest(), a.tail, a.payload_bytes) == (b.payload.hexdigest(), b.tail, b.payload_bytes)
    assert len(cut[0].files) == -(-len(text) // (4 * jpeg.UNIT)) and len(whole[0].files) == 1
