"""Token ids, the content-addressed store, packing and the backtracking encoder, against the library and round trips."""

import hashlib
import random
import shutil
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trekspark.llm import bpe, packing, store, tokens
from trekspark.llm.common import bounded

from .conftest import ODD

ALPHABET = st.text(alphabet="abehtz AEé'.!,|<>\n\t0́日<endoftext>|", max_size=40)


@pytest.fixture(scope="module")
def encoder(vocab):
    return tokens.Encoder(vocab)


@pytest.fixture(scope="module")
def model(vocab):
    return bpe.Backtracker(vocab)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_batch_is_the_library(encoder, library):
    texts = [t or "" for _, t in ODD[:13]] + ["<|startoftext|>x<|endoftext|>.", "it's 'S don''t", "a.b,c. d.. e.\nf."]
    ids, at = encoder.batch(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == ids_of(library, t)


def test_memory_bound_changes_nothing(vocab, library):
    small = tokens.Encoder(vocab)
    small.words.memo = 3
    for part in (["one two three four"], ["two five six one"], ["seven one"]):
        ids, _ = small.batch(pa.array(part))
        assert ids.tolist() == ids_of(library, part[0])


def test_backtracking_is_the_library(model, library):
    rng = random.Random(7)
    names = [k.replace("</w>", "") for k in library.get_vocab()]
    words = ["".join(rng.choice("abcdefghinorst") for _ in range(rng.randint(1, 18))) for _ in range(3000)]
    words += ["".join(rng.choice(names) for _ in range(rng.randint(1, 3))) for _ in range(1500)] + [t or "" for _, t in ODD[:13]] + ["a" * 500, "ha" * 300]
    for w, got in zip(words, model.encode_pieces(words)):
        assert got == ids_of(library, w), w


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_any_text(model, encoder, library, text):
    want = ids_of(library, text)
    assert model.encode_text(text) == want
    assert encoder.batch(pa.array([text]))[0].tolist() == want
    assert model.decode(np.array(want, np.int64), np.array([0, len(want)]))[0].decode() == library.decode(want, skip_special_tokens=False)


def test_digests_of_odd_rows(odd, vocab, library):
    got = bpe.digests(odd, vocab).collect()
    assert len(got) == len(ODD)
    want = sorted((str(i), len(x := ids_of(library, t)), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(library.decode(x, skip_special_tokens=False).encode()).hexdigest()) for i, t in ODD)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe.digests(odd.limit(0), vocab).count() == 0
    assert {tuple(r.ids) for r in bpe.encode(odd.filter("doc_id = 4"), vocab).collect()} == {tuple(ids_of(library, ODD[3][1]))}


def test_store_reads_back_what_was_written(spark, odd, vocab, library, tmp_path):
    path = store.write_store(odd, vocab, str(tmp_path / "s"))
    order = sorted((i is not None, i or 0, ids_of(library, t) + [2]) for i, t in ODD)
    got = {r.start: r for r in store.checksums(spark, path).collect()}
    back = {r.start: r for r in store.reconstruct(spark, path).collect()}
    assert len(got) == len(ODD)
    start = 0
    for k in range(len(order)):
        row = got[start]
        raw = bytes(back[start].ids)
        assert (zlib.crc32(raw), len(raw)) == (row.ids_crc32, 4 * row.n_tokens)
        start += row.n_tokens
    want = sorted((str(i), zlib.crc32(np.array(ids_of(library, t) + [2], "<u4").tobytes())) for i, t in ODD)
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got.values()) == want
    ids = [r.doc_id for _, r in sorted(got.items())]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert store.verify(spark, path).count() == 0
    assert store.checksums(spark, store.write_store(odd.limit(0), vocab, str(tmp_path / "e"))).count() == 0


def test_store_shares_chunks_and_finds_damage(spark, vocab, tmp_path):
    text = " ".join(f"word{i % 977}" for i in range(6000))
    df = spark.createDataFrame([(1, text), (2, "a new beginning " + text), (3, text)], "doc_id long, text string")
    path = store.write_store(df, vocab, str(tmp_path / "s"))
    chunks = store.read_chunks(spark, path).count()
    used = sum(len(r.digests) for r in store.read_recipes(spark, path).collect())
    assert chunks < used / 2
    hit = spark.read.parquet(f"{path}/recipes")
    broken = hit.selectExpr("part", "doc_id", "start", "n_tokens", "reverse(digests) AS digests", "lens", "root")
    broken.write.parquet(f"{path}/other")
    with pytest.raises(Exception, match="Merkle"):
        store._checked(spark.read.schema(store.RECIPE).parquet(f"{path}/other")).count()


def test_missing_chunks_lengths_and_parts_raise_on_reading_back(spark, vocab, tmp_path):
    df = spark.createDataFrame([(1, "one short text"), (2, "another short text")], "doc_id long, text string")
    path = store.write_store(df, vocab, str(tmp_path / "s"))

    def copy(name, folder, change):
        other = shutil.copytree(path, tmp_path / name)
        kept = change(spark.read.parquet(f"{path}/{folder}"))
        shutil.rmtree(other / folder)
        kept.write.parquet(f"{other}/{folder}")
        return str(other)

    lost = copy("chunk", "stored/kind=1", lambda x: x.limit(1))  # each document has one chunk
    for read in (store.checksums, store.reconstruct):
        with pytest.raises(Exception, match="a chunk is missing"):
            read(spark, lost).collect()
    with pytest.raises(Exception, match="number of ids"):
        store.checksums(spark, copy("long", "recipes", lambda x: x.withColumn("n_tokens", x.n_tokens + 1))).collect()
    with pytest.raises(Exception, match="manifest"):
        store.checksums(spark, copy("less", "recipes", lambda x: x.filter("doc_id = 1"))).collect()
    with pytest.raises(Exception, match="manifest"):
        store.checksums(spark, copy("none", "recipes", lambda x: x.limit(0))).collect()


def test_crc_parts_make_the_whole():
    a, b = b"hello", b"wider world" * 99
    parts = store.shifted(np.array([zlib.crc32(a), zlib.crc32(b)], np.uint32), np.array([len(b), 0]))
    assert int(parts[0] ^ parts[1]) == zlib.crc32(a + b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_plan_holds_every_piece(lengths):
    counts = np.bincount(lengths, minlength=65) if lengths else np.zeros(65, int)
    made = packing.plan(counts, 64)
    held = np.zeros(65, int)
    for shape, k in made:
        assert sum(shape) <= 64
        for v in shape:
            held[v] += k
    assert (held == counts).all()
    assert sum(k for _, k in made) <= max(sum(k for _, k in packing.best_fit(counts, 64)) * 1.15 + 1, 1)


def test_packing_of_odd_rows(odd, vocab, library):
    got = packing.pack(odd, vocab).toPandas()
    want = sorted((str(i), k // 2048, k, len(x[k : k + 2048]), zlib.crc32(np.array(x[k : k + 2048], "<u4").tobytes())) for i, t in ODD for x in [ids_of(library, t) + [0]] for k in range(0, len(x), 2048))
    assert sorted((str(None if np.isnan(a) else int(a)), b, c, d, e) for a, b, c, d, e in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)) == want
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *np.cumsum(own["length"])[:-1]] and own["length"].sum() <= 2048
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 2048) + 1
    assert packing.pack(odd.limit(0), vocab).count() == 0


def test_bounded_batches_keep_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["x" * (i * 7 % 90) for i in range(49)] + [None])], names=["doc_id", "text"])
    parts = list(bounded(iter([batch, batch.slice(0, 0), batch]), limit=100))
    assert [v for p in parts for v in p.column(0).to_pylist()] == [*range(50), *range(50)]
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 100 for p in parts)


def test_other_vocabularies_are_encoded_whole_or_refused(spark, docs, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["Two  Words\nand Tabs\t.", "", "it's <|endoftext|> done", "ÜBER é"]
    ids, at = tokens.Encoder(path).batch(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids
    with pytest.raises(ValueError):
        bpe.Backtracker(path)
    with pytest.raises(ValueError):
        store.write_store(docs, path, str(tmp_path / "narrow"), width=1)
