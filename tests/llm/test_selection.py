"""Resampling, main text of pages, hard negatives."""

import hashlib
import html as entities
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHES
from tests.test_oracle import TABLES, plain
from trekspark.llm import maintext, negatives, queries, resample

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", ["op11_suffix_resampling", "op12_dense_lines", "op13_radix_negatives"])
def test_same_rows_as_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    clean = lambda d: d.astype(object).where(d.notna(), None)
    got, want = queries.queries()[name](spark, sf).toPandas(), con.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got)
    assert plain(clean(got)) == plain(clean(want))


# --- resampling ----------------------------------------------------------------------------------------------------


def words(text):
    return WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def grams(text, longest):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def brute_resample(rows, target, longest, buckets, share, least):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for _, text in rows:
        for g in grams(text, longest):
            s[bucket(g)] += 1
    for text in target:
        for g in grams(text, longest):
            t[bucket(g)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s.tolist(), t.tolist())]
    out = []
    for i, text in rows:
        own = [gain[bucket(g)] for g in grams(text, longest)]
        weight = sum(own) // len(own) if own else 0
        h = None if i is None else int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((k for k, (i, text) in enumerate(rows) if i is not None and len(words(text)) >= least), key=lambda k: (-out[k][3], out[k][0], out[k][1], out[k][2]))
    rank = {k: place for place, k in enumerate(fit[: share * len(fit) // 100], 1)}
    return sorted(((*o, rank.get(k)) for k, o in enumerate(out)), key=str)


@pytest.mark.parametrize("longest,buckets,share,least", [(1, 10_000, 10, 20), (3, 97, 60, 1), (2, 7, 100, 2)])
def test_resampling_is_the_brute_force_one(spark, odd, longest, buckets, share, least):
    rng = random.Random(longest)
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(100 + i, " ".join(rng.choices(["Un", "deux", "trois", "ça", "9"], k=rng.randrange(60)))) for i in range(60)]
    rows += [(500, "one two three four " * 8)] * 40  # one id holds a third of all rows
    target = ["un deux trois", "", None, "quatre un"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("a clash"))
    got = resample.resample(docs, spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"), longest, buckets, share, least)
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(rows, target, longest, buckets, share, least)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aAbB é\n\x00/0", max_size=30), max_size=6), st.integers(1, 4))
def test_runs_by_lcp_are_all_runs_of_words(texts, longest):
    found, n, counts, hashed = resample.features(pa.array(texts, pa.string()), longest, 1 << 30)
    every = [grams(t, longest) for t in texts]
    assert found.tolist() == [zlib.crc32(g.encode()) % (1 << 30) for gs in every for g in gs]
    assert n.tolist() == [len(g) for g in every] and counts.tolist() == [len(words(t)) for t in texts]
    assert hashed == len({g for gs in every for g in gs})  # once a run, however often it occurs


def test_a_sample_carries_all_columns(spark, odd):
    target = spark.createDataFrame([(1, "river mill bridge")], "item_id long, text string")
    rows = resample.sample(odd, target, share=50)
    assert rows.columns == odd.columns and 0 < rows.count() < odd.count()
    assert resample.sample(odd.limit(0), target).count() == 0
    assert resample.resample(odd, target.limit(0)).count() == odd.count()


# --- main text -----------------------------------------------------------------------------------------------------

FILL = "Slow water turns the wheel and the wheel turns the stone, as it has done for two hundred years by now. "


def page(body):
    return f"<!DOCTYPE html><html><head><title>A title</title><style>p{{}}</style><script>var x='<p>no</p>';</script></head><body>{body}</body></html>"


APART = [
    "<nav><ul><li><a href=/>Home</a></li><li><a href=/x>All the many things that one may find on this long and winding site</a></li></ul></nav>", "<header><h2>The Daily Mill, all the news about mills since 1871</h2></header>",
    "<footer>&copy; 2024 The Daily Mill and its owners. All rights are reserved by them.</footer>", "<aside><p>More about rivers, weirs and locks in our big series on inland water.</p></aside>",
    f"<div class='cookie-notice'>We use cookies. {FILL}</div>", f"<div id=sidebar_left><p>{FILL}</p></div>", f"<div class=ad>{FILL}</div>", f"<form><p>{FILL}</p><label>Your name <input name=n></label><textarea>text</textarea></form>",
    f"<section id=comments><h3>Comments</h3><article><p>{FILL}</p></article></section>", f"<div role='complementary'>{FILL}</div>", f"<script>document.write('{FILL}')</script><style>.x{{}}</style><!-- {FILL} -->", f"<div hidden>{FILL}</div>",
]
TEXT = ["Mills & rivers", FILL.strip(), "Ga.", "One two three. " + FILL.strip(), "a < b, it's “good” é", FILL.strip() + " Last."]
BODY = f"<h1>Mills &amp; <i>rivers</i></h1><p>{FILL}<p>Ga.</p><div><p>One\n two<br>three. <a href=/>{FILL}</a></p></div><ul><li>a &lt; b, it&#39;s &ldquo;good&rdquo;&nbsp;&eacute;</ul><blockquote>{FILL}<b>Last.</blockquote>"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><article class='post with-sidebar'>{}</article></main>", "<div class='content'>{}</div>", "<div id=wrap-with-sidebar><div class=entry>{}</div></div>"])
@pytest.mark.parametrize("before,after", [((0, 1), (2,)), ((0, 6), (8, 2)), ((4, 5, 10), (3, 7, 9, 11)), ((), ())])
def test_main_text_is_the_article_alone(wrap, before, after):
    html = page("".join(APART[i] for i in before) + wrap.format(BODY) + "".join(APART[i] for i in after))
    assert maintext.extract(html) == "\n".join(TEXT)


def test_broken_pages_are_read_to_their_end():
    assert maintext.extract(f"<title>T<head><p>{FILL}<div>{FILL}") in (FILL.strip() + "\n" + FILL.strip(), "")
    assert maintext.extract(f"<article><p>{FILL}</div></span></article></article><p>") == FILL.strip()
    assert maintext.extract("plain words alone") == "plain words alone"
    assert maintext.extract("<nav><a href=/>Home</a></nav>") == maintext.extract("") == maintext.extract(" <p> </p>") == ""
    assert maintext.extract("<article><p>&am</p><p>x</article>") == "&am\nx"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=ad>", "</div>", "<article>", "</article>", "<b", ">", "&amp;", "&", "word ", "<!--", "-->", "<script>", "</script>", "<li>", "<td>", "</nav>", "<nav>", "<![CDATA[", "<?x", "\n"]), max_size=40))
def test_no_page_breaks_it(parts):
    text = maintext.extract("".join(parts))
    assert text == "\n".join(" ".join(line.split()) for line in text.split("\n")) and "\n\n" not in text


def test_a_very_long_page_is_whole():
    rows = [f"{k} {FILL}".strip() for k in range(20_000)]
    assert maintext.extract(page(APART[0] + "<article>" + "".join(f"<p>{entities.escape(r)}" for r in rows) + "</article>" + APART[2])) == "\n".join(rows)


def test_smoothing_and_threshold_are_the_plain_ones():
    values = np.array([0, 0, 90.0, 60, 3, 120, 0, 0])
    kernel = np.exp(-np.arange(-2, 3) ** 2 / 2)
    wide = np.concatenate([[0, 0], values, [0, 0]])
    want = [float((wide[i : i + 5] * kernel / kernel.sum()).sum()) for i in range(8)]
    assert np.allclose(maintext.smoothed(values), want)
    assert maintext.dense(np.array(want)).tolist() == [w >= np.std(want) for w in want]


def test_pages_of_any_kind(spark):
    rows = [(1, "u", None, 5), (None, None, page(f"<article>{BODY}</article>"), 6), (2, "v", "", 7), (2, "v", "", 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = maintext.main_text(pages).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "", 0), (None, None, "\n".join(TEXT), len("\n".join(TEXT))), (2, "v", "", 0), (2, "v", "", 0)], key=str)
    assert maintext.main_text(pages.limit(0)).count() == 0


# --- hard negatives ------------------------------------------------------------------------------------------------


def brute_negatives(rows, every, positives, negatives_, low, high):
    one = {}
    for i, label, x in rows:
        if i is not None and label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            row = (label, [math.floor(256 * float(v)) for v in x])
            one[i] = min(one.get(i, row), row)
    out = []
    for a, (la, qa) in one.items():
        if a % every:
            continue
        scored = sorted(((sum(p * q for p, q in zip(qa, qb)), b, lb) for b, (lb, qb) in one.items() if b != a and len(qa) == len(qb)), key=lambda r: (-r[0], r[1]))
        for ps, p, _ in [r for r in scored if r[2] == la][:positives]:
            for rank, (ns, n, _) in enumerate([r for r in scored if r[2] != la and low * ps <= 100 * r[0] <= high * ps][:negatives_], 1):
                out.append((a, p, rank, n, ps, ns))
    return sorted(out)


@pytest.mark.parametrize("settings_", [{}, {"FEW": 0}, {"FEW": 0, "DIGIT": 2}, {"ANCHORS": 3, "CELLS": 50}])
def test_negatives_are_the_brute_force_ones(spark, monkeypatch, settings_):
    for name, value in settings_.items():
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(len(settings_) + 1)
    rows = [(int(i), int(rng.integers(3)), [float(v) for v in rng.normal(0, 0.5, 4).astype(np.float32)]) for i in range(150)]
    rows += [(200 + i, int(rng.integers(3)), [0.5, 0.25, 0.0, 1.0]) for i in range(80)]  # one vector for a third of all rows
    rows += [(None, 1, [1.0] * 4), (300, None, [1.0] * 4), (301, 1, None), (302, 1, [1.0, None, 0.0, 0.0]), (303, 1, [float("nan")] * 4), (304, 1, [float("inf")] * 4), (310, 1, [1.0] * 3), (320, 2, [1.0] * 3), (330, 2, []), (340, 2, []), (350, 1, [])]
    rows += [rows[10]] * 3 + [(20, 1, [9.0] * 4), (20, 0, [0.5] * 4)]
    df = spark.createDataFrame([(*r, *range(len(CLASHES))) for r in rows], "vec_id long, label int, embedding array<float>, " + ", ".join(f"`{c}` long" for c in CLASHES))
    got = negatives.mine(df, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 10, 5, 3, 50, 95)


def test_negatives_of_an_empty_table_and_of_scores_too_large(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(empty, F.col("vec_id") % 2 == 0).count() == 0
    huge = spark.createDataFrame([(0, [3e38], 1)], empty.schema)
    with pytest.raises(ValueError):
        negatives.mine(huge, F.col("vec_id") % 2 == 0)
