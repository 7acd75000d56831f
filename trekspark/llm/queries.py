"""The numbered queries of the training-data operators, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op2_content_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .store import content_addressed

    return content_addressed(documents(spark, sf_dir), vocabulary())


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(documents(spark, sf_dir), vocabulary())


def op4_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixtree import score

    return score(documents(spark, sf_dir))


def op5_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jpeg import features

    return features(documents(spark, sf_dir))


def op8_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(documents(spark, sf_dir))


def op6_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import digests

    return digests(documents(spark, sf_dir), vocabulary())


def op1_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import predict

    return predict(documents(spark, sf_dir))


def op7_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import verdicts

    return verdicts(documents(spark, sf_dir))


def op9_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import grouped

    return grouped(documents(spark, sf_dir))


def op10_shape_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find

    return find(documents(spark, sf_dir))


def op11_suffix_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resample import resample

    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_dense_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .maintext import main_text

    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_radix_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the ids divisible by 50; ids divisible by 7 first get the next label, as planted mistakes."""
    from pyspark.sql import functions as F

    from .negatives import mine

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_families, op2_content_store, op3_pattern_packing, op4_suffix_tree, op5_progressive_jpeg, op6_backtracking_bpe, op7_rule_ledger, op8_patience_licenses, op9_hamming_join, op10_shape_crf, op11_suffix_resampling, op12_dense_lines, op13_radix_negatives, pipeline)}


WORD = r"[^\x20\x09-\x0D]+"


def _ledger_sql() -> str:
    """The rule ledger in SQL, from the rules' own conditions."""
    from . import quality

    symbols = "".join(quality.SYMBOLS)
    without = lambda v, pattern: f"length({v}) - length(regexp_replace({v}, '{pattern}', '', 'g'))"
    bits = " + ".join(f"CASE WHEN {rule} THEN {quality.bit(name)} ELSE 0 END" for name, rule in quality.RULES.items())
    return f"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM documents),
j AS (SELECT *, array_to_string(ws, '') AS js FROM w),
r AS (SELECT doc_id, i, ws[i:i + 7] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)), p AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM r) WHERE c > 1),
v AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM p, range(0, 8) o(k) GROUP BY doc_id),
m AS (SELECT j.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(js) AS BIGINT) AS word_chars, CAST({without('t', '[' + symbols + ']')} AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
 CAST(coalesce(v.n, 0) AS BIGINT) AS n_repeat_words, CAST({without('js', '[A-Za-z\\x{80}-\\x{10FFFF}]+')} AS BIGINT) AS n_letters, CAST({without('js', '[A-ZÀ-ÖØ-Þ]+')} AS BIGINT) AS n_upper, CAST(len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS BIGINT) AS n_stutter FROM j LEFT JOIN v USING (doc_id)),
f AS (SELECT *, CAST({bits} AS BIGINT) AS failed FROM m)
SELECT *, failed & {quality.mask('base')} <> 0 AS base_failed, failed & {quality.mask('base') | quality.mask(quality.CURRENT)} = 0 AS kept FROM f"""


def _groups_sql() -> str:
    """Near-duplicate groups over all pairs that share a shingle; texts are unique by doc_id."""
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5) UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM x JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * shared >= 75 * (p.n + q.n - shared)), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
c AS (SELECT doc_id AS v, doc_id AS r FROM documents UNION SELECT c.v, e.b FROM c JOIN e ON c.r = e.a),
o AS (SELECT v AS doc_id, min(r) AS component_id FROM c GROUP BY v)
SELECT o.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, o.doc_id = component_id AS kept FROM o LEFT JOIN n USING (doc_id)"""


#: The generator polynomial of CRC-32, reflected.
POLYNOMIAL = 0xEDB88320


def _resampling_sql() -> str:
    """Hashed words, gains, noise and ranks; each different word's CRC-32 is folded from its bytes with a table made by the same rule."""
    bit = f"list_reduce(range(0, 8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, {POLYNOMIAL}) ELSE a >> 1 END, i)"
    words = lambda t, i: f"SELECT {i}, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM {t}"
    return f"""WITH tb AS (SELECT list({bit} ORDER BY i) AS tb FROM range(0, 256) r(i)),
d AS ({words("documents", "doc_id")}), g AS ({words("benchmark", "item_id")}),
u AS (SELECT DISTINCT w FROM (SELECT w FROM d UNION ALL SELECT w FROM g)),
v AS (SELECT w, hex(encode(w)) AS h FROM u),
k AS (SELECT w, xor(list_reduce(list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT)), lambda c, b: xor(c >> 8, tb[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS b FROM v, tb),
s AS (SELECT b, count(*) AS n FROM d JOIN k USING (w) GROUP BY b), t AS (SELECT b, count(*) AS n FROM g JOIN k USING (w) GROUP BY b),
z AS (SELECT (SELECT count(*) FROM d) AS sa, (SELECT count(*) FROM g) AS ta),
gain AS (SELECT s.b, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (sa + 10000) AS DOUBLE) / CAST((s.n + 1) * (ta + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (b), z),
f AS (SELECT doc_id, count(*) AS n, sum(gain) AS total FROM d JOIN k USING (w) JOIN gain USING (b) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END AS BIGINT) AS weight FROM documents LEFT JOIN f USING (doc_id)),
x AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM m),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM x WHERE n_features >= 20)
SELECT x.*, CASE WHEN rank <= 10 * n // 100 THEN CAST(rank AS BIGINT) END AS rank FROM x LEFT JOIN r USING (doc_id)"""


#: What these tables' pages come to by a plainer way: the blocks of the article element, with its few character references put in place.
PAGES_SQL = r"""WITH b AS (SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '<article[^>]*>(.*?)</article>', 1, 's'), '</?(?:h1|p)(?:\s[^>]*)?>') AS parts FROM pages),
t AS (SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#x27;', ''''), '&amp;?', '&', 'g')) AS parts FROM b),
c AS (SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(regexp_replace(x, '[\s\x0B\x1C-\x1F\x85\p{Z}]+', ' ', 'g'), '^ | $', '', 'g')) AS parts FROM t),
j AS (SELECT page_id, url, coalesce(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)), '') AS text FROM c)
SELECT *, CAST(length(text) AS BIGINT) AS n_chars FROM j"""

NEGATIVES_SQL = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
 WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT p.*, s.other AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other) AS rank FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can say the query. Token ids, fitted models and JPEG files can't be; tests hold those to brute force."""
    return {"op7_rule_ledger": _ledger_sql(), "op9_hamming_join": _groups_sql(), "op11_suffix_resampling": _resampling_sql(), "op12_dense_lines": PAGES_SQL, "op13_radix_negatives": NEGATIVES_SQL}
