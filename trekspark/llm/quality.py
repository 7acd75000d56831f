"""Quality rules as a bitmask ledger, in DataFrame functions alone.

ledger() measures every text once and writes one bit per failed rule beside the measurements. Policies are masks over
those bits with a version each: applying one, comparing two or asking what a rule removes by itself needs no text any
more, only bitwise arithmetic over the ledger.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, numbered, only

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Each rule with its bit in order, and when a text fails it. The order is part of the ledger's format: add at the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "20 * n_symbols > word_chars",
    "repeated_lines": "n_lines >= 4 AND 20 * n_dup_lines > 7 * n_lines",
    "long_words": "word_chars > 40 * n_words",
    "shouting": "n_upper * 10 > 6 * n_letters",
    "no_letters": "n_words > 0 AND n_letters = 0",
    "stutter": "10 * n_stutter > 3 * n_words",
}
#: Versioned policies: the rules whose failure removes a text.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols", "repeated_lines", "long_words", "no_letters"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(map(bit, POLICIES[policy]))


def _octets_without(text: str, symbols: str) -> str:
    return f"octet_length({reduce(lambda inner, s: f'replace({inner}, {chr(39)}{s}{chr(39)})', symbols, text)})"


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each text: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_letters, n_upper, n_stutter (words equal to the word before).

    A null or empty text has zeros throughout. Windows of words are compared by 64-bit hashes of word hashes within one
    text, so two different windows of one text are taken for equal with a chance of about 1e-11 for 20,000 words.
    """
    space = "' \t\n\x0b\x0c\r'"  # the characters themselves: SQL literals know no escape for some of them
    t = only(docs, "doc_id", "text").select("doc_id", F.expr("coalesce(text, '')").alias("t"))
    t = t.withColumn("trimmed", F.expr(f"trim(BOTH {space} FROM t)"))
    t = t.withColumn("words", F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", f"[{SPACE_CLASS}]+")))
    t = t.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]")))
    t = t.withColumn("joined", F.array_join("words", ""))
    t = t.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length("joined").cast("long").alias("word_chars"),
        F.expr(f"cast(octet_length(t) - {_octets_without('t', SYMBOLS)} as long)").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as long)").alias("n_dup_lines"),
        F.expr("cast(length(joined) - length(regexp_replace(joined, '[A-Za-z\\\\x{80}-\\\\x{10FFFF}]+', '')) as long)").alias("n_letters"),
        F.expr("cast(length(joined) - length(regexp_replace(joined, '[A-ZÀ-ÖØ-Þ]+', '')) as long)").alias("n_upper"),
        F.transform("words", lambda x: F.xxhash64(x)).alias("h"),
    )
    windows = F.expr(f"transform(sequence(0, size(h) - {WINDOW}), i -> xxhash64({', '.join(f'get(h, i + {k})' for k in range(WINDOW))}))")
    t = t.withColumn("w", F.when(F.size("h") >= WINDOW, windows))
    twice = F.size("w") > F.size(F.array_distinct("w"))
    t = t.withColumn("s", F.when(twice, F.array_sort(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    t = t.withColumn("s", F.expr("array_sort(transform(filter(s, (e, k) -> coalesce(get(s, k - 1).x = e.x, false) OR coalesce(get(s, k + 1).x = e.x, false)), e -> e.i))"))
    covered = F.expr(f"aggregate(s, named_struct('n', 0L, 'e', 0), (a, i) -> named_struct('n', a.n + (i + {WINDOW} - greatest(i, a.e)), 'e', i + {WINDOW}), a -> a.n)")
    stutter = F.expr("cast(size(filter(h, (x, i) -> coalesce(x = get(h, i - 1), false))) as long)").alias("n_stutter")
    values = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"), "n_letters", "n_upper", stutter]
    # One row in, one row out; but a filter above isn't rewritten in terms of the text, rule by rule, as through a projection.
    return t.select("doc_id", F.inline(F.array(F.struct(*values))))


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements with `failed`, the bits of the rules that each text fails.

    Null or empty texts fail few_words alone; repeated rows and null ids are kept as rows; an empty table gives none;
    other columns aren't read.
    """
    bits = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.expr(rule), F.lit(bit(name)).cast("long")).otherwise(F.lit(0).cast("long")) for name, rule in RULES.items()])
    return measured(docs).withColumn("failed", bits)


def passes(policy: str = CURRENT) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of the policy: failed (texts that fail it), alone (texts that only this rule removes), kept (by the policy) and kept_without (if the rule is left out)."""
    m = mask(policy)
    under = F.col("failed").bitwiseAND(F.lit(m).cast("long"))
    groups = ledger.groupBy(under.alias("bits")).count()  # one row per set of failed rules
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("b")) for r in POLICIES[policy]])).alias("r")
    each = groups.select("bits", "count", rules).select("bits", "count", "r.*")
    total = lambda when: F.sum(F.when(when, F.col("count")).otherwise(0)).alias
    return each.groupBy("rule").agg(total(F.col("bits").bitwiseAND(F.col("b")) != 0)("failed"), total(F.col("bits") == F.col("b"))("alone"), total(F.col("bits") == 0)("kept"), total((F.col("bits") == 0) | (F.col("bits") == F.col("b")))("kept_without"))


def verdicts(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger's rows with base_failed and kept (not base_failed and passed by the policy)."""
    base = ~passes("base")
    return ledger(docs).withColumn("base_failed", base).withColumn("kept", ~base & passes(policy))


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that the policy keeps, with all their columns as they were, whatever their names.

    A null or empty text fails few_words and goes. Each row is judged by its own text alone, so repeated rows stay or go
    together and null ids don't matter; an empty table stays empty.
    """
    # The whole row travels as the ledger's id, so no join brings the columns back.
    rows, name = numbered(docs)
    carried = rows.select(F.struct(*rows.columns).alias("doc_id"), F.col(name["text"]).alias("text"))
    fails = F.col("failed").bitwiseAND(F.lit(mask(policy) | mask("base")).cast("long"))
    return ledger(carried).filter(fails == 0).select("doc_id.*").toDF(*docs.columns)
