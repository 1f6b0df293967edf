"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the measurements
and one failure bit per rule. A policy is a named, versioned mask over the
bits: applying another version or computing an ablation (what a policy without
one rule would keep) reads the narrow ledger, never the texts again.

Words are runs of characters other than ASCII white space. ``n_repeat_words``
counts the words that lie in a 3-word window found twice or more in the text.
Windows are compared by 64-bit hashes inside one document: equal neighbours in
hash order give the repeated windows, whose positions give the covered words.
That stays within a row, so there is no shuffle, and takes n log n steps for a
text of n words.

Defined results: null or empty text measures 0 everywhere (and fails
``too_short``); every input row gives one row, repeated ids included; extra
columns are ignored; an empty table gives an empty ledger.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linecast.llm.common import SPACE

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 20
MAX_DUP_LINE_PERCENT = 30
MEAN_WORD_LENGTH = (2, 15)

BLANKS = " \t\n\x0b\x0c\r"


def _too_short() -> Column:
    return F.col("n_words") < MIN_WORDS


def _repetitive() -> Column:
    return 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")


def _symbols() -> Column:
    return 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words")


def _dup_lines() -> Column:
    return 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")


def _word_length() -> Column:
    lo, hi = MEAN_WORD_LENGTH
    return (F.col("word_chars") < lo * F.col("n_words")) | (F.col("word_chars") > hi * F.col("n_words"))


#: Rule name -> failure. A rule's bit is its place here; add new rules at the end.
RULES = {"too_short": _too_short, "repetitive": _repetitive, "symbols": _symbols, "dup_lines": _dup_lines, "word_length": _word_length}


def mask(*names: str) -> int:
    return sum(1 << list(RULES).index(n) for n in names)


POLICIES = {
    "base": mask("too_short", "repetitive"),
    "v1": mask("too_short", "repetitive", "symbols", "dup_lines", "word_length"),
}


def _covered(words: Column, grams: Column) -> Column:
    """Words in repeated windows, given the window hashes by position."""
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    # The positions of windows with an equal neighbour in hash order.
    let = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)
    at = lambda a: F.transform(
        F.filter(a, lambda x, k: ((k > 0) & (F.get(a, k - 1)["g"] == x["g"])) | (F.coalesce(F.get(a, k + 1)["g"] == x["g"], F.lit(False)))),
        lambda x: x["i"],
    )
    # Sorted starts s: the union of [s, s + 2] has 3 + sum(min(3, gaps)) words.
    union = lambda s: F.aggregate(
        s, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, x: F.struct((acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last")),
        lambda acc: acc["n"],
    )
    return let(placed, lambda a: union(F.sort_array(at(a))))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    trimmed = F.btrim(F.col("text"), F.lit(BLANKS))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    words = (
        docs.select(F.col(id_col).alias("id"), text.alias("text"))
        .select(
            "id",
            F.split(trimmed, SPACE).alias("words"), lines.alias("lines"),
            F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
            F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        )
    )
    n = F.when(F.col("word_chars") == 0, 0).otherwise(F.size("words"))
    grams = F.when(
        n >= 3,
        F.transform(F.sequence(F.lit(0), F.greatest(F.size("words"), F.lit(3)) - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    measured = words.select(
        "id", n.cast("long").alias("n_words"), "word_chars", "n_symbols", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "words", grams.alias("grams"),
    )
    repeat = F.when(F.size(F.array_distinct("grams")) < F.size("grams"), _covered(F.col("words"), F.col("grams"))).otherwise(0)
    return measured.select("id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", repeat.cast("long").alias("n_repeat_words")).withColumnRenamed("id", id_col)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and ``failed``: bit i set where rule i fails."""
    bits = [F.when(rule(), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measure(docs, id_col, text_col).withColumn("failed", failed.cast("long"))


def apply_policy(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """``entries`` with ``kept``: no rule of the policy fails."""
    return entries.withColumn("kept", F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0)


def ablation(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: rows it fails, rows it alone fails (kept without
    it), and rows the whole policy keeps. One aggregation to at most 2^rules
    distinct masks, then arithmetic on those."""
    m = POLICIES[policy]
    masks = entries.groupBy(F.col("failed").bitwiseAND(F.lit(m)).alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, name in enumerate(RULES) if m >> i & 1))
    hit = F.col("failed").bitwiseAND(F.col("r.bit"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    return (
        masks.withColumn("r", F.explode(rules)).groupBy(F.col("r.rule").alias("rule"))
        .agg(total(hit != 0).alias("fails"), total(F.col("failed") == F.col("r.bit")).alias("fails_alone"), total(F.col("failed") == 0).alias("kept_by_policy"))
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text,
         list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), g AS (
  SELECT rid, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), r AS (
  SELECT rid, gram FROM g GROUP BY rid, gram HAVING count(*) >= 2
), covered AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT g.rid, unnest([i, i + 1, i + 2]) AS p FROM g JOIN r USING (rid, gram)) GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered ON covered.rid = w.rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 30 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM m
"""
