"""Phrase collocation mining with mergeable Misra-Gries summaries.

Per language, a phrase of 2 to ``max_words`` words that occurs at least
``min_count`` times is a candidate. Cut after its first k words it has
l = f(first part), r = f(rest) and the score floor(1000 * a * n / (l * r)),
with a its own count and n all words of the language; the lowest-scoring cut
counts. A candidate goes if a longer candidate that holds it occurs (nearly) as
often. Texts are lower-cased (A-Z), split into pieces at punctuation and line
ends, and pieces into words at blanks; phrases lie within a piece.

1. *Summaries.* N-grams are hashed with their language and dealt to hash
   partitions, each for at most ``capacity`` * ``min_count`` / 2 of them on
   average. A task sums what is equal and sends each partition its counters. A
   partition merges them into one Misra-Gries summary whose capacity exceeds the
   partition's mass divided by ``min_count``: over capacity, the counter next in
   size is taken off all. What was taken off (``lost``) stays below
   ``min_count``, so every frequent n-gram keeps a counter; those whose counter
   plus ``lost`` reaches ``min_count`` survive.
   Words and pairs come first; longer n-grams are summarised only where all
   their pairs survive, since no part of a frequent phrase is rarer than it.
2. *Exact counts.* A second pass counts the n-grams that survive, as strings,
   summed per task and again per hash partition. Tasks know the survivors by a bitmap of bounded size (``MAX_BITS``); what it
   lets through by mistake is counted as well and falls at ``min_count``.
3. *Scores* are joins of the counts table with itself. Arithmetic is decimal
   with 38 digits, so products past 64 bits are exact.

A language's hot n-grams are summed in tasks before they travel; the report's
first rows are found per task before they meet (a window limit).

Defined results: null or empty text has no words; null ``lang`` counts as
``und``; repeated rows count as often as they come; extra columns are ignored; an
empty table, or one without a frequent phrase, gives an empty table. A score over
9.2e18 raises instead of being rounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linecast.llm.common import materialize
from linecast.llm.wordhash import Words, byte_set, mix, rolling, text_slices

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
#: Counters of a hash partition's summary.
CAPACITY = 50_000
#: N-grams that a task gathers before it sums and sends them.
GATHER = 4_000_000
#: Bits of the survivors' bitmap: per survivor, and at most (32 MB).
BITS_EACH, MAX_BITS = 16, 1 << 28

PIECE_ENDS = byte_set(b".,;:!?\n\x0b\x0c\r")
BLANKS = PIECE_ENDS | byte_set(b" \t")

_U = np.uint64
_PROBES = tuple(_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Grams:
    """N-grams of one slice of texts: hashes by length, within pieces."""

    def __init__(self, batch: pa.RecordBatch):
        self.words = w = Words(batch.column("text"), BLANKS, fold=True)
        langs = batch.column("lang").dictionary_encode()
        salt = np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8")) for x in langs.dictionary.to_pylist()] or [0], np.uint64)
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False)
        self.salt = salt[self.lang[w.row]] if len(w.row) else np.zeros(0, np.uint64)
        ends = np.cumsum(PIECE_ENDS[w.data])
        piece = ends[w.first] if len(w.first) else np.zeros(0, np.int64)
        # Both numbers never fall, so two words are in one piece if their sums agree.
        self.piece = piece + w.row

    def starts(self, size: int) -> np.ndarray:
        """Numbers of the words at which ``size`` words of one piece start."""
        p = self.piece
        n = max(len(p) - size + 1, 0)
        return np.flatnonzero(p[:n] == p[size - 1:size - 1 + n])

    def hashes(self, size: int, at: np.ndarray) -> np.ndarray:
        return mix(rolling(self.words.hash, size)[at] + self.salt[at] * _PROBES[1] + _U(size))

    def by_pairs(self, sizes: range, pairs: Bitmap) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, starts, hashes) of the n-grams all of whose pairs may be known."""
        known = np.zeros(len(self.piece) + 1, bool)
        at = self.starts(2)
        known[at[pairs.holds(self.hashes(2, at))]] = True
        before = np.concatenate([[0], np.cumsum(known)])
        for size in sizes:
            at = self.starts(size)
            at = at[before[at + size - 1] - before[at] == size - 1]
            yield size, at, self.hashes(size, at)


# --- summaries ------------------------------------------------------------------


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts (1 each if none)."""
    order = np.argsort(keys, kind="stable") if counts is not None else None
    keys = keys[order] if counts is not None else np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters.

    A key's true count lies between its counter (0 without one) and that plus
    ``lost``. ``lost`` * (capacity + 1) is at most the mass of all counts
    merged, because every cut takes as much off more than ``capacity`` keys.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, lost: int = 0) -> Summary:
        self.keys, self.counts = summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        self.lost += lost
        if len(self.keys) > self.capacity:
            cut = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            left = self.counts > cut
            self.keys, self.counts, self.lost = self.keys[left], self.counts[left] - cut, self.lost + cut
        return self

    def frequent(self, least: int) -> np.ndarray:
        """Keys that may count ``least`` or more: all such, if ``lost`` < ``least``."""
        return self.keys[self.counts + self.lost >= least]


def _counters(sizes: range, pairs, parts: int, gather: int):
    """Task: texts -> one row per hash partition and flush, (part, mass, keys, counts)."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = summed(np.concatenate(held))
        # Keys are in order, so a partition (the hash range) is a run of them.
        part = ((keys >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
        ends = pa.array(np.append(first, len(keys)), pa.int32())
        mass = np.add.reduceat(counts, first) if len(first) else counts
        return pa.RecordBatch.from_arrays(
            [pa.array(part[first]), pa.array(mass, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(keys.view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32)))],
            ["part", "mass", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in text_slices(batches):
            grams = Grams(b)
            found = [h for _, _, h in grams.by_pairs(sizes, pairs.value)] if pairs else [grams.hashes(k, grams.starts(k)) for k in sizes]
            held += found
            n += sum(map(len, found))
            if n >= gather:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    return run


def _merge(min_count: int, capacity: int):
    """Task of one hash partition: its counters -> the keys that may be frequent."""

    def run(rows: pa.Table) -> pa.Table:
        mass = sum(rows["mass"].to_pylist())
        summary = Summary(max(capacity, mass // min_count + 1))
        for keys, counts in zip(rows["keys"], rows["counts"]):
            summary.merge(keys.values.to_numpy().view(np.uint64), counts.values.to_numpy().astype(np.int64))
        if summary.lost >= min_count:
            raise RuntimeError("a summary lost as much as a frequent n-gram")
        return pa.table({"h": pa.array(summary.frequent(min_count).view(np.int64))})

    return run


def _parts(mass: int, min_count: int, capacity: int) -> int:
    """Hash partitions: on average half the mass that the capacity is enough for."""
    return max(1, -(-2 * mass // (capacity * min_count)))


def _survivors(texts: DataFrame, sizes: range, pairs, mass: int, min_count: int, capacity: int, gather: int, tag: str) -> DataFrame:
    """(h) of the n-grams of these sizes that may be frequent. ``mass``: at least their number."""
    parts = _parts(mass, min_count, capacity)
    rows = texts.mapInArrow(_counters(sizes, pairs, parts, gather), "part long, mass long, keys array<long>, counts array<int>")
    return materialize(rows.groupBy("part").applyInArrow(_merge(min_count, capacity), "h long"), tag)


# --- the survivors' bitmap ----------------------------------------------------------


class Bitmap:
    """Bloom filter of hashes: never denies one that was added."""

    def __init__(self, log2: int, words: np.ndarray):
        self.shift, self.words = _U(64 - log2), words

    @staticmethod
    def places(h: np.ndarray, shift: np.uint64) -> list[np.ndarray]:
        return [mix(h ^ p) >> shift for p in _PROBES]

    def holds(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in self.places(h, self.shift):
            out &= (self.words[at >> _U(6)] >> (at & _U(63)) & _U(1)).astype(bool)
        return out


def bitmap(keys: DataFrame, most: int = MAX_BITS) -> Bitmap:
    """The filter of column ``h``; its size follows the number of keys up to ``most`` bits."""
    log2 = min(most.bit_length() - 1, max(16, (BITS_EACH * keys.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(np.concatenate(Bitmap.places(b.column("h").to_numpy().view(np.uint64), _U(64 - log2))))
            word = at >> _U(6)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(at) else np.zeros(0, np.int64)
            bits = np.bitwise_or.reduceat(_U(1) << (at & _U(63)), first) if len(first) else at
            yield pa.RecordBatch.from_arrays([pa.array(word[first].view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    # To the driver: at most 2**log2 / 64 rows, whatever the number of keys.
    rows = keys.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (log2 - 6), np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Bitmap(log2, words)


# --- exact counts ---------------------------------------------------------------------


def _phrases(grams: Grams, at: np.ndarray, size: int) -> pa.Array:
    """The ``size`` words from each of the words ``at``, one blank between them."""
    text = grams.words.folded().tobytes()
    first, last = grams.words.first[at].tolist(), grams.words.last[at + size - 1].tolist()
    return pa.array([b" ".join(text[i:j].split()) for i, j in zip(first, last)], pa.binary()).cast(pa.string())


def _known(grams: Grams, sizes: range, known: Bitmap) -> pa.Table:
    """(h, lang, words, phrase, n) of a slice's n-grams in the bitmap."""
    short = ((k, at, grams.hashes(k, at)) for k in sizes if k <= 2 for at in [grams.starts(k)])
    tables = []
    for size, at, h in (*short, *grams.by_pairs(range(max(3, sizes.start), sizes.stop), known)):
        held = known.holds(h)
        at, h = at[held], h[held]
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1])) if len(h) else np.zeros(0, np.int64)
        one, n = at[order[first]], np.diff(np.append(first, len(h)))
        lang = grams.langs.take(pa.array(grams.lang[grams.words.row[one]])).cast(pa.string())
        tables.append(pa.table({"h": pa.array(h[order[first]]), "lang": lang, "words": pa.array(np.full(len(one), size), pa.int32()), "phrase": _phrases(grams, one, size), "n": pa.array(n, pa.int64())}))
    return pa.concat_tables(tables)


def _sums(rows: pa.Table, *more: str) -> pa.Table:
    """Counts of equal phrases of a language, added up."""
    found = rows.group_by([*more, "lang", "words", "phrase"]).aggregate([("n", "sum")])
    return found.rename_columns([*more, "lang", "words", "phrase", "n"])


def _exact(sizes: range, known, parts: int, gather: int):
    """Task: texts -> one row per hash partition and flush, (part, found)."""

    def flush(held: list[pa.Table]) -> pa.RecordBatch:
        rows = _sums(pa.concat_tables(held), "h").sort_by("h").combine_chunks()
        part = ((rows["h"].to_numpy() >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
        names = ["lang", "words", "phrase", "n"]
        items = pa.StructArray.from_arrays([rows[c].combine_chunks() for c in names], names)
        return pa.RecordBatch.from_arrays([pa.array(part[first]), pa.ListArray.from_arrays(pa.array(np.append(first, len(part)), pa.int32()), items)], ["part", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in text_slices(batches):
            held.append(_known(Grams(b), sizes, known.value))
            n += held[-1].num_rows
            if n >= gather:
                held = [_sums(pa.concat_tables(held), "h")]
                n = held[0].num_rows
                if 2 * n >= gather:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)

    return run


def _total(min_count: int):
    """Task of one hash partition: the exact counts of its frequent phrases."""

    def run(rows: pa.Table) -> pa.Table:
        items = rows["found"].combine_chunks().flatten()
        found = _sums(pa.table({c: items.field(c) for c in ("lang", "words", "phrase", "n")}))
        return found.filter(pc.greater_equal(found["n"], min_count)).rename_columns(["lang", "words", "phrase", "f"])

    return run


def frequent_phrases(texts: DataFrame, words: int, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, capacity: int = CAPACITY, gather: int = GATHER, max_bits: int = MAX_BITS) -> DataFrame:
    """(lang, words, phrase, f) of all n-grams of 1 to ``max_words`` words that
    occur at least ``min_count`` times; ``texts`` (lang, text) hold ``words`` words."""
    context = texts.sparkSession.sparkContext
    short = range(1, min(max_words, 2) + 1)
    known = _survivors(texts, short, None, len(short) * words, min_count, capacity, gather, "collocation-short")
    if max_words > 2:
        pairs = context.broadcast(bitmap(known, max_bits))
        long = range(3, max_words + 1)
        known = known.unionByName(_survivors(texts, long, pairs, len(long) * words, min_count, capacity, gather, "collocation-long"))
    sent = context.broadcast(bitmap(known, max_bits))
    # At most as many phrases meet in a partition as n-grams did before.
    parts = _parts(max_words * words, min_count, capacity)
    rows = texts.mapInArrow(_exact(range(1, max_words + 1), sent, parts, max(1, gather // 8)), "part long, found array<struct<lang: string, words: int, phrase: string, n: long>>")
    return rows.groupBy("part").applyInArrow(_total(min_count), "lang string, words int, phrase string, f long")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in text_slices(batches):
        yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(Words(b.column("text"), BLANKS).count, pa.int64())], ["lang", "n"])


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int | None = TOP, inside_percent: int = 100, **options) -> DataFrame:
    """The candidates that stay, each language's first ``top`` (None: all) by
    score and count descending, phrase ascending: lang, rank, phrase, words, a,
    l, r, n, score, cut. ``inside_percent``: a candidate goes if a longer one
    around it has at least this share of its count. ``options``: see
    :func:`frequent_phrases`."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    totals = materialize(texts.mapInArrow(_word_counts, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n")), "collocation-totals")
    words = totals.agg(F.sum("n")).first()[0] or 0
    counts = materialize(frequent_phrases(texts, words, max_words, min_count, **options), "collocation-counts")

    candidates = counts.where("words > 1").withColumnRenamed("f", "a")
    parts = F.split("phrase", " ")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "*", F.array_join(F.slice(parts, F.lit(1), F.col("cut")), " ").alias("head"), F.array_join(F.slice(parts, F.col("cut") + 1, F.col("words") - F.col("cut")), " ").alias("rest"))
    part = lambda phrase, f: counts.select("lang", F.col("phrase").alias(phrase), F.col("f").alias(f))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    scored = scored.withColumn("top", F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n")).withColumn("base", wide("l") * wide("r")).withColumn("score", F.expr("top div base"))
    best = scored.groupBy("lang", "words", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))

    # Every shorter phrase inside a candidate, with the count of the most frequent one around it.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("words") - k + 1), lambda i: F.array_join(F.slice(parts, i, k), " "))))
    around = candidates.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    share = F.lit(100).cast("decimal(3,0)") * wide("around") >= F.lit(inside_percent).cast("decimal(5,0)") * wide("a")
    kept = best.join(around, ["lang", "phrase"], "left").where(~F.coalesce(share, F.lit(False)))
    out = kept.select("lang", "phrase", "words", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"), "n", F.col("m.score").alias("score"), F.col("m.cut").alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = out.withColumn("rank", F.row_number().over(order))
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def oracle_sql(max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP) -> str:
    """The query's columns in DuckDB SQL, by counting every n-gram: for small tables."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS words, array_to_string(ws[i:i + {k - 1}], ' ') AS phrase FROM (SELECT lang, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM w WHERE len(ws) >= {k})"
        for k in range(1, max_words + 1))
    return rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
), totals AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang
), f AS (
  SELECT lang, words, phrase, count(*) AS f FROM ({grams}) GROUP BY lang, words, phrase HAVING count(*) >= {min_count}
), c AS (
  SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE words > 1
), cuts AS (
  SELECT lang, words, phrase, a, ws, unnest(range(1, words)) AS k FROM c
), scored AS (
  SELECT cuts.lang, cuts.words, cuts.phrase, a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1:k], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[k + 1:], ' ') JOIN totals ON totals.lang = cuts.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), spans AS (
  SELECT lang, words, a, ws, unnest(range(1, words)) AS i FROM c WHERE words > 2
), inner_ AS (
  SELECT lang, a, array_to_string(ws[i:j], ' ') AS phrase FROM (SELECT lang, words, a, ws, i, unnest(range(i + 1, words + 1)) AS j FROM spans) WHERE j - i + 1 < words
), kept AS (
  SELECT b.* FROM best b LEFT JOIN (SELECT lang, phrase, max(a) AS around FROM inner_ GROUP BY lang, phrase) o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE NOT coalesce(100 * around >= 100 * b.a, false)
)
SELECT lang, rank::INT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= {top}
"""
