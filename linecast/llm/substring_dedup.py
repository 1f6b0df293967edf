"""Exact substring deduplication with difference-cover anchors.

A window is ``window`` consecutive words (runs of characters other than ASCII
white space, unchanged) of one text. A word is removed if a window that covers
it has the same words as a window that starts anywhere else, in the same text
or another one. Windows are judged on the input, not on what is left.

Texts with the same words are one class: in a class of two or more every window
is repeated, so its texts go whole, and one of them stands for all below.

1. *Anchors.* Positions of a text count modulo a period P; a difference cover D
   holds, for any two positions i and j, a shift t < P with i + t and j + t
   both in D modulo P. Hashes of ``window`` - P + 1 words are taken at cover
   positions only, so two equal windows share an anchor at the same shift.
   (P = 21 with 5 of 21 positions for windows of 35 words.)
2. *Shared anchors* are those that occur twice or more: counts by hash with
   partial aggregation, and a semi-join that tells each text its own.
3. *Extension.* A shared anchor is extended to the up to P windows that hold it
   inside its text; their 96-bit digests are counted over all texts.
   Occurrences are never paired: a passage in a million texts costs a million
   rows, and the extension is as exact as a comparison word by word.
4. *Removal.* Texts meet the windows found repeated and lose the covered words.

An anchor or a window that repeats inside a text is one row with a count, so a
line repeated a thousand times in a text is one row, and a window known to be
repeated by its own count is not looked up. Rows are keyed by a number
given to each row of the input in a written table, so reruns of lost tasks see
the same numbers.

Defined results: null or empty text has no words and keeps an empty text; every
input row gives one row, rows that repeat an id are texts of their own; a text
of fewer than ``window`` words is kept; a null id is kept as it is; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecast.llm.common import materialize, release
from linecast.llm.wordhash import Words, mix, rolling, text_slices

WINDOW = 35
#: Perfect difference covers: every difference modulo the period occurs. Fixed values.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

_U = np.uint64


def period_of(window: int) -> int:
    """The period used: the largest with anchors of about two fifths of a window."""
    return max(p for p in COVERS if p == 1 or 5 * p <= 3 * window)


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hash) of the anchors of texts that hold a window."""
    p = period_of(window)
    cover = np.zeros(p, bool)
    cover[list(COVERS[p])] = True
    at = words.runs(window - p + 1)
    row = words.row[at]
    at = at[cover[(at - words.begin[row]) % p] & (words.count[row] >= window)]
    return at, mix(rolling(words.hash, window - p + 1)[at] + _U(window))


def _digests(h: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of 64 and 32 bits of the windows that start at words ``at``."""
    return mix(rolling(h, window)[at]), mix(rolling(mix(h ^ _U(0x5851F42D4C957F2D)), window)[at]) >> _U(32)


def _distinct(row: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of equal (row, *keys), and how many are equal."""
    order = np.lexsort((*keys, row))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in (row, *keys)])
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _told(column: pa.Array) -> np.ndarray:
    """Place and hash of the lists of a batch, as keys to look up."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return _key(np.repeat(np.arange(len(column)), size), values)


def _key(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix(h + mix(row.astype(np.uint64) + _U(1)))


def _text_digests(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each text's words in their order."""
    place = mix(np.arange(len(words.hash), dtype=np.uint64) - words.begin[words.row].astype(np.uint64) + _U(1))
    out = []
    for salt in (_U(0x2545F4914F6CDD1D), _U(0x9E6C63D0876A9A47)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(mix(words.hash + salt) ^ place), dtype=np.uint64)])
        out.append(total[words.begin + words.count] - total[words.begin])
    return out[0], out[1]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in text_slices(batches):
        words = Words(b.column("text"))
        d1, d2 = _text_digests(words)
        extra = [pa.array(words.count.astype(np.int64)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))]
        yield pa.RecordBatch.from_arrays([*b.columns, *extra], [*b.schema.names, "words", "d1", "d2"])


def _find_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            words = Words(b.column("text"))
            at, h = _anchors(words, window)
            one, n = _distinct(words.row[at], h)
            yield pa.RecordBatch.from_arrays([b.column("row").take(pa.array(words.row[at[one]])), pa.array(h[one].view(np.int64)), pa.array(n.astype(np.int64))], ["row", "h", "n"])

    return run


def _extend(window: int):
    """Texts with their shared anchors -> digests of the windows around them."""
    p = period_of(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            words = Words(b.column("text"))
            at, h = _anchors(words, window)
            at = at[np.isin(_key(words.row[at], h), _told(b.column("hits")))]
            # The windows that hold the anchor start at most p - 1 words before it.
            mark = np.zeros(len(words.first) + 1, np.int64)
            np.add.at(mark, np.maximum(at - p + 1, words.begin[words.row[at]]), 1)
            np.add.at(mark, at + 1, -1)
            starts = words.runs(window)
            starts = starts[np.cumsum(mark)[starts] > 0]
            x, y = _digests(words.hash, starts, window)
            one, n = _distinct(words.row[starts], x, y)
            copies = b.column("copies").to_numpy()[words.row[starts[one]]]
            yield pa.RecordBatch.from_arrays([b.column("row").take(pa.array(words.row[starts[one]])), pa.array(x[one].view(np.int64)), pa.array(y[one].astype(np.uint32).view(np.int32)), pa.array((n * copies).astype(np.int64)), pa.array(copies > 1)], ["row", "x", "y", "n", "copied"])

    return run


def _joined(words: Words, keep: np.ndarray) -> pa.Array:
    """Texts of the words ``keep`` marks, with one blank between them."""
    kept = np.flatnonzero(keep)
    row = words.row[kept]
    follows = np.zeros(len(kept), bool)
    follows[:-1] = row[1:] == row[:-1]
    size = words.last[kept] - words.first[kept] + follows
    ends = np.cumsum(size)
    source = np.append(words.data, np.uint8(32))
    take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(words.first[kept] - (ends - size), size)
    take[ends[follows] - 1] = len(words.data)
    text = np.zeros(len(words.count) + 1, np.int64)
    np.add.at(text, row + 1, size)
    return pa.LargeStringArray.from_buffers(len(words.count), pa.py_buffer(np.cumsum(text)), pa.py_buffer(source[take])).cast(pa.string())


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            words = Words(b.column("text"))
            starts = words.runs(window)
            found = starts[np.isin(_key(words.row[starts], _digests(words.hash, starts, window)[0]), _told(b.column("hits")))]
            mark = np.zeros(len(words.first) + 1, np.int64)
            np.add.at(mark, found, 1)
            np.add.at(mark, found + window, -1)
            whole = pc.fill_null(b.column("whole"), False).to_numpy(zero_copy_only=False)
            gone = (np.cumsum(mark)[:-1] > 0) | whole[words.row]
            # Runs of removed words, cut at the texts' ends.
            edge = np.zeros(len(gone) + 1, bool)
            edge[words.begin[words.count > 0]] = edge[-1] = True
            opens = np.flatnonzero(gone & (edge[:-1] | ~np.append(False, gone[:-1])[:len(gone)]))
            closes = np.flatnonzero(gone & (edge[1:] | ~np.append(gone[1:], False)[:len(gone)])) + 1
            begin = words.begin[words.row[opens]]
            spans = pa.StructArray.from_arrays([pa.array(opens - begin, pa.int64()), pa.array(closes - begin, pa.int64())], ["start", "end"])
            offsets = np.concatenate([[0], np.cumsum(np.bincount(words.row[opens], minlength=b.num_rows))])
            removed = np.bincount(words.row[gone], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(words.count.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), _joined(words, ~gone)],
                ["id", "n_words", "n_removed", "removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``removed`` (runs
    of word numbers, end exclusive) and ``kept`` (the text of the words that
    stay, one blank between them)."""
    if window < 1:
        raise ValueError("a window holds one word at least")
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    rows = materialize(named.mapInArrow(_describe, f"row long, id {kind}, text string, words long, d1 long, d2 long"), "substring-rows")
    texts = rows.select("row", "text")
    long = rows.where(F.col("words") >= window).select("row", "words", "d1", "d2")
    classes = long.groupBy("words", "d1", "d2").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes, "substring-classes")

    # Each step is written and its shuffle files and inputs go before the next:
    # at any time about two tables of the size of the texts are on disk.
    anchors = texts.mapInArrow(_find_anchors(window), "row long, h long, n long")
    shared = anchors.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    hits = anchors.select("row", "h").join(shared, "h", "left_semi").groupBy("row").agg(F.collect_list("h").alias("hits"))
    hits = hits.join(classes.select(F.col("first").alias("row"), "copies"), "row")
    hits = materialize(hits, "substring-hits", clean=True)   # a text's list is as long as the text at most

    windows = texts.join(hits, "row").mapInArrow(_extend(window), "row long, x long, y int, n long, copied boolean")
    windows = materialize(windows, "substring-windows", clean=True)
    release(hits)
    repeated = windows.groupBy("x", "y").agg(F.sum("n").alias("n")).where("n > 1").select("x", "y")
    looked_up = windows.where("n = 1").select("row", "x", "y").join(repeated, ["x", "y"], "left_semi")
    # A window that a text holds twice is repeated as it is; copied texts go whole.
    found = looked_up.select("row", "x").unionByName(windows.where("n > 1 and not copied").select("row", "x")).groupBy("row").agg(F.collect_list("x").alias("hits"))
    found = found.withColumn("whole", F.lit(False))
    whole = long.join(classes.where("copies > 1"), ["words", "d1", "d2"]).select("row", F.array().cast("array<long>").alias("hits"), F.lit(True).alias("whole"))
    found = materialize(found.unionByName(whole), "substring-found", clean=True)
    release(windows)

    out = rows.select("row", "id", "text").join(found, "row", "left").mapInArrow(_remove(window), f"id {kind}, n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept string")
    return out.withColumnRenamed("id", id_col)


def oracle_sql(window: int = WINDOW) -> str:
    """The query's columns in DuckDB SQL, by the words of all windows: for small
    tables with unique ids."""
    return rf"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), g AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + {window - 1}], ' ')) AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {window - 2})) AS i FROM w WHERE len(words) >= {window})
), found AS (
  SELECT doc_id, i FROM g WHERE gram IN (SELECT gram FROM g GROUP BY gram HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS p FROM found
), each AS (
  SELECT doc_id, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS word FROM w
), kept AS (
  SELECT e.doc_id, count(*) AS n, string_agg(e.word, ' ' ORDER BY e.p) AS t
  FROM each e ANTI JOIN gone USING (doc_id, p) GROUP BY e.doc_id
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, (len(w.words) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
