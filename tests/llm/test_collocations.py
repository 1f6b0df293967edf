"""Collocations against plain counts; Misra-Gries guarantees."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linecast.llm import collocations as C
from tests.conftest import SF_SMALL
from tests.llm.helpers import DE, EN, SCHEMA, awkward, awkward_rows, clashing, empty, prose
from tests.oracle_compare import compare

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top, longest=5):
    """``rows``: (text, lang) -> report rows."""
    total, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(b >= a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def check(docs, rows, least, top=50, **options):
    got = C.collocations(docs, min_count=least, top=top, **options).collect()
    have = sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got)
    want = brute(rows, least, top)
    assert have == want
    return have


def corpus(seed, n=120):
    r = random.Random(seed)
    set_phrases = ["New York city", "red herring", "in the long run of things", "Der rote Faden"]
    rows = []
    for i in range(n):
        text = prose(seed * 1000 + i, 60, EN if i % 3 else DE)
        words = text.split(" ")
        for _ in range(r.randrange(4)):
            words.insert(r.randrange(len(words)), r.choice(set_phrases))
        rows.append((" ".join(words), ["en", "de", None][i % 3]))
    return rows


# Small capacities make summaries cut, small flushes make them merge, and small
# bitmaps let everything through: none of it may change the result.
@pytest.mark.parametrize("options", [{}, {"capacity": 4, "gather": 300}, {"capacity": 16, "gather": 50, "max_bits": 64}, {"capacity": 1}])
def test_counts_are_exact(spark, options):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    assert len(check(docs, rows, 6, **options)) >= 10


def test_report_limit_and_ties(spark):
    rows = [("a b. c d. e f. x y z", "en")] * 7
    docs = spark.createDataFrame(rows, "text string, lang string")
    # Equal scores and counts: by phrase; "x y" and "y z" are dropped inside "x y z".
    assert [r[2] for r in check(docs, rows, 7)] == ["a b", "c d", "e f", "x y z"]
    assert [r[2] for r in check(docs, rows, 7, top=2)] == ["a b", "c d"]
    assert C.collocations(docs, min_count=7, top=None).count() == 4


def test_overlaps_repeats_and_pieces(spark):
    rows = [("ha ha ha ha ha ha. HA ha\nha", "en"), ("ha, ha", "en"), ("b\tc  b c;b c", "en")]
    check(spark.createDataFrame(rows, "text string, lang string"), rows, 2)


def test_awkward_rows_and_clashing_names(spark):
    rows = [(r[1], r[2]) for r in awkward_rows()]
    check(clashing(awkward(spark)), rows, 4)


def test_empty_tables(spark):
    assert C.collocations(empty(spark)).collect() == []
    assert C.collocations(spark.createDataFrame([(1, None, None, None, None, None), (2, "", "", "", 1, 1)], SCHEMA), min_count=1).collect() == []


def test_products_past_64_bits(spark):
    texts = spark.createDataFrame([("p q", "en")] * 3, "text string, lang string")
    big = 4_000_000_000_000
    counts = spark.createDataFrame([("en", 1, "p", big), ("en", 1, "q", big), ("en", 2, "p q", big)], "lang string, words int, phrase string, f long")
    saved = C.frequent_phrases, C._word_counts
    C.frequent_phrases = lambda *a, **k: counts
    C._word_counts = lambda batches: (b.select(["lang"]).append_column("n", C.pa.array([big * 9] * b.num_rows, C.pa.int64())) for b in batches)
    try:
        row = C.collocations(texts).first()
    finally:
        C.frequent_phrases, C._word_counts = saved
    n = 27 * big
    assert row["n"] == n and row["score"] == 1000 * big * n // (big * big)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=60), max_size=8), st.integers(1, 12))
def test_summary_bounds(parts, capacity):
    """Every merge order keeps the bounds that the method rests on."""
    true, summary = Counter(), C.Summary(capacity)
    for part in parts:
        true.update(part)
        keys, counts = C.summed(np.array(part, np.uint64))
        own = C.Summary(capacity).merge(keys, counts)
        summary.merge(own.keys, own.counts, own.lost)
    mass = sum(true.values())
    assert len(summary.keys) <= capacity and summary.lost * (capacity + 1) <= mass
    held = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    for key, n in true.items():
        assert held.get(key, 0) <= n <= held.get(key, 0) + summary.lost
    least = mass // (capacity + 1) + 1
    assert {k for k, n in true.items() if n >= least} <= set(summary.frequent(least).tolist())


def test_bitmap_never_denies(spark):
    h = spark.range(5000).selectExpr("xxhash64(id) h")
    known = C.bitmap(h)
    mine = np.array([r["h"] for r in h.collect()], np.int64).view(np.uint64)
    assert known.holds(mine).all()
    assert known.holds(C.mix(np.arange(100_000, dtype=np.uint64))).mean() < 0.02
    assert len(C.bitmap(h, 256).words) == 4


def test_query_matches_sql(spark):
    assert compare(spark, "op12_collocations", SF_SMALL)["match"]
