"""Substring deduplication against windows compared as strings."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from linecast.llm import substring_dedup as S
from tests.conftest import SF_SMALL
from tests.llm.helpers import SCHEMA, awkward, awkward_rows, clashing, empty, prose
from tests.oracle_compare import compare


def brute(texts, window):
    """(words, removed word numbers) of every text."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    return [(w, {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}) for w in words]


def check(spark, docs, rows, window):
    """``rows``: (id, text) of ``docs``."""
    got = S.remove_repeats(docs, window=window).collect()
    want = []
    for (i, _), (words, gone) in zip(rows, brute([t for _, t in rows], window)):
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone).decode()
        want.append((str(i), len(words), len(gone), tuple(sorted(gone)), kept))
    have = [(str(r[0]), r["n_words"], r["n_removed"], tuple(j for s in r["removed"] for j in range(s["start"], s["end"])), r["kept"]) for r in got]
    assert sorted(have) == sorted(want)
    return got


@pytest.mark.parametrize("period", [p for p in S.COVERS])
def test_every_difference_is_covered(period):
    d = S.COVERS[period]
    assert {(x - y) % period for x in d for y in d} == set(range(period))


@pytest.mark.parametrize("window", [1, 2, 4, 5, 12, 22, 35, 60])
def test_equal_windows_share_an_anchor(window):
    p = S.period_of(window)
    size, cover = window - p + 1, set(S.COVERS[p])
    assert size >= 1
    for i in range(p):
        for j in range(p):
            assert any((i + t) % p in cover and (j + t) % p in cover for t in range(window - size + 1))


@pytest.mark.parametrize("window", [1, 2, 5, 12, 35])
def test_random_texts(spark, window):
    r = random.Random(window)
    passages = [prose(100 + i, r.randrange(1, 3 * window + 2)) for i in range(8)]
    rows = []
    for i in range(60):
        parts = [prose(1000 + i, r.randrange(0, 60))] + [r.choice(passages) for _ in range(r.randrange(3))] + [prose(2000 + i, r.randrange(0, 20))]
        r.shuffle(parts)
        rows.append((i, " ".join(parts)))
    rows += [(90, "same " * 200), (91, "a b " * 50), (92, passages[0]), (92, passages[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(spark, docs, rows, window)


def test_window_of_exactly_35(spark):
    shared = prose(7, 35)
    first, last = shared.split(" ", 1)
    rows = [(1, prose(8, 50) + " " + shared + " " + prose(9, 50)), (2, prose(10, 3) + " " + shared), (3, prose(11, 80) + " X" + last), (4, shared.rsplit(" ", 1)[0])]
    got = {r["doc_id"]: r for r in check(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows, 35)}
    assert [got[i]["n_removed"] for i in (1, 2, 3, 4)] == [35, 35, 0, 0]


def test_a_hot_passage_and_a_group_of_copies(spark):
    passage, copy = prose(20, 60), prose(21, 90)
    rows = [(i, prose(3000 + i, 40) + " " + passage) for i in range(150)] + [(1000 + i, copy) for i in range(150)] + [(5000 + i, prose(9000 + i, 70)) for i in range(100)]
    got = check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(8), rows, 35)
    assert sum(r["n_removed"] for r in got) >= 150 * 150


def test_awkward_rows_and_clashing_names(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    check(spark, clashing(awkward(spark)), rows, 35)
    text_id = awkward(spark).withColumn("doc_id", F.col("doc_id").cast("string"))
    assert S.remove_repeats(text_id).count() == len(rows)


def test_empty_table_and_texts(spark):
    assert S.remove_repeats(empty(spark)).collect() == []
    none = spark.createDataFrame([(1, None, None, None, None, None), (2, " \n", "", "", 1, 1)], SCHEMA)
    assert sorted((r[0], r["n_words"], r["n_removed"], r["removed"], r["kept"]) for r in S.remove_repeats(none).collect()) == [(1, 0, 0, [], ""), (2, 0, 0, [], "")]


def test_query_matches_sql(spark):
    assert compare(spark, "op11_substring_dedup", SF_SMALL)["match"]
    assert E.queries()["op11_substring_dedup"](spark, SF_SMALL).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
