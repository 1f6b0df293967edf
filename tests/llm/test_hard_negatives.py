"""Hard negatives against a search in plain Python; Strassen against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linecast.llm import hard_negatives as H
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 7), (64, 64, 64), (65, 33, 130), (7, 100, 2), (100, 65, 41)])
@pytest.mark.parametrize("leaf", [1, 8, 32])
def test_strassen_is_exact(shape, leaf):
    m, d, n = shape
    r = np.random.default_rng(m * d + n)
    a, b = r.integers(-10**6, 10**6, (m, d)), r.integers(-10**6, 10**6, (d, n))
    assert np.array_equal(H.strassen(a, b, leaf), a @ b)


def test_strassen_is_exact_near_63_bits():
    """Steps may wrap around; the product does not."""
    a, b = np.full((40, 64), -(2**28)), np.full((64, 40), 2**28 - 1)
    assert (H.strassen(a, b, 4) == -(2**28) * (2**28 - 1) * 64).all()


def test_heaps_merge_in_any_order():
    r = random.Random(5)
    rows = [(r.randrange(4), r.randrange(-3, 4), r.randrange(50)) for _ in range(300)]
    want = sorted((k, -s, i) for k, s, i in rows)
    want = [x for j, x in enumerate(want) if sum(y[0] == x[0] for y in want[:j]) < 5]
    for _ in range(3):
        r.shuffle(rows)
        heaps = H.Heaps(5)
        for at in range(0, len(rows), 37):
            heaps.merge(*(np.array(x, np.int64) for x in zip(*rows[at:at + 37])))
        assert list(zip(heaps.key.tolist(), (-heaps.score).tolist(), heaps.id.tolist())) == want


def brute(rows, every=50, low=50, high=95):
    good = []
    for n, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            q = [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]
            if sum(x * x for x in q) < 1 << 62:
                good.append((n, i, q, label))
    out = []
    for n, i, q, label in good:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), j, m, other) for m, j, p, other in good if len(p) == len(q) and m != n)
        for s, j, _, other in [x for x in scored if x[3] == label][:5]:
            hard = [(t, k) for t, k, _, o in scored if o != label and low * -s <= 100 * -t <= high * -s][:3]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(hard, 1)]
    return sorted(out)


def check(spark, rows, every=50, **options):
    docs = rows if not isinstance(rows, list) else spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = H.hard_negatives(docs, anchors=F.col("vec_id") % every == 0, **options).collect()
    have = sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in got)
    assert have == brute(rows, every)
    return have


def vectors(seed, n, dim=9, labels=4):
    r = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in r.normal(0.3, 1, dim)], int(r.integers(labels))) for i in range(n)]


def test_random_vectors_over_several_tiles(spark, monkeypatch):
    assert len(check(spark, vectors(1, 400), 20, anchor_tile=6, row_tile=90)) > 50
    assert check(spark, vectors(2, 120, dim=70), 10)


def test_ties_copies_and_a_hot_label(spark):
    rows = vectors(3, 60)
    rows += [(100 + i, rows[0][1], rows[0][2]) for i in range(40)] + [(300 + i, rows[1][1], rows[0][2] + 1) for i in range(40)]
    check(spark, rows, 10, anchor_tile=5, row_tile=30)
    assert check(spark, [(i, [1.0, 1.0], i % 2) for i in range(30)] + [(100 + i, [0.8, 0.8], 2) for i in range(30)], 10)


def test_awkward_rows(spark):
    rows = vectors(4, 40)
    rows += [(50, None, 1), (None, rows[0][1], 1), (60, rows[0][1], None), (70, [1.0, None], 1), (80, [float("nan")] * 9, 1), (90, [float("inf")] * 9, 2),
             (100, [1.0, 2.0], 1), (101, [1.0, 3.0], 1), (102, [0.7, 1.9], 2), (110, [], 1), (111, [], 2), (120, [0.0] * 9, 1),
             (130, [1e30] * 9, 1), (131, [3e6] * 9, 1), (10, rows[10][1], rows[10][2]), (10, rows[10][1], rows[10][2])]
    check(spark, rows, 10)
    clash = spark.createDataFrame(vectors(5, 60), SCHEMA)
    for c in ("row", "id", "vec", "a", "r", "dim", "place", "anchor", "anchor_id", "score", "positives"):
        clash = clash.withColumn(c, F.lit("x"))
    got = H.hard_negatives(clash, anchors=F.col("vec_id") % 10 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(vectors(5, 60), 10)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert H.hard_negatives(none, anchors=F.col("vec_id") % 50 == 0).collect() == []
    assert H.hard_negatives(spark.createDataFrame(vectors(6, 5), SCHEMA), anchors=F.lit(False)).collect() == []


def test_query_matches_sql(spark):
    assert compare(spark, "op13_hard_negatives", SF_SMALL)["match"]
