import pytest
from pyspark.sql import functions as F

from linecast.llm import mixing as M
from linecast.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, clashing, empty


def targets(sizes, weights=(5, 2, 1), epochs=3):
    """Clamp and reshare until none is above; sizes in source order."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    capped = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = sum(sizes) - sum(capped.values())
        share = {i: left * w[i] / sum(w[j] for j in free) for i in free} if free else {}
        over = [i for i in free if share[i] > epochs * sizes[i]]
        if not over:
            return [capped.get(i, share.get(i)) for i in range(len(sizes))]
        capped |= {i: epochs * sizes[i] for i in over}


@pytest.mark.parametrize("sizes", [[10], [100, 100, 100], [1, 1000, 1000], [5, 0, 2000, 3, 1, 1, 900], [0, 0], [1, 1, 1, 10**12], [7] * 50 + [10**6]])
def test_water_fill_equals_the_loop(spark, sizes):
    names = [f"s{i:03d}" for i in range(len(sizes) - 1)] + [None]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r["source"]: r["target"] for r in M.water_fill(df).collect()}
    for name, expected in zip(names, targets(sizes)):
        assert got[name] == pytest.approx(expected, rel=1e-9)


def test_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = M.mix(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["taken"] % r["size"] == 0 if r["size"] else r["taken"] == 0)
        by.setdefault(r["source"], []).append(r)
    for rs in by.values():
        assert rs[0]["source_size"] == sum(r["size"] for r in rs)
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) <= max(r["size"] for r in rs)
    again = {(r["doc_id"], r["taken"]) for r in M.mix(docs.repartition(7, F.rand(3))).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}


def test_sizes_count_words(spark):
    df = spark.createDataFrame([(1, "a\tb\x0bc\x0cd\r\ne f  "), (2, None), (3, ""), (4, "a b\x1cc")], "doc_id long, text string").withColumn("source", F.lit("s"))
    assert {r["doc_id"]: r["size"] for r in M.mix(df).collect()} == {1: 6, 2: 0, 3: 0, 4: 1}


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    rows = M.mix(docs).collect()
    assert len(rows) == docs.count()
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s or ""))
    assert sources == ["", "a", "b", "c", None]
    assert all(r["target"] == 0 for r in rows if r["source"] == "")
    mixed = M.resample(docs)
    assert mixed.columns == docs.columns
    expected = sorted(str(r["doc_id"]) for r in rows if r["size"] for _ in range(r["reps"]))
    assert sorted(str(r["doc_id"]) for r in mixed.collect()) == expected
    assert M.mix(empty(spark)).collect() == [] and M.resample(empty(spark)).collect() == []


def test_plan_is_native(spark):
    plan = M.mix(table(spark, SF_SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
