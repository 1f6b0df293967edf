import numpy as np
import pytest

from linecast.llm import quality_classifier as Q
from linecast.llm.common import crc_mod, table
from tests.llm.helpers import awkward, clashing, empty

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_on_the_whole_table(spark):
    import __spark_entry__ as E

    rows = E.queries()["op2_quality_classifier"](spark, SF)
    marked = rows.join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    good = [r["score"] for r in marked if r["quality"] == 1]
    bad = [r["score"] for r in marked if r["quality"] == 0]
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert rows.count() == table(spark, SF, "documents").count()
    assert auc > 0.95 and np.mean([r["predicted"] == r["quality"] for r in marked]) > 0.9


def test_score_equals_the_forward_pass():
    rng = np.random.default_rng(3)
    model = Q.Model(rng.normal(size=Q.BUCKETS), 0.25)
    texts = ["one two two two three", "x", "", None, " \n", "é è é è " * 50]
    for text, got in zip(texts, model.score(texts)):
        ids, share = Q.vector(text)
        assert got == pytest.approx(1 / (1 + np.exp(-(0.25 + (model.logit[ids] * share).sum()))), rel=1e-5)


def test_long_words_count_to_their_end():
    start, good, bad = "天" * 80, "好的文字" * 30, "坏的东西" * 30
    rows = [(label, *Q.vector(start + mark * n)) for n in (1, 2, 3) for label, mark in ((1, good), (0, bad))]
    a, b = Q.train(rows).score([start + good[:60] + "一", start + bad[:60] + "二"])
    assert a > 0.8 and b < 0.2
    model = Q.Model(np.random.default_rng(5).normal(size=Q.BUCKETS), 0.0)
    texts = ["x" * 70 + str(i) for i in range(30_000)] + ["好的" * 600_000]
    ids, share = Q.vector(texts[-1])
    got = model.score(texts)
    assert got[-1] == pytest.approx(1 / (1 + np.exp(-(model.logit[ids] * share).sum())), rel=1e-4)
    assert got[:5].tolist() == pytest.approx(model.score(texts[:5]).tolist()) and got[20_000] == pytest.approx(Q.Model(model.logit, 0.0).score([texts[20_000]])[0])


def test_held_out_labels_are_not_read(spark):
    docs, labels = table(spark, SF, "documents").limit(150), table(spark, SF, "labels")
    flipped = labels.withColumn("quality", (crc_mod("doc_id", 5) == 0).cast("int") + labels["quality"])
    a = Q.fit(docs, labels.where(crc_mod("doc_id", 5) != 0))
    b = Q.fit(docs, flipped.where(crc_mod("doc_id", 5) != 0))
    assert np.array_equal(a.logit, b.logit) and a.bias == b.bias


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 1), (5, None), (None, 1), (99, 0), (8, 0), (6, 0)], "doc_id long, quality int")
    rows = Q.score(docs, Q.fit(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (6, 7, 8)}) == 1
    none = Q.fit(empty(spark), labels)
    assert none.score(["a", None]).tolist() == [0.5, 0.5] and Q.score(empty(spark), none).collect() == []
