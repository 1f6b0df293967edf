"""The pipeline's stages against plain Python over the same rows."""

import pytest

import corpus_pipeline as C
from linecast.llm import langid, mixing, pii
from linecast.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, clashing, empty
from tests.llm.test_ngram_join import brute


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage on the smallest table."""
    docs, out = table(spark, SF_SMALL, "documents"), {}
    for name, f in C.STAGES:
        after = C.materialize(f(spark, docs, SF_SMALL), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_stages_keep_the_columns(spark, stages):
    columns = table(spark, SF_SMALL, "documents").dtypes
    for name, (_, after) in [*stages.items()][:-1]:
        assert after.dtypes == columns, name


def test_language_id(stages):
    before, after = stages["language_id"]
    model = langid.fit(before)
    rows = {r["doc_id"]: r for r in before.collect()}
    want = {i: p[0] for i, p in zip(rows, model.predict([r["text"] for r in rows.values()])) if p[0] != "und"}
    assert {r["doc_id"]: r["lang"] for r in after.collect()} == want
    assert len(want) >= 0.99 * len(rows)


def test_near_duplicates(stages):
    before, after = stages["ngram_jaccard_join"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    stay = {int(i) for i, _, c in brute(rows, C.SHINGLE, C.PERCENT) if int(i) == c}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(stay) and len(stay) < len(rows)


def test_personal_data(stages):
    before, after = stages["pii"]
    new = {r["doc_id"]: r for r in after.collect()}
    for r in before.collect():
        assert new[r["doc_id"]]["text"] == pii.redacted(r["text"])
        assert not [s for s in pii.scan(new[r["doc_id"]]["text"]) if s[0] in ("email", "phone", "card")]
        assert new[r["doc_id"]]["n_chars"] == (r["n_chars"] if not pii.scan(r["text"]) else len(pii.redacted(r["text"])))


def test_mixing(stages):
    before, after = stages["mixing"]
    reps = {r["doc_id"]: r["reps"] for r in mixing.repetitions(before).collect()}
    counts = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in reps.items() if n}


def test_packing(stages):
    before, after = stages["packing"]
    rows = after.collect()
    assert sum(r["piece"] == 0 for r in rows) == before.count()
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(x[1] for x in v) <= 2048 and all(a + n == b for (a, n), (b, _) in zip(sorted(v), sorted(v)[1:])) for v in used.values())
    assert len(used) <= 1.02 * -(-sum(r["length"] for r in rows) // 2048) + 1


def test_awkward_and_empty_tables(spark):
    for docs in (clashing(awkward(spark)), empty(spark)):
        columns = docs.columns
        for name, f in C.STAGES:
            docs = C.materialize(f(spark, docs, SF_SMALL), f"awkward-{name}")
            assert name == "packing" or docs.columns == columns
        docs.count()
