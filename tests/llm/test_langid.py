import math
from collections import defaultdict

import pytest

from linecast.llm import langid as L
from linecast.llm.common import crc_mod, table
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, clashing, empty


def tree_of(counts, order):
    raw = defaultdict(lambda: defaultdict(int))
    for word, n in counts.items():
        seq = b" " + word + b" "
        for i in range(1, len(seq)):
            for o in range(min(i, order) + 1):
                raw[seq[i - o:i]][seq[i]] += n
    return raw


def code_length(tree, word, order):
    """One byte at a time, escaping context by context."""
    seq, bits = b" " + word + b" ", 0.0
    for i in range(1, len(seq)):
        for o in range(min(i, order), -1, -1):
            after = tree.get(seq[i - o:i])
            if after is None:
                continue
            total = sum(after.values()) + len(after)
            if seq[i] in after:
                bits += math.log2(total / after[seq[i]])
                break
            bits += math.log2(total / len(after))
        else:
            bits += 8
    return bits


COUNTS = {"a": {b"the": 5, b"then": 2, b"cat": 1}, "b": {b"der": 4, b"katze": 2, "über".encode(): 1}, "c": {b"x": 1}}


def test_code_lengths_equal_the_plain_coder():
    model = L.Model(COUNTS)
    found = [b"the", b"thy", b"der", b"zzz", "ü".encode(), b"katzen", b"x", b"\xff"]
    bits = model.code_lengths(found)
    for i, w in enumerate(found):
        for k, lang in enumerate(model.langs):
            assert bits[i, k] == pytest.approx(code_length(tree_of(COUNTS[lang], L.ORDER), w, L.ORDER), abs=1e-9)


def test_undefined_texts_and_ties():
    model = L.Model({"b": {b"same": 1}, "a": {b"same": 1}})
    got = model.predict([None, "", " \n", "12 !! 3", "same", "²½"])
    assert got[:4] == [("und", 0.0)] * 4
    assert got[4] == ("a", 0.5)  # tie: the language that sorts first
    assert got[5] == ("und", 0.0)
    assert L.Model({}).predict(["word"]) == [("und", 0.0)]


def test_held_out_accuracy(spark):
    docs = table(spark, SF_SMALL, "documents")
    model = L.fit(docs.where(crc_mod("doc_id", 4) != 2))
    rows = L.predict(docs.where(crc_mod("doc_id", 4) == 2), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 30
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    model = L.fit(docs)
    rows = L.predict(docs, model).collect()
    by = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert len(rows) == docs.count()
    assert by[6] == by[7] == by[8] == by[10] == "und" and by[4] == by[9] == "de" and by[1] == by[5] == "en"
    kept = L.keep_identified(docs, model)
    assert kept.columns == docs.columns and {6, 7, 8, 10}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_sample_is_bounded_and_whole_table_scored(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert L.fit(docs, max_docs_per_lang=3).langs == L.fit(docs).langs
    assert L.predict(docs, L.fit(docs, max_docs_per_lang=3)).count() == docs.count()


def test_empty_table(spark):
    model = L.fit(empty(spark))
    assert model.langs == [] and L.predict(empty(spark), model).collect() == []
