import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linecast.llm import quality_rules as Q
from linecast.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, awkward_rows, clashing, empty


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures_equal_brute_force(spark):
    texts = [None, "", " \n\x0b", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x y z q x y z\nx y z q x y z", "é# *b c\x1cd $%&|<>", "l\n l\nl\n\nl\r\nl"]

    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.text(st.sampled_from("ab#\n \t\x0b"), max_size=40), min_size=60, max_size=60))
    def run(more):
        all_texts = texts + more
        df = spark.createDataFrame(list(enumerate(all_texts)), "doc_id long, text string")
        for r in Q.measure(df).collect():
            assert tuple(r[c] for c in COLUMNS) == brute(all_texts[r["doc_id"]]), all_texts[r["doc_id"]]

    run()


def test_query_equals_sql(spark):
    import __spark_entry__ as E
    from tests.oracle_compare import compare

    assert compare(spark, "op7_quality_rules", SF_SMALL)["match"]


def test_awkward_rows_in_spark_and_sql(spark):
    docs = clashing(awkward(spark))
    rows = Q.ledger(docs).collect()
    short = [r for r in awkward_rows() if r[1] is None or len(r[1]) < 50_000]
    assert sorted((str(r["doc_id"]), *(r[c] for c in COLUMNS)) for r in rows if r["n_words"] < 10_000) == sorted((str(r[0]), *brute(r[1])) for r in short)
    assert len(rows) == len(awkward_rows())
    con = duckdb.connect()
    documents = awkward(spark).select("doc_id", "text").toPandas()  # noqa: F841
    sql = con.execute(Q.ORACLE_SQL).fetchall()
    want = Q.apply_policy(Q.ledger(docs)).collect()
    key = lambda r: tuple(str(x) for x in r)
    as_id = lambda i: None if i is None or i != i else int(i)
    assert sorted((str(as_id(r[0])), *r[1:6], r[7]) for r in sql) == sorted((str(r["doc_id"]), *(r[c] for c in COLUMNS), r["kept"]) for r in want), key
    assert Q.ledger(empty(spark)).collect() == []


def test_policies_and_ablation(spark):
    entries = Q.ledger(table(spark, SF_SMALL, "documents"))
    rows = Q.apply_policy(entries).collect()
    failed = [r["failed"] for r in rows]
    for r in Q.ablation(entries).collect():
        bit = Q.mask(r["rule"])
        assert r["fails"] == sum(f & bit > 0 for f in failed)
        assert r["fails_alone"] == sum(f == bit for f in failed)
        assert r["kept_by_policy"] == sum(r["kept"] for r in rows)


def test_plan_is_native(spark):
    plan = Q.ledger(table(spark, SF_SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", list(Q.POLICIES))
def test_policy_masks_name_known_rules(name):
    assert Q.POLICIES[name] >> len(Q.RULES) == 0
