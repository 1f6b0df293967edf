"""Every registered query against its DuckDB oracle on the smallest tables.

The simulation queries run with fewer draws here (the registered queries use
the reference's 500,000); the oracle text is rebuilt for the same count.
"""

import pytest

import __spark_entry__ as E
from linecast.plans import oracle, queries
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

TEST_DRAWS = 2000
NAMES = sorted(queries.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.fixture(scope="module", autouse=True)
def fewer_draws():
    saved_n, saved_q = queries.N_DRAWS, dict(oracle.Q)
    queries.N_DRAWS = TEST_DRAWS
    full, small = oracle.scenario_ctes(), oracle.scenario_ctes(n_draws=TEST_DRAWS)
    for k, sql in oracle.Q.items():
        oracle.Q[k] = sql.replace(full, small)
    yield
    queries.N_DRAWS = saved_n
    oracle.Q.clear()
    oracle.Q.update(saved_q)


def test_every_query_has_an_oracle():
    assert set(queries.QUERIES) <= set(E.queries())
    assert set(queries.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF_SMALL, con)
    assert res["match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "deviation_percentage" in df.columns
