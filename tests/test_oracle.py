"""Every SQL-checked query equals its DuckDB oracle (the driver's gate)."""

import pytest

import __spark_entry__ as E
from oracle_check import duck, frames_equal
from strataflow.plans.oracles import ORACLES

KEYS = sorted(ORACLES)


@pytest.fixture(scope="module")
def con(sf01):
    return duck(sf01)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf01, con, key):
    got = E.queries()[key](spark, sf01).toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    ok, msg = frames_equal(got, want)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 11  # sf0.001 has one empty airport stratum
    assert df.columns == ["stratum", "n", "share"]
    assert abs(sum(r["share"] for r in rows) - 1.0) < 1e-12
