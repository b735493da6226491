"""Registered queries against their DuckDB oracle on the smallest scale directory."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare_oracle import duck, rows_of  # noqa: E402

from pnlflow.plans import queries as Q  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def stages(spark):
    """One set of stages for all queries: what they store is stored once."""
    return Q.Stages(Q.derived_inputs(spark, SF), Q.synthetic_params())


@pytest.mark.parametrize("name", list(Q.REGISTRY))
def test_query_matches_oracle(stages, con, name):
    query = Q.REGISTRY[name]
    s = Q.as_output(query.spark(stages), query.cols, query.nums).toPandas()
    d = con.execute(Q.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert rows_of(s) == rows_of(d)


def test_every_query_has_an_oracle():
    assert set(Q.oracle_sql()) == set(Q.REGISTRY)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == list(Q.rules.OUTPUT_COLUMNS)
    assert df.count() > 0
