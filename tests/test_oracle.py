"""Every registered query against its DuckDB oracle (the driver's check, here
at sf0.001 to keep the suite quick; ``python tests/oracle_compare.py`` runs sf0.01)."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_compare import compare

import __spark_entry__ as E
from keystat.queries import QUERIES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ticker", "p_mean", "p_min", "p_max", "p_var",
                          "v_mean", "v_min", "v_max", "v_var"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(E.oracle_sql())))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name])
    assert res[name][0] == "OK", res[name]
