"""The queries that SQL expresses, against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from oracle_compare import compare

from keystat.llm import queries

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name])
    assert res[name][0] == "OK", res[name]


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
