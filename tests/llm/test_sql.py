"""Queries of the training-data operators next to their SQL twins."""

import pytest

from tests.oracle import compare
from voxledger.llm.suite import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, sf_dir):
    error, n, _ = compare(name, QUERIES[name], ORACLES[name], spark, sf_dir)
    assert error is None, error
    assert n > 0
