"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from tests.oracle import compare
from voxledger.suite import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, sf_dir):
    error, rows, _ = compare(name, QUERIES[name], ORACLES.get(name), spark, sf_dir)
    assert error is None, error
    assert rows > 0


def test_every_query_has_a_twin():
    """All but the approximate search, whose recall is tested."""
    assert set(QUERIES) - set(ORACLES) == {"emb_topk_ivf"} and set(ORACLES) <= set(QUERIES)
