"""Every corpus query that SQL can express, against that SQL."""

import pytest

from cartflow.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, name):
    with connect(sf_dir) as oracle:
        assert differences(QUERIES[name](spark, sf_dir), oracle, ORACLES[name]) is None
