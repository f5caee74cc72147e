"""Every query with a SQL counterpart, side by side on the smallest data."""

import pytest

from checks.compare import compare, connect
from checks.expected import EXPECTED
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
# Whole builds are covered by test_build; running them here would only take time.
WHOLE_BUILDS = {"layer_row_counts", "published_tables"}


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_expected_result_has_a_query():
    assert set(EXPECTED) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WHOLE_BUILDS))
def test_query(spark, connection, name):
    assert compare(spark, connection, SF, name) == ""
