"""Every registered query against its SQL on the same tables."""

import pytest

from mailstream.catalog import ORACLE_SQL, QUERIES
from compare import SF_DIR, assert_same


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    assert_same(QUERIES[name](spark, SF_DIR), ORACLE_SQL[name])
