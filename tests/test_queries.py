"""Every query of the core against its SQL, or at least to its end."""

import pytest

from conftest import DATA, same_as_sql
from tidemark.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    if name in SQL:
        same_as_sql(df, duck, SQL[name])
    else:
        df.collect()


def test_flagship_is_registered():
    assert registry.FLAGSHIP in QUERIES
