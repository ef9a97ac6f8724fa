"""Every registered query equals its DuckDB oracle at sf0.01 (rows, columns, values)."""

import pytest

from palimpsest.plans.check import compare, duck
from palimpsest.plans.registry import all_queries

from .conftest import SF

QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    fn, sql = QUERIES[name]
    res = compare(spark, con, name, fn, sql, SF)
    assert res["status"] in ("match", "rows-only"), res


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "gold", "silver", "pyte"]
    assert set(E.oracle_sql()) <= set(E.queries())
