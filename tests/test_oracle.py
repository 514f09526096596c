"""Every registered query against its DuckDB oracle (the correctness gate),
at sf 0.001."""

import pytest

import __spark_entry__ as entry
from spindle.plans import registry
from spindle.plans.verify import compare
from tests.conftest import SF_SMALL

registry.load_all()
QUERIES = registry.QUERIES
ORACLE = registry.ORACLE


def test_every_query_is_registered_with_known_name():
    assert len(QUERIES) >= 90
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["priority", "count"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = compare(df, duck_small, ORACLE[name])
    assert res["ok"], res
