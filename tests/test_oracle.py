"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from cohortline.plans.catalog import QUERIES
from cohortline.plans.verify import canon, duck, type_mismatches
from tests.conftest import SF_SMALL

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) >= set(QUERIES)
    assert set(entry.queries()) >= set(QUERIES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert type_mismatches(df.dtypes, rel.columns, rel.types) == {}
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert canon(rows, df.columns) == canon(orows, rel.columns)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["product", "custom_channel", "purchase_cnt"]
    assert df.count() > 0
