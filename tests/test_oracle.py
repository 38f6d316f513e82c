"""Every query of the catalog against its DuckDB oracle on the sf0.001 tables:
same column names, same row count, same multiset of rounded values."""

import pytest

import __spark_entry__ as entry
from shelfline.plans.catalog import ORACLE, QUERIES
from tests.conftest import SMALL
from tools.check import rows_of


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)


def test_entry_registers_the_whole_catalog():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[key])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert rows_of(s_cols, s_rows) == rows_of(o_cols, o_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["tile", "ord", "label", "value"]
    assert df.count() > 0
