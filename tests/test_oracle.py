"""Every registered query equals its SQL oracle (DuckDB) on sf0.001."""

import pytest

import __spark_entry__ as entry
from histmart.plans import catalog
from oracle_check import compare

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    r = compare(spark, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert r["cols_ok"], r
    assert r["rows_ok"], r
    assert r["hash_ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0
