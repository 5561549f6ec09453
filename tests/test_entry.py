"""Driver contract: entry() runs; every SQL twin has a query; streams equal their batch twins."""

import __spark_entry__ as e


def test_entry_runs(spark):
    df = e.entry(spark)
    assert df.count() > 0
    assert "overall_severity" in df.columns


def test_every_twin_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())
