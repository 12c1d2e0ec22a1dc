"""Driver contract smoke checks on the smallest scale factor."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "user_id" in df.columns


def test_oracles_cover_sql_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 70
