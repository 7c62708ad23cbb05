"""The driver's contract."""

import __spark_entry__ as entry


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["date", "record_count", "avg_quality"] and got.count() == 30


def test_keys():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert len(queries) >= 75 and set(oracles) <= set(queries)
    assert all(callable(q) for q in queries.values()) and all(isinstance(s, str) for s in oracles.values())
