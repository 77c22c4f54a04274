import __spark_entry__ as entry


def test_entry_and_names(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and "adj_close" in rows.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
