import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "SK_ID_CURR" in df.columns


def test_oracle_keys_subset_of_queries():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs) and len(qs) >= 80
