"""Driver contract: entry runs; every query has an oracle."""

import __spark_entry__ as E


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["country_id", "province_id", "province_name", "category", "avg_weekday", "avg_weekend",
                          "avg_price"]
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    qs, sql = E.queries(), E.oracle_sql()
    assert len(qs) >= 150
    assert set(sql) <= set(qs)
