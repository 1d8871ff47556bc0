"""Every registered query against its DuckDB oracle on the smallest
driver tables (the driver repeats this at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
TYPE_NAMES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = df.collect()
    cur = duck.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    a, ac = rows_of(df.columns, srows)
    b, bc = rows_of([d[0] for d in cur.description], drows)
    assert ac == bc
    assert len(a) == len(b)
    assert a == b
    stypes = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    dtypes = {d[0]: str(t) for d, t in zip(cur.description, duck.sql(E.oracle_sql()[name]).types)}
    assert stypes == dtypes
