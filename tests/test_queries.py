import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    verdict, _ = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert verdict.startswith(("ok", "rows-only")), verdict


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["orderkey", "linenumber", "returnflag", "shipdate", "price_cents", "date", "hour"]
    assert df.count() == 6000
