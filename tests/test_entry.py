"""Driver contract: entry() smoke, and every registered query against its
DuckDB oracle on the smallest scale (same comparison as tools/check_oracle)."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_of


# queries whose rows are undefined by design (sampling): row count only
ROWS_ONLY = {"sample_rows": 100}


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "active_stations" in df.columns


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, con, name):
    st = E.queries()[name](spark, SF_SMALL).toArrow()
    sql = E.oracle_sql().get(name)
    if name in ROWS_ONLY:
        assert sql is None and st.num_rows == ROWS_ONLY[name]
        return
    assert sql is not None, "every registered query has an oracle"
    dt_ = con.sql(sql).to_arrow_table()
    sn, sr = rows_of(st)
    dn, dr = rows_of(dt_)
    assert sn == dn
    assert sr == dr


TIME_SENSITIVE = ["fact_realtime", "last_hour", "hourly_yesterday", "load_history", "stream_live_keys",
                  "csv_typed_parse", "station_coverage"]


@pytest.mark.parametrize("name", TIME_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    """Wall-clock (NTZ) semantics: the same rows under a non-UTC session zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        st = E.queries()[name](spark, SF_SMALL).toArrow()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert rows_of(st) == rows_of(con.sql(E.oracle_sql()[name]).to_arrow_table())
