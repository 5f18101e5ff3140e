"""Row order of the sorted reports (O1-O3, X16): the rows as Spark returns them
against the oracle's rows under a literal ORDER BY."""

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tools.check_oracle import TABLES, norm

SORTED = {
    "station_coverage": "data_tier, station_abbr",
    "duplicate_keys": "duplicate_count DESC, data_tier, station_abbr, reference_timestamp",
    "station_completeness": "station_abbr",
    "tier_counts": "data_tier",
    "fact_tier_counts": "source_tier",
    "stations_per_canton": "station_count DESC, station_canton",
    "station_inventory": "station_count DESC, station_canton",
    "high_elevation": "elevation_meters DESC NULLS FIRST, station_name",
    "newest_stations": "last_updated DESC NULLS FIRST, station_key",
    "daily_station": "station_key, measurement_date",
    "hourly_station": "station_name, measurement_date, measurement_hour",
    "canton_daily": "station_canton, measurement_date",
    "canton_daily_materialized": "station_canton, measurement_date",
    "monthly_station": "station_name, measurement_month",
    "extremes_30d": "max_temperature DESC NULLS FIRST, station_name",
    "yearly_compare": "measurement_year, station_name",
    "measurements_per_day": "measurement_date DESC",
    "completeness_per_day": "measurement_date DESC",
    "canton_series": "measurement_timestamp DESC, station_name",
    "silver_station_series": "reference_timestamp DESC, station_name",
    "series_in_list": "station_name, measurement_timestamp",
    "landing_listing": "folder || '/'",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def ordered(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, [tuple(map(norm, row)) for row in zip(*columns)]


@pytest.mark.parametrize("name", sorted(SORTED))
def test_report_order(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toArrow()
    want = con.sql(f"SELECT * FROM ({E.oracle_sql()[name]}) ORDER BY {SORTED[name]}").to_arrow_table()
    assert ordered(got) == ordered(want)


def test_nulls_sort_as_in_the_source_system(spark, con):
    """NULLS FIRST in a descending sort: stations without any temperature lead."""
    from foehn.plans import analytics
    import datetime as dt

    fact = spark.sql("""SELECT * FROM VALUES ('a', DATE'2024-01-02', 1.0, NULL, NULL, NULL), ('b', DATE'2024-01-02', NULL, 2.0, NULL, NULL),
        ('c', DATE'2024-01-02', 3.0, 2.0, NULL, NULL)
        AS t(station_key, measurement_date, temperature_2m, wind_gust_peak_ms, precipitation_total_mm, snow_depth_cm)""")
    dim = spark.sql("SELECT k AS station_key, k AS station_name, 'X' AS station_canton FROM VALUES ('a'), ('b'), ('c') AS t(k)")
    rows = analytics.extremes(fact, dim, dt.date(2024, 1, 3)).collect()
    assert [r["station_name"] for r in rows] == ["b", "c", "a"]
