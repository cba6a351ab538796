"""Every registered query over the driver tables equals its independent DuckDB SQL (sf0.001)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry

from telcolens.plans import registry
from conftest import SMOKE_SF
from telcolens.sources.driver_adapter import ADAPTED_COLUMNS, driver_tables
from tools.compare_oracle import TABLES, canon

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE_SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_adapted_columns(spark):
    t = driver_tables(spark, SMOKE_SF)
    for name, cols in ADAPTED_COLUMNS.items():
        assert tuple(t[name].columns) == cols, name


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "age_band" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMOKE_SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert canon(s_cols, s_rows) == canon(d_cols, d_rows)


def test_results_do_not_depend_on_session_time_zone(spark):
    names = ["t12_tariff_average", "t16_age_gender", "t10_sms_count_contents_12m", "t18_above_age_average"]
    before = spark.conf.get("spark.sql.session.timeZone")
    seen = {}
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Baku"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            for n in names:
                df = QUERIES[n](spark, SMOKE_SF)
                seen.setdefault(n, []).append(canon(df.columns, [tuple(r) for r in df.collect()]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for n, results in seen.items():
        assert results[0] == results[1] == results[2], n


# Row counts the survey probed on the sf0.01 benchmark tables for its readings.
SURVEY_ROWS_SF001 = {
    "t01_service_usage_3m": 9216, "t02_last_payment": 1500, "t03_active_service_totals": 992,
    "t04_calls_by_direction": 2998, "t05_tariff_fee_calls": 8940, "t06_calls_by_kind": 3,
    "t07_inactive_recent_payers": 86, "t08_payments_services_6m": 1445, "t09_top10_complainers": 10,
    "t10_sms_count_contents_12m": 1500, "t11_calls_payments": 1500, "t12_tariff_average": 6,
    "t13_sms_detail_12m": 5597, "t14_all_payments_services_6m": 1500, "t15_payments_complaints": 1500,
    "t16_age_gender": 20, "t17_above_tariff_average": 8940, "t18_above_age_average": 1500,
}


def test_survey_probe_counts(spark):
    from conftest import ORACLE_SF

    got = {n: QUERIES[n](spark, ORACLE_SF).count() for n in SURVEY_ROWS_SF001}
    assert got == SURVEY_ROWS_SF001
    assert QUERIES["t17_above_tariff_average"](spark, ORACLE_SF).where("above_tariff_avg").count() == 4237
    assert QUERIES["t18_above_age_average"](spark, ORACLE_SF).where("above_band_avg").count() == 715
