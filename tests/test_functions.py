"""Scalar helpers: month arithmetic, windows, age and bands, against calendar arithmetic."""

from __future__ import annotations

from datetime import date, datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telcolens.functions.people import age_band, age_years
from telcolens.functions.timewin import in_last_months, months_before


def test_months_before_clamps_month_end():
    assert months_before("2024-03-31 10:00:00", 1) == datetime(2024, 2, 29, 10, 0)
    assert months_before("2023-03-31 00:00:00", 1) == datetime(2023, 2, 28)
    assert months_before("2024-02-01 00:00:00", 3) == datetime(2023, 11, 1)
    assert months_before("2024-01-15 00:00:00", 12) == datetime(2023, 1, 15)


def test_months_before_equals_spark_interval(spark):
    for s in ["2024-03-31 10:00:00", "2024-05-31 00:00:00", "2023-08-30 12:34:56"]:
        for n in (1, 3, 6, 12):
            got = spark.range(1).select(
                (F.lit(s).cast("timestamp_ntz") - F.expr(f"INTERVAL {n} MONTHS")).alias("x")
            ).collect()[0]["x"]
            assert got == months_before(s, n), (s, n)


def test_window_inclusive(spark):
    df = spark.createDataFrame(
        [(datetime(2023, 11, 1),), (datetime(2023, 10, 31, 23, 59, 59),), (datetime(2024, 2, 1),),
         (datetime(2024, 2, 1, 0, 0, 1),)],
        "t timestamp_ntz",
    )
    kept = [r["t"] for r in df.where(in_last_months("t", "2024-02-01 00:00:00", 3)).collect()]
    assert sorted(kept) == [datetime(2023, 11, 1), datetime(2024, 2, 1)]


def calendar_age(birth: date, as_of: date) -> int:
    return as_of.year - birth.year - ((as_of.month, as_of.day) < (birth.month, birth.day))


@settings(max_examples=1, deadline=None)
@given(st.data())
def test_age_matches_calendar(spark, data):
    births = data.draw(st.lists(st.dates(date(1900, 1, 1), date(2024, 1, 1)), min_size=300, max_size=300))
    as_of = date(2024, 2, 1)
    df = spark.createDataFrame([(b,) for b in births], "b date")
    got = [r["a"] for r in df.select(age_years("b", "2024-02-01 00:00:00").alias("a")).collect()]
    assert got == [calendar_age(b, as_of) for b in births]


def test_age_month_end_rule(spark):
    # Both month ends count as the same day of month (months_between semantics).
    df = spark.createDataFrame([(date(2000, 2, 29),)], "b date")
    a = df.select(age_years("b", "2023-02-28 00:00:00").alias("a")).collect()[0]["a"]
    assert a == 23


def test_bands(spark):
    df = spark.createDataFrame([(x,) for x in [None, 0, 18, 19, 30, 31, 50, 51, 99]], "a int")
    got = [r["b"] for r in df.select(age_band(F.col("a")).alias("b")).collect()]
    assert got == ["unknown", "18 and below", "18 and below", "19-30", "19-30", "31-50", "31-50",
                   "51 and above", "51 and above"]


def test_age_spark_equals_oracle_sql_on_month_ends(spark):
    """The DataFrame age (months_between) and the oracle's calendar formula agree on every pair of
    a grid of birth dates and report times, month ends and 29 February included."""
    import duckdb

    from telcolens.plans.oracle import _age

    births = [date(y, m, d) for y in (1996, 2000, 2001) for m, d in
              [(1, 31), (2, 28), (2, 29), (3, 1), (3, 31), (4, 30), (6, 15), (12, 31)]
              if not (m == 2 and d == 29 and y % 4)]
    as_ofs = [datetime(y, m, d, h) for y, m, d, h in
              [(2023, 2, 28, 0), (2024, 2, 28, 0), (2024, 2, 29, 0), (2024, 2, 29, 13), (2023, 3, 31, 0),
               (2024, 4, 30, 0), (2024, 6, 14, 23), (2024, 6, 15, 0), (2024, 12, 31, 0), (2025, 1, 1, 0)]]
    pairs = [(b, a) for b in births for a in as_ofs]
    spark_ages = []
    for a in as_ofs:
        df = spark.createDataFrame([(b,) for b in births], "b date")
        spark_ages += [(b, a, r["x"]) for b, r in zip(births, df.select(
            age_years("b", a.isoformat(sep=" ")).alias("x")).collect())]
    con = duckdb.connect()
    duck = {}
    for b, a in pairs:
        birth, report = "DATE '" + b.isoformat() + "'", "TIMESTAMP '" + a.isoformat(sep=" ") + "'"
        sql = "SELECT " + _age(birth, report)
        duck[(b, a)] = con.execute(sql).fetchone()[0]
    assert [(b, a, x) for b, a, x in spark_ages if duck[(b, a)] != x] == []
