"""Reports at many dates from day and month tiles equal the direct reports; sets count as distinct does."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import load_fixture
from pyspark.sql import functions as F
from test_plans import explain

from telcolens.functions.timewin import in_last_months, months_before, restrict
from telcolens.operators import tiles
from telcolens.plans import questions as q
from telcolens.plans import series

DATES = [
    "2024-02-01 00:00:00", "2024-01-31 23:59:59", "2024-02-29 12:00:00", "2023-12-31 00:00:00", "2024-03-01 00:00:01", "2023-08-15 06:30:00",
    "2023-02-28 23:59:59", "2024-01-15 10:00:00", "2023-11-30 00:00:00", "2022-06-01 00:00:00", "2024-07-31 18:45:12", "2030-01-01 00:00:00",
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("months", [0, 1, 6, 13])
@pytest.mark.parametrize("as_of", [*DATES, "2024-02-01 00:00:00.000001"])
def test_pieces_cover_a_window_once(as_of, months):
    p = tiles.pieces(as_of, months)
    spans = [(datetime(d.year, d.month, 1), (datetime(d.year, d.month, 1) + timedelta(days=32)).replace(day=1)) for d in p.months]
    spans += [(datetime(d.year, d.month, d.day), datetime(d.year, d.month, d.day) + timedelta(days=1)) for d in p.days]
    spans = sorted(spans + [(a, b + timedelta(microseconds=1) if end else b) for a, b, end in p.edges])
    hi = datetime.fromisoformat(as_of)
    assert spans[0][0] == months_before(hi, months) and spans[-1][1] == hi + timedelta(microseconds=1)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and len(p.days) <= 60 and len(p.edges) <= 2


def shifted(spark):
    """The sample rows, spread over times that include window edges, with a hot subscriber, null times, keys and unknown ids."""
    t = dict(load_fixture(spark))
    edges = sorted({d for a in DATES for m in (0, 3, 6) for d in (months_before(a, m),)})
    times = [x + timedelta(seconds=s) for x in edges for s in (-1, 0, 1)] + [None]
    pays = [(i, [7, 7, i % 9, None, 99999][i % 5], d, float(i) + 0.25) for i, d in enumerate(times)]
    pay = spark.createDataFrame(pays, "payment_id long, subscribers_id long, payment_date timestamp_ntz, amount double")
    pay = pay.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    t["payments"] = t["payments"].unionByName(pay, allowMissingColumns=True)
    calls = [(i, [7, 7, i % 9, None, 10**15 + i, -i][i % 6], [1, 2, None][i % 3], [1, 2, None, 12345][i % 4], d, i) for i, d in enumerate(times)]
    call = spark.createDataFrame(calls, "call_id long, caller_id long, call_type_id long, service_id long, call_date timestamp_ntz, call_duration int")
    call = call.withColumn("call_duration", F.col("call_duration").cast(t["calls"].schema["call_duration"].dataType))
    t["calls"] = t["calls"].unionByName(call, allowMissingColumns=True)
    return {k: v.cache() for k, v in t.items()}


def test_reports_at_twelve_dates(spark, tmp_path):
    t, root = shifted(spark), str(tmp_path)
    # Two batches of facts, the second with late rows of the same days.
    for odd in (True, False):
        of = {n: t[n].where((F.coalesce(F.pmod(k, F.lit(2)), F.lit(0)) == 1) == odd) for n, k in (("payments", "payment_id"), ("calls", "call_id"), ("sms_informations", "sms_id"))}
        series.append_stores({**t, **of}, root)

    def direct(report, **more):
        return sorted(((datetime.fromisoformat(d), *r) for d in DATES for r in map(tuple, report(t, d, **more).collect())), key=str)

    assert rows(series.t01_at_dates(t, root, DATES)) == direct(q.t01_service_usage_3m)
    assert rows(series.t07_at_dates(t, DATES)) == direct(q.t07_inactive_recent_payers)
    assert rows(series.t08_at_dates(t, root, DATES)) == direct(q.t08_payments_services_6m)
    assert rows(series.t14_at_dates(t, root, DATES)) == direct(q.t14_all_payments_services_6m)
    by_kind = lambda t, d: q.t06_calls_by_kind({**t, "calls": restrict(t["calls"], "call_date", d, 12)}, d)
    want = direct(by_kind)
    assert rows(series.t06_at_dates(t, root, DATES)) == want and any(r[1] is None for r in want)


def test_sets_count_as_distinct_does(spark):
    ids = spark.range(50_000).selectExpr("id % 3 AS k", "CASE WHEN id % 5 = 0 THEN id * 1000003 WHEN id % 5 = 1 THEN -id WHEN id % 5 = 2 THEN null ELSE id % 700 END AS x")
    ids = ids.where("x IS NULL OR x < 400000000")
    tile = tiles.Tile("day", ("k",), distinct="x")
    whole = tile.grouped_facts(ids).groupBy("k").agg(tiles.set_size().alias("n"))
    assert rows(whole) == rows(ids.groupBy("k").agg(F.count_distinct("x").alias("n")))


def test_tiles_and_edges_only(spark, tmp_path):
    path, old = str(tmp_path / "tiles"), str(tmp_path / "payments")
    days = spark.range(4000).selectExpr("id AS payment_id", "id % 10 AS subscribers_id", "TIMESTAMP_NTZ '2023-01-01 08:00:00' + make_dt_interval(0, id * 3) AS payment_date", "CAST(id AS DECIMAL(18,2)) AS amount")
    days.write.parquet(old)
    facts = spark.read.schema(days.schema).parquet(old)
    tiles.append_tiles(facts, series.PAYMENTS, path)
    got = tiles.at_dates(spark, path, facts, series.PAYMENTS, ["2024-01-15 09:00:00", "2023-12-31 00:00:00"], 6)
    p = explain(got, "formatted")
    assert "PartitionFilters: [isnotnull(event_month" in p.replace("PartitionFilters: [event_month#", "PartitionFilters: [isnotnull(event_month") and "2023-07-15T09:00" in p
    for d, n in [("2024-01-15 09:00:00", 6), ("2023-12-31 00:00:00", 6)]:
        want = facts.where(in_last_months("payment_date", d, n)).groupBy("subscribers_id").agg(F.count(F.lit(1)), F.sum("amount").cast("decimal(38,2)"))
        assert rows(got.where(F.col("as_of") == F.expr(f"TIMESTAMP_NTZ '{d}'")).drop("as_of")) == rows(want)
