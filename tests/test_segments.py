"""S1 segments: one pass over usage, and the same flags as T17 and T18 give."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SMOKE_SF
from telcolens.plans import profile, registry
from telcolens.plans.questions import t17_above_tariff_average, t18_above_age_average
from telcolens.sources.driver_adapter import AS_OF, driver_tables
from test_plans import explain


def test_usage_is_planned_once(spark, monkeypatch):
    made, calls = [], profile._usage_agg
    monkeypatch.setattr(profile, "_usage_agg", lambda *a: made.append(1) or calls(*a))
    p = explain(registry.queries()["s01_subscriber_segments"](spark, SMOKE_SF), "formatted")
    assert len(made) == 1 and "lineitem" not in p
    assert sum(line.endswith(")") and " Exchange " in line for line in p.split("\n\n")[0].splitlines()) <= 6


def test_flags_are_those_of_the_reports(spark):
    tables = driver_tables(spark, SMOKE_SF)
    got = {r["subscribers_id"]: (r["above_band_avg"], r["above_tariff_avg"]) for r in profile.s01_subscriber_segments(tables, AS_OF).collect()}
    band = {r["subscribers_id"]: r["above_band_avg"] for r in t18_above_age_average(tables, AS_OF).collect()}
    above = t17_above_tariff_average(tables, AS_OF).groupBy("subscribers_id").agg(F.max("above_tariff_avg").alias("x"))
    tariff = {r["subscribers_id"]: r["x"] for r in above.collect()}
    assert got == {k: (band[k], tariff.get(k)) for k in band}
