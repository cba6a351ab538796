"""Faults found in review: exact mean comparison, file loads, key types, jobs while building, file counts."""

from __future__ import annotations

import glob
from decimal import Decimal

import pytest
from conftest import AS_OF, LOAD_TS, SMOKE_SF, load_fixture
from pyspark.sql import functions as F

from telcolens.operators.quality import fk_summary
from telcolens.operators.ranking import compare_to_group_mean
from telcolens.plans import registry
from telcolens.plans.batch import REPORTS
from telcolens.sources.load import append, read_table, resolve_lookups


def test_equal_payers_are_not_above_their_mean(spark):
    rows = [(i, 1, Decimal("1.10")) for i in range(3)] + [(9, 2, Decimal("5.00")), (10, 2, Decimal("1.00")), (11, None, Decimal("3.00"))]
    df = spark.createDataFrame(rows, "id int, g int, v decimal(38,2)")
    known = spark.createDataFrame([(1,), (2,)], "g int")
    got = {r["id"]: r["above"] for r in compare_to_group_mean(df, "g", "v", "mean", "above", known=known).collect()}
    assert got == {0: False, 1: False, 2: False, 9: True, 10: False, 11: None}
    unknown = compare_to_group_mean(df, "g", "v", "mean", "above", known=known.where("g = 1"))
    assert [r["above"] for r in unknown.where("id >= 9").collect()] == [None] * 3


def test_building_a_query_runs_no_job(spark):
    sc = spark.sparkContext
    fns = registry.queries()
    for fn in fns.values():  # schemas are declared: nothing is read while a plan is built
        sc.setJobGroup("building", "building")
        fn(spark, SMOKE_SF)
        assert not sc.statusTracker().getJobIdsForGroup("building")
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_files_give_defaults_and_phones(spark, tmp_path):
    spark.createDataFrame([(1, "A", "+1")], "subscribers_id long, name string, phone_number string").write.parquet(f"{tmp_path}/s")
    spark.createDataFrame([(5, 1, 1)], "call_id long, caller_id long, receiver_subscriber_id long").write.parquet(f"{tmp_path}/c")
    t = {"subscribers": read_table(spark, f"{tmp_path}/s", "subscribers", LOAD_TS), "calls": read_table(spark, f"{tmp_path}/c", "calls", LOAD_TS)}
    s = t["subscribers"].head()
    assert (s["status"], s["registration_date"], s["changed_date"]) == ("ACTIVE", LOAD_TS, None)
    c = resolve_lookups(t)["calls"].head()
    assert (c["receiver_phone"], c["call_date"]) == ("+1", LOAD_TS)


def test_csv_defaults_and_loud_errors(spark, tmp_path):
    (tmp_path / "good.csv").write_text("subscribers_id,extra,name\n7,x,B\n")
    s = read_table(spark, f"{tmp_path}/good.csv", "subscribers", LOAD_TS, fmt="csv").head()
    assert (s["subscribers_id"], s["name"], s["status"]) == (7, "B", "ACTIVE")
    (tmp_path / "bad.csv").write_text("subscribers_id,name\nabc,B\n")
    with pytest.raises(Exception, match="MALFORMED|abc"):
        read_table(spark, f"{tmp_path}/bad.csv", "subscribers", LOAD_TS, fmt="csv").collect()


def test_foreign_keys_of_other_types(spark):
    child = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.50"),), (Decimal("9.00"),), (None,)], "k decimal(10,2)")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    row = fk_summary({"child": child, "parent": parent}, [("child", "k", "parent", "id")]).head()
    assert (row["orphan_rows"], row["orphan_keys"]) == (2, 2)


def test_reports_of_a_batch_cut_nothing(fx):
    calls = REPORTS["s03_call_enrichment"](fx, AS_OF)
    assert calls.count() == fx["calls"].count()


def test_append_writes_few_files_per_month(spark, tmp_path):
    rows = spark.range(0, 2400, 1, 8).select(
        F.col("id").alias("payment_id"), F.lit(1).cast("long").alias("subscribers_id"), F.lit(1).cast("decimal(18,2)").alias("amount"),
        F.lit(1).cast("long").alias("payment_type_id"),
        F.expr("CAST(timestamp'2024-01-05' + make_interval(0, CAST(id % 12 AS INT)) AS TIMESTAMP_NTZ)").alias("payment_date"),
    )
    append(rows, "payments", f"{tmp_path}/p")
    assert len(glob.glob(f"{tmp_path}/p/*/*.parquet")) <= 24


def test_top_complainers_are_ordered(spark):
    fx = load_fixture(spark)
    rows = [(-r["complaints"], r["subscribers_id"]) for r in REPORTS["t09_top10_complainers"](fx, AS_OF).collect()]
    assert rows == sorted(rows)
