"""What a task holds: settings of the session, tiles and sets made once, subscribers spread before they meet the dates."""

from __future__ import annotations

import pytest
from conftest import SMOKE_SF
from pyspark.sql import functions as F
from test_plans import explain
from test_tiles import DATES, rows, shifted

from telcolens import session
from telcolens.operators import tiles
from telcolens.plans import series
from telcolens.sources.driver_adapter import driver_tables

MERGED, FILES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.mark.parametrize("given,want", [("64MB", 8 << 20), ("256m", 8 << 20), (str(64 << 20), 8 << 20), ("16k", 16 << 10), ("1048576b", 1 << 20)])
def test_tables_are_read_in_small_tasks(spark, given, want):
    own = spark.newSession()
    own.conf.set(MERGED, given)
    own.conf.set(FILES, given)
    driver_tables(own, SMOKE_SF)
    assert session._bytes(own.conf.get(MERGED)) == session._bytes(own.conf.get(FILES)) == want
    assert int(own.conf.get(FIRST)) == session.PARTITIONS < 2000
    own.conf.set(FIRST, "5000")
    driver_tables(own, SMOKE_SF)
    assert own.conf.get(FIRST) == "5000"


def test_days_are_aggregated_once(spark):
    t = driver_tables(spark, SMOKE_SF)
    made = tiles.day_and_month_tiles(series.store_facts(t, "uses"), series.USES)
    assert "Generate" not in explain(made, "formatted")  # no row is copied to a level before it is aggregated
    assert made.groupBy("level", "start", *series.USES.group).count().where("count > 1").isEmpty()


def test_sets_are_made_where_their_values_are(spark):
    t = driver_tables(spark, SMOKE_SF)
    made = tiles.day_and_month_tiles(series.store_facts(t, "callers"), series.CALLERS)
    lines = explain(made, "simple").splitlines()
    assert any("bitmap_construct_agg" in x for x in lines)
    assert not any("Exchange" in a and "partial_bitmap" in b for a, b in zip(lines, lines[1:]))  # 4 KB for each row, where ids are sparse


def test_month_sets_are_the_days_sets(spark):
    facts = shifted(spark)["calls"]
    made = tiles.day_and_month_tiles(facts, series.CALLERS)
    month = F.trunc("call_date", "month").alias("start")
    want = facts.where("call_date IS NOT NULL").groupBy(month, "call_type_id").agg(F.count_distinct("caller_id"), F.sum("call_duration").cast("long"))
    got = made.where("level = 'month'").groupBy("start", "call_type_id").agg(tiles.set_size(), F.sum("seconds"))
    assert rows(got) == rows(want)


def test_subscribers_are_spread_before_they_meet_the_dates(spark, tmp_path):
    t, root = driver_tables(spark, SMOKE_SF), str(tmp_path)
    series.append_stores(t, root, ["payments", "uses"])
    lines = explain(series.t14_at_dates(t, root, DATES), "simple").splitlines()
    dates = next(i for i, x in enumerate(lines) if "Generate explode" in x)
    assert any("REPARTITION_BY_COL" in x for x in lines[dates + 1 : dates + 4])
