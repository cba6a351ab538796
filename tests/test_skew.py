"""A key holding a third of all rows: the fact side of a join is split by AQE (skew join), and every
row is kept. Input derived from the benchmark tables: a third of all calls get one receiver."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from conftest import ORACLE_SF
from telcolens.operators.lookup import enrich_receiver_phone
from telcolens.sources.driver_adapter import driver_tables

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_receiver_is_split(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        t = driver_tables(spark, ORACLE_SF)
        hot = F.when(F.col("line_number") % 3 == 0, F.lit(1)).otherwise(F.col("receiver_subscriber_id"))
        calls = t["calls"].withColumn("receiver_subscriber_id", hot)
        out = enrich_receiver_phone(calls, t["subscribers"])
        n = out.count()
        rows = out.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain()
        plan = buf.getvalue()
        assert "skew=true" in plan
        assert len(rows) == n == t["calls"].count()
        hot_rows = [r for r in rows if r["receiver_subscriber_id"] == 1]
        assert len(hot_rows) > n // 4 and {r["receiver_phone"] for r in hot_rows} == {"Customer#000000001"}
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
