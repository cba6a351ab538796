"""File loads (A2/A3), month-partitioned append (A8) with partition pruning, and the streaming
ingest of landing files."""

from __future__ import annotations

import contextlib
import io
import tempfile
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import AS_OF, read_fixture
from telcolens.sources.load import MONTH_COLUMN, append, from_rows, month_predicate, read_table
from telcolens.streaming.ingest import start_ingest

PAY_COLS = ["payment_id", "subscribers_id", "amount", "payment_type_id", "payment_date"]


def scratch() -> str:
    return tempfile.mkdtemp(prefix="telcolens-test-")


def test_csv_read_applies_defaults(spark):
    df = read_table(spark, "tests/fixtures/payment_method_type.csv", "payment_method_type", AS_OF,
                    fmt="csv", columns=["payment_type_id", "name"])
    r = df.orderBy("payment_type_id").collect()
    assert [x["payment_type_id"] for x in r] == [1, 2, 3, 4]
    assert all(x["status"] == "ACTIVE" and x["insert_date"] == AS_OF for x in r)
    assert dict(df.dtypes)["payment_type_id"] == "bigint"


def test_append_partitions_and_prunes(spark):
    out = scratch() + "/payments"
    rows = [[1, 1, Decimal("10.00"), 1, datetime(2023, 12, 5)], [2, 1, Decimal("20.00"), 2, datetime(2024, 1, 9)],
            [3, 2, Decimal("30.00"), 1, datetime(2024, 2, 1)]]
    append(from_rows(spark, "payments", PAY_COLS, rows, AS_OF), "payments", out)
    back = spark.read.parquet(out)
    assert back.count() == 3 and MONTH_COLUMN in back.columns
    q = back.where(month_predicate("2024-02-01 00:00:00", 1))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and MONTH_COLUMN in plan
    assert sorted(r["payment_id"] for r in q.collect()) == [2, 3]


def test_streaming_ingest_exactly_once(spark, fx):
    base = scratch()
    landing, target, ckpt = f"{base}/landing", f"{base}/calls", f"{base}/ckpt"
    cols, rows = read_fixture("calls")
    first = from_rows(spark, "calls", cols, rows[:30], AS_OF).select(*cols)
    first.write.mode("append").parquet(landing)
    q = start_ingest(spark, "calls", landing, target, cols, checkpoint=ckpt, subscribers=fx["subscribers"])
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == 30
    from_rows(spark, "calls", cols, rows[30:], AS_OF).select(*cols).write.mode("append").parquet(landing)
    q = start_ingest(spark, "calls", landing, target, cols, checkpoint=ckpt, subscribers=fx["subscribers"])
    q.awaitTermination(120)
    got = spark.read.parquet(target)
    assert got.count() == 61 and got.select("call_id").distinct().count() == 61
    c1 = got.where(F.col("call_id") == 1).collect()[0]
    assert c1["receiver_phone"] == "555-3456"
    assert "receiver_subscriber_id" not in got.columns


def test_csv_dates_and_catalog_ddl(spark):
    from telcolens.sources.schemas import create_table_sql

    df = read_table(spark, "tests/fixtures/subscribers.csv", "subscribers", AS_OF, fmt="csv",
                    columns=["subscribers_id", "name", "surname", "patronymic", "birth_date", "gender",
                             "email", "phone_number", "status", "changed_date"], null_value="NULL")
    # NULL tokens must be declared, or they fail the load; the date column parses from 'YYYY-MM-DD'
    r = df.where("subscribers_id = 1").collect()[0]
    assert str(r["birth_date"]) == "1990-01-01"
    loc = scratch() + "/payments"
    append(from_rows(spark, "payments", PAY_COLS, [[1, 1, Decimal("1.00"), 1, AS_OF]], AS_OF), "payments", loc)
    spark.sql(create_table_sql("payments", loc))
    spark.sql("ALTER TABLE payments RECOVER PARTITIONS")
    desc = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE TABLE payments").collect()}
    assert desc["amount"] == "Amount"
    assert spark.table("payments").count() == 1
    spark.sql("DROP TABLE payments")


def test_windowed_reports_prune_month_partitions(spark, fx):
    from conftest import load_fixture
    from telcolens.plans import questions as Q
    from tools.compare_oracle import canon

    old = [[1000 + m, 1 + m % 20, Decimal("7.00"), 1, datetime(2023, 1 + m, 15)] for m in range(12)]
    t = load_fixture(spark, {"payments": (PAY_COLS, old)})
    base = scratch()
    parted = dict(t)
    for name in ("payments", "calls", "sms_informations"):
        append(t[name], name, f"{base}/{name}")
        parted[name] = spark.read.parquet(f"{base}/{name}")
    q = Q.t08_payments_services_6m(parted, AS_OF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    assert "PartitionFilters: [isnotnull(event_month" in buf.getvalue()
    ref = Q.t08_payments_services_6m(t, AS_OF)
    assert canon(q.columns, [tuple(r) for r in q.collect()]) == canon(ref.columns, [tuple(r) for r in ref.collect()])
