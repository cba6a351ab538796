"""D8 / T10 in parts of n rows, and A3 defaults in SQL."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from conftest import AS_OF, LOAD_TS, load_fixture, read_fixture

from telcolens.operators.rollup import ordered_concat_rows, running_count
from telcolens.plans import questions as Q
from telcolens.sources.schemas import TABLES, create_table_sql

SMS_COLS = ["sms_id", "sender_id", "sms_date", "receiver_phone", "sms_content", "sms_type_id", "insert_date", "service_id"]
SCHEMA = "k long, v string, at timestamp_ntz, id long, n long"


def messages(rows):
    """A third of all rows are one sender's in one hour, many in one second; some without time, text or sender; repeated rows."""
    rng = random.Random(4)
    start, out = datetime(2024, 1, 1, 10), []
    for i in range(rows):
        hot = i % 3 == 0
        at = start + (timedelta(milliseconds=rng.randrange(3_600_000)) if hot else timedelta(minutes=rng.randrange(50_000)))
        at = start if i % 11 == 0 else None if i % 17 == 0 else at
        out.append((1 if hot else None if i % 23 == 0 else rng.choice([2, 3, 4]), None if i % 13 == 0 else f"m{i}", at, i % 50, i))
    return out + out[:30]


def ordered(rows):
    key = lambda r: (r[2] is not None, r[2] or datetime.min, r[3] is not None, r[3] or 0)
    groups = {}
    for r in sorted(rows, key=key):
        groups.setdefault(r[0], []).append(r)
    return groups


def test_rows_are_numbered_in_order(spark):
    rows = messages(900)
    got = running_count(spark.createDataFrame(rows, SCHEMA), "k", "at", "id", "number").collect()
    assert sorted((r[:5] for r in map(tuple, got)), key=repr) == sorted(rows, key=repr)
    for k, mine in ordered(rows).items():
        own = sorted((r for r in got if r["k"] == k), key=lambda r: r["number"])
        assert [r["number"] for r in own] == list(range(len(mine)))
        assert [(r["at"], r["id"]) for r in own] == [(r[2], r[3]) for r in mine]


def test_parts_are_bounded_by_rows(spark):
    rows = messages(900)
    got = ordered_concat_rows(spark.createDataFrame(rows, SCHEMA), "k", "v", "at", "id", "text", "n", 7).collect()
    for k, mine in ordered(rows).items():
        parts = sorted((r for r in got if r["k"] == k), key=lambda r: r["part_no"])
        assert [r["part_no"] for r in parts] == list(range(len(parts))) and [r["n"] for r in parts] == [len(mine[i : i + 7]) for i in range(0, len(mine), 7)]
        texts = [x for r in parts if r["text"] is not None for x in r["text"].split("; ")]
        assert sorted(texts) == sorted(r[1] for r in mine if r[1] is not None)
    assert max(r["n"] for r in got) == 7
    empty = ordered_concat_rows(spark.createDataFrame([], SCHEMA), "k", "v", "at", "id", "text", "n", 7)
    assert empty.count() == 0


def test_no_task_has_more_than_its_share(spark):
    """The sender's rows, a third of all and in one hour, are spread over the shuffle's partitions by second."""
    rows = [(1 if i % 3 == 0 else i, f"m{i}", datetime(2024, 1, 1, 10) + timedelta(milliseconds=400 * (i % 9000)), i, i) for i in range(9000)]
    number = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "date_trunc('second', at) AS second")
    sizes = [r["count"] for r in number.repartition(8, "k", "second").selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
    assert max(sizes) < 2 * sum(sizes) / 8
    df = spark.createDataFrame(rows, SCHEMA)
    plan = running_count(df, "k", "at", "id", "number")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert len(windows) == 1 and "_second" in windows[0].split("], [", 1)[1]


def test_t10_by_rows_is_t10(spark):
    rng, start = random.Random(7), AS_OF - timedelta(days=300)
    rows = [[10_000 + i, 6 if i % 3 else rng.choice([7, 8]), start + timedelta(seconds=rng.randrange(4000)), "1", f"m{i}", 1, AS_OF, 2] for i in range(300)]
    t = load_fixture(spark, {"sms_informations": (SMS_COLS, rows)})
    whole = {r["subscribers_id"]: r for r in Q.t10_sms_count_contents_12m(t, AS_OF).collect()}
    parts = {}
    for r in sorted(Q.t10_sms_contents_by_rows_12m(t, AS_OF, rows=10).collect(), key=lambda r: r["part_no"] or 0):
        parts.setdefault(r["subscribers_id"], []).append(r)
    assert parts.keys() == whole.keys()
    for k, own in parts.items():
        assert sum(r["sms_count"] for r in own) == whole[k]["sms_count"]
        text = [r["sms_contents"] for r in own if r["sms_contents"] is not None]
        assert ("; ".join(text) or None) == whole[k]["sms_contents"] and max(r["sms_count"] for r in own) <= 10


def test_sql_inserts_fill_defaults_as_loads_do(spark, tmp_path):
    for name in ("subscribers", "complaints_and_support_requests", "call_type"):
        columns, rows = read_fixture(name)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(create_table_sql(name, str(tmp_path / name), partition_column=None, load_ts=str(LOAD_TS)))
        spark.createDataFrame([tuple(r) for r in rows], TABLES[name].schema.__class__([TABLES[name].schema[c] for c in columns])).createOrReplaceTempView("given")
        spark.sql(f"INSERT INTO {name} ({', '.join(columns)}) SELECT {', '.join(columns)} FROM given")
        want = load_fixture(spark)[name].select(*TABLES[name].schema.names)
        got = spark.table(name).select(*want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), name
        assert {f.name: f.metadata.get("comment") for f in spark.table(name).schema} == {f.name: f.metadata.get("comment") for f in TABLES[name].schema}
        spark.sql(f"DROP TABLE {name}")


def test_sysdate_default_without_a_load_time(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS call_type")
    spark.sql(create_table_sql("call_type", str(tmp_path / "now")))
    spark.sql("INSERT INTO call_type (call_type_id, status) VALUES (1, NULL)")
    r = spark.table("call_type").first()
    spark.sql("DROP TABLE call_type")
    assert r["status"] is None and abs((r["insert_date"] - datetime.now()).total_seconds()) < 86_400 * 2
