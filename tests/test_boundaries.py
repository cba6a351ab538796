"""Rows added to the sample data to pin down edges the sample cannot show (window bounds, age bands,
nulls, duplicate names, non-payers, deactivated services) and the integrity checks."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, load_fixture
from telcolens.operators.quality import domain_violations, fk_summary, pk_violations
from telcolens.plans import questions as Q
from telcolens.sources.load import from_rows
from telcolens.sources.schemas import TABLES

SUB_COLS = ["subscribers_id", "name", "surname", "patronymic", "birth_date", "gender", "email",
            "phone_number", "status", "changed_date"]
CALL_COLS = ["call_id", "caller_id", "call_date", "call_duration", "receiver_phone", "call_type_id",
             "service_id", "call_type"]
SVC_COLS = ["service_id", "service_name", "description", "activation_date", "deactivation_date", "tariff_id"]


def sub(i, birth, name="Test", status="ACTIVE", gender="Male"):
    return [i, name, f"S{i}", None, birth, gender, None, f"900-{i:04d}", status, None]


EXTRA = {
    "subscribers": (
        SUB_COLS,
        [
            sub(21, date(2006, 2, 1)),  # 18 on the day itself
            sub(22, date(2005, 2, 2)),  # 18, turns 19 tomorrow
            sub(23, date(2005, 2, 1)),  # 19 today
            sub(24, date(1993, 2, 2)),  # 30
            sub(25, date(1993, 2, 1)),  # 31 today
            sub(26, date(1973, 2, 2)),  # 50
            sub(27, date(1973, 2, 1)),  # 51 today
            sub(28, None, status=None),  # unknown birth date and status; no activity
            sub(29, date(1990, 1, 1), name="John"),  # same name as subscriber 1
            sub(30, date(2000, 2, 29)),  # 29 February; uses a service, never pays
        ],
    ),
    "services": (
        SVC_COLS,
        [
            [12, "Service L", "already deactivated", AS_OF, datetime(2024, 1, 15), 1000],
            [13, "Service M", "deactivates later", AS_OF, datetime(2024, 3, 1), 1000],
        ],
    ),
    "calls": (
        CALL_COLS,
        [
            [1001, 2, datetime(2023, 11, 1, 0, 0, 0), 7, "x", 1, 5, "Send"],  # exact lower bound
            [1002, 2, datetime(2023, 10, 31, 23, 59, 59), 11, "x", 1, 6, "Send"],  # 1 s before
            [1003, 2, datetime(2024, 2, 1, 0, 0, 1), 13, "x", 1, 7, "Send"],  # after as_of
            [1004, 3, AS_OF, 17, "x", 1, None, "Send"],  # unknown service
            [1005, 30, AS_OF, 19, "x", 1, 12, "Send"],  # on the deactivated service
        ],
    ),
}


@pytest.fixture(scope="module")
def bx(spark):
    return {k: v.cache() for k, v in load_fixture(spark, EXTRA).items()}


def by_id(df, key="subscribers_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_window_edges_t01(bx):
    r = [x for x in Q.t01_service_usage_3m(bx, AS_OF).collect() if x["subscribers_id"] == 2]
    assert [(x["service_id"], x["uses"]) for x in r] == [(5, 1)]
    assert Q.t01_service_usage_3m(bx, AS_OF).where(F.col("service_id").isNull()).count() == 0


def test_questions_without_window_read_every_fact_t11(bx):
    # T11 names no window: the calls before the 3-month bound and after as_of all count.
    r = by_id(Q.t11_calls_payments(bx, AS_OF))
    assert r[2]["seconds"] == 7 + 11 + 13 and r[2]["calls"] == 3
    assert r[3]["seconds"] == 17


def test_age_bands_t16_t18(bx):
    r = by_id(Q.t18_above_age_average(bx, AS_OF))
    bands = {i: r[i]["age_band"] for i in range(21, 31)}
    assert bands == {
        21: "18 and below", 22: "18 and below", 23: "19-30", 24: "19-30", 25: "31-50",
        26: "31-50", 27: "51 and above", 28: "unknown", 29: "31-50", 30: "19-30",
    }
    counts = {(x["age_band"], x["gender"]): x["subscribers"] for x in Q.t16_age_gender(bx, AS_OF).collect()}
    assert counts[("18 and below", "Male")] == 2 and counts[("unknown", "Male")] == 1


def test_null_status_is_not_inactive_t07(bx):
    ids = {x["subscribers_id"] for x in Q.t07_inactive_recent_payers(bx, AS_OF).collect()}
    assert ids == {11, 12, 13, 14, 15}


def test_same_name_stays_two_subscribers(bx):
    r = by_id(Q.t15_payments_complaints(bx, AS_OF))
    assert r[1]["name"] == r[29]["name"] == "John"
    assert r[1]["payments"] == 6 and r[29]["payments"] == 0


def test_non_payer_t08_vs_t14(bx):
    t8 = by_id(Q.t08_payments_services_6m(bx, AS_OF))
    t14 = by_id(Q.t14_all_payments_services_6m(bx, AS_OF))
    assert 30 in t8 and int(t8[30]["amount"]) == 0 and t8[30]["services"] == 1
    assert 28 not in t8 and 28 in t14 and t14[28]["services"] == 0 and int(t14[28]["amount"]) == 0
    assert len(t14) == 30 and len(t8) == 21


def test_deactivated_service_t03(bx):
    r = by_id(Q.t03_active_service_totals(bx, AS_OF), "service_id")
    assert 12 not in r and 13 in r and r[13]["subscribers"] == 0 and int(r[13]["amount"]) == 0


def test_last_payment_none(bx):
    r = by_id(Q.t02_last_payment(bx, AS_OF))
    assert r[30]["payment_id"] is None and r[30]["payment_method"] is None and len(r) == 30


def test_omitted_column_vs_explicit_null(spark):
    a = from_rows(spark, "subscribers", ["subscribers_id", "name"], [[1, "A"]], AS_OF)
    b = from_rows(spark, "subscribers", ["subscribers_id", "name", "status"], [[2, "B", None]], AS_OF)
    ra, rb = a.collect()[0], b.collect()[0]
    assert ra["status"] == "ACTIVE" and ra["registration_date"] == AS_OF
    assert rb["status"] is None and rb["registration_date"] == AS_OF
    c = from_rows(spark, "complaints_and_support_requests", ["complaint_id"], [[1]], AS_OF).collect()[0]
    assert c["status"] == "UNSOLVED" and c["submission_date"] is None
    assert a.schema["status"].metadata["comment"]


def _keys():
    return {n: t.primary_key for n, t in TABLES.items() if t.primary_key}


def _fks():
    return [(n, c, p, pc) for n, t in TABLES.items() for c, p, pc in t.foreign_keys]


def test_integrity_clean_on_sample(fx):
    assert pk_violations(fx, _keys()).count() == 0
    assert fk_summary(fx, _fks()).where("orphan_rows > 0").count() == 0
    assert domain_violations(fx).where("violations > 0").count() == 0


def test_integrity_violations_found(spark, fx):
    t = dict(fx)
    t["payments"] = fx["payments"].unionByName(
        from_rows(spark, "payments", ["payment_id", "subscribers_id", "amount", "payment_type_id"],
                  [[1, 999, Decimal(5), 9], [None, 1, Decimal(5), 1]], AS_OF)
    )
    t["subscribers"] = fx["subscribers"].unionByName(
        from_rows(spark, "subscribers", ["subscribers_id", "name"], [[12345678901, "x" * 61]], AS_OF)
    )
    pk = {(r["table_name"], r["key_value"]): r["n_rows"] for r in pk_violations(t, _keys()).collect()}
    assert pk == {("payments", "1"): 2, ("payments", "<null>"): 1}
    fk = {(r["table_name"], r["column_name"]): (r["orphan_rows"], r["orphan_keys"])
          for r in fk_summary(t, _fks()).collect()}
    assert fk[("payments", "subscribers_id")] == (1, 1)
    assert fk[("payments", "payment_type_id")] == (1, 1)
    assert fk[("calls", "caller_id")] == (0, 0)
    dom = {(r["table_name"], r["column_name"], r["rule"]): r["violations"]
           for r in domain_violations(t).collect()}
    assert dom[("subscribers", "name", "max_length")] == 1
    assert dom[("subscribers", "subscribers_id", "max_digits")] == 1
    assert dom[("subscribers", "surname", "max_length")] == 0
    assert dom[("subscribers", "phone_number", "max_bytes")] == 0
