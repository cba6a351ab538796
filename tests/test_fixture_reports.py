"""The sample rows of the data model: load tallies and the expected answer of every question."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from telcolens.plans import questions as Q
from telcolens.plans.profile import s01_subscriber_profile, s02_service_performance, s03_call_enrichment


def rows(df):
    return [r.asDict() for r in df.collect()]


def by(df, key):
    return {r[key]: r for r in rows(df)}


# ---------------------------------------------------------------- load tallies


def test_row_counts(fx):
    expected = {
        "subscribers": 20, "address_type": 3, "address": 45, "tariff_informations": 8, "call_type": 3,
        "services": 11, "calls": 61, "sms_types": 4, "sms_informations": 47, "payment_method_type": 4,
        "payments": 105, "complaint_type": 7, "complaints_and_support_requests": 28, "technical_data": 19,
    }
    assert {k: fx[k].count() for k in expected} == expected


def test_subscriber_tallies(fx):
    r = rows(fx["subscribers"])
    assert Counter(x["status"] for x in r) == {"ACTIVE": 15, "PASSIVE": 5}
    assert {x["subscribers_id"] for x in r if x["status"] == "PASSIVE"} == {11, 12, 13, 14, 15}
    assert Counter(x["gender"] for x in r) == {"Male": 10, "Female": 10}
    # registration_date was omitted: filled with the load time; changed_date was explicit null.
    assert all(x["registration_date"] == AS_OF for x in r)
    assert sum(x["changed_date"] is None for x in r) == 15


def test_dimension_defaults(fx):
    for name in ("address_type", "call_type", "payment_method_type", "sms_types", "complaint_type"):
        r = rows(fx[name])
        assert all(x["status"] == "ACTIVE" and x["insert_date"] == AS_OF for x in r), name
        assert all(x["changed_date"] is None for x in r), name


def test_tariffs_services_addresses(fx):
    t = rows(fx["tariff_informations"])
    assert sorted(x["tariff_id"] for x in t if x["status"] == "ACTIVE") == [1000, 1001, 1002, 1003, 1007]
    assert sorted(x["tariff_id"] for x in t if x["status"] == "PASSIVE") == [1004, 1005, 1006]
    assert by(fx["tariff_informations"], "tariff_id")[1001]["message_price"] == Decimal("0.0150")
    assert Counter(x["tariff_id"] for x in rows(fx["services"])) == {1000: 5, 1001: 4, 1004: 2}
    per_sub = Counter(x["subscribers_id"] for x in rows(fx["address"]))
    assert all(per_sub[i] == 3 for i in range(1, 11))
    assert all(per_sub[i] == 2 for i in range(11, 16))
    assert all(per_sub[i] == 1 for i in range(16, 21))


def test_call_tallies_and_phone_lookup(fx):
    r = rows(fx["calls"])
    assert sum(x["call_duration"] for x in r) == 1245
    assert Counter(x["call_type"] for x in r) == {"Send": 47, "Receive": 14}
    assert Counter(x["call_type_id"] for x in r) == {1: 29, 2: 18, 3: 14}
    phones = {x["subscribers_id"]: x["phone_number"] for x in rows(fx["subscribers"])}
    literal = {x["call_id"] for x in r if x["receiver_phone"] not in phones.values()}
    assert literal == {6, 7, 8, 11}
    c1 = next(x for x in r if x["call_id"] == 1)
    assert c1["receiver_phone"] == phones[3]
    assert "receiver_subscriber_id" not in fx["calls"].columns


def test_sms_payment_complaint_device_tallies(fx):
    s = rows(fx["sms_informations"])
    assert Counter(x["sms_type_id"] for x in s) == {1: 9, 2: 19, 3: 19}
    assert Counter(x["service_id"] for x in s) == {1: 10, 2: 19, 3: 9, 4: 9}
    phones = {x["phone_number"] for x in rows(fx["subscribers"])}
    assert {x["sms_id"] for x in s if x["receiver_phone"] not in phones} == {4, 5, 6}
    p = rows(fx["payments"])
    assert Counter(x["payment_type_id"] for x in p) == {1: 35, 2: 34, 3: 18, 4: 18}
    assert {x["amount"] for x in p} == {Decimal("100.00")}
    c = rows(fx["complaints_and_support_requests"])
    assert Counter(x["status"] for x in c) == {"SOLVED": 21, "UNSOLVED": 7}
    assert Counter(x["complaint_type_id"] for x in c) == {10: 5, 20: 4, 30: 3, 40: 4, 50: 4, 60: 4, 70: 4}
    assert 17 not in {x["complaint_id"] for x in c}
    d = rows(fx["technical_data"])
    phones_ = [x for x in d if x["device_type"] == "PHONE"]
    assert len(phones_) == 12 and all(x["network_type"] is None for x in phones_)
    assert Counter(x["operating_system"] for x in phones_) == {"IOS": 6, "Android": 6}
    modems = [x for x in d if x["device_type"] == "MODEM"]
    assert Counter(x["network_type"] for x in modems) == {"3G": 3, "4G": 2, "5G": 2}


# ---------------------------------------------------------------- questions


def test_t01(fx):
    r = rows(Q.t01_service_usage_3m(fx, AS_OF))
    assert len(r) == 75 and sum(x["uses"] for x in r) == 108
    top = max(r, key=lambda x: x["uses"])
    assert (top["subscribers_id"], top["service_id"], top["uses"]) == (6, 2, 9)
    assert top["name"] == "David" and top["service_name"] == "Service B"


def test_t02(fx):
    r = by(Q.t02_last_payment(fx, AS_OF), "subscribers_id")
    assert len(r) == 20
    assert [r[i]["payment_id"] for i in range(1, 6)] == [101, 102, 103, 104, 105]
    assert [r[i]["payment_id"] for i in range(6, 21)] == list(range(86, 101))
    assert {x["amount"] for x in r.values()} == {Decimal("100.00")}
    assert r[1]["payment_type_id"] == 3 and r[6]["payment_type_id"] == 4
    assert r[1]["payment_method"] == "Bank köçürməsi"


def test_t03(fx):
    r = by(Q.t03_active_service_totals(fx, AS_OF), "service_id")
    got = {k: (v["subscribers"], int(v["amount"])) for k, v in r.items()}
    exp = {1: (9, 4700), 2: (12, 6100), 3: (9, 4600), 4: (10, 5100), 11: (5, 2500)}
    exp.update({i: (5, 2700) for i in (5, 6, 7)})
    exp.update({i: (5, 2600) for i in (8, 9, 10)})
    assert got == exp
    strict = by(Q.t03_active_service_totals(fx, AS_OF, require_active_tariff=True), "service_id")
    assert set(strict) == set(range(1, 10))


def test_t04(fx):
    r = rows(Q.t04_calls_by_direction(fx, AS_OF))
    assert len(r) == 25
    assert sum(1 for x in r if x["direction"] is None and x["calls"] == 0 and x["seconds"] == 0) == 7
    assert sum(x["calls"] for x in r) == 61 and sum(x["seconds"] for x in r) == 1245
    assert sum(x["calls"] for x in r if x["direction"] == "Send") == 47


def test_t05(fx):
    r = rows(Q.t05_tariff_fee_calls(fx, AS_OF))
    assert len(r) == 35
    assert {x["subscribers_id"] for x in r if x["tariff_id"] is None} == {2, 3}
    calls = Counter()
    for x in r:
        calls[x["tariff_id"]] += x["calls"]
    assert calls == {1000: 31, 1001: 20, 1004: 10, None: 0}
    fee = {x["tariff_id"]: x["monthly_fee"] for x in r}
    assert fee[1000] == Decimal("10.0000") and fee[1004] == Decimal("5.0000")


def test_t06(fx):
    r = {x["kind"]: (x["subscribers"], x["seconds"]) for x in rows(Q.t06_calls_by_kind(fx, AS_OF))}
    assert r == {"Daxili": (10, 575), "Xarici": (12, 350), "Beynəlxalq": (9, 320)}


def test_t07(fx):
    r = rows(Q.t07_inactive_recent_payers(fx, AS_OF))
    assert len(r) == 25
    assert Counter(x["subscribers_id"] for x in r) == {i: 5 for i in range(11, 16)}
    assert {x["status"] for x in r} == {"PASSIVE"}


SERVICES_8 = [7, 0, 0, 6, 1, 6, 2, 5, 3, 2, 6, 7, 8, 5, 3, 2, 3, 2, 5, 2]


@pytest.mark.parametrize("fn", [Q.t08_payments_services_6m, Q.t14_all_payments_services_6m])
def test_t08_t14(fx, fn):
    r = by(fn(fx, AS_OF), "subscribers_id")
    assert len(r) == 20
    assert [int(r[i]["amount"]) for i in range(1, 21)] == [600] * 5 + [500] * 15
    assert [r[i]["services"] for i in range(1, 21)] == SERVICES_8


def test_t09(fx):
    r = rows(Q.t09_top10_complainers(fx, AS_OF))
    assert {x["subscribers_id"]: x["complaints"] for x in r} == {
        1: 4, 2: 4, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3, 9: 3, 8: 2
    }


def test_t10(fx):
    r = by(Q.t10_sms_count_contents_12m(fx, AS_OF), "subscribers_id")
    assert len(r) == 20 and sum(x["sms_count"] for x in r.values()) == 47
    assert r[6]["sms_count"] == 9
    assert all(r[i]["sms_count"] == 3 for i in range(7, 17))
    assert all(r[i]["sms_count"] == 2 for i in range(17, 21))
    assert all(r[i]["sms_count"] == 0 and r[i]["sms_contents"] is None for i in range(1, 6))
    # equal times: ordered by SMS id
    assert r[6]["sms_contents"].startswith("Hello, this is a test SMS.; Hi, this is the second test SMS.; ")
    assert r[6]["sms_contents"].count("; ") == 8


def test_t11(fx):
    r = by(Q.t11_calls_payments(fx, AS_OF), "subscribers_id")
    secs = {1: 140, 4: 105, 5: 55, 6: 75, 8: 50, 9: 150, 11: 105, 12: 75, 13: 170, 14: 145, 15: 35, 17: 35, 19: 105}
    assert {i: r[i]["seconds"] for i in range(1, 21)} == {i: secs.get(i, 0) for i in range(1, 21)}
    # no fan-out: the amounts add up to all payments
    assert sum(x["amount"] for x in r.values()) == Decimal("10500.00")
    assert sum(x["payments"] for x in r.values()) == 105


def test_t12(fx):
    r = by(Q.t12_tariff_average(fx, AS_OF), "tariff_id")
    assert len(r) == 8
    assert round(r[1000]["avg_monthly_payment"], 2) == 516.67 and r[1000]["calls"] == 31
    assert round(r[1001]["avg_monthly_payment"], 2) == 522.22 and r[1001]["calls"] == 20
    assert round(r[1004]["avg_monthly_payment"], 2) == 516.67 and r[1004]["calls"] == 10
    for t in (1002, 1003, 1005, 1006, 1007):
        assert r[t]["avg_monthly_payment"] is None and r[t]["calls"] == 0


def test_t13(fx):
    r = rows(Q.t13_sms_detail_12m(fx, AS_OF))
    assert len(r) == 52
    assert sum(1 for x in r if x["sms_id"] is None) == 5
    assert {x["sms_type"] for x in r if x["sms_id"] == 10} == {"Premium SMS"}


def test_t15(fx):
    r = by(Q.t15_payments_complaints(fx, AS_OF), "subscribers_id")
    assert [r[i]["payments"] for i in range(1, 21)] == [6] * 5 + [5] * 15
    comp = {1: 4, 2: 4, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3, 9: 3, 8: 2}
    assert {i: r[i]["complaints"] for i in range(1, 21)} == {i: comp.get(i, 0) for i in range(1, 21)}


def test_t16(fx):
    r = {(x["age_band"], x["gender"]): x["subscribers"] for x in rows(Q.t16_age_gender(fx, AS_OF))}
    assert r == {("19-30", "Female"): 6, ("31-50", "Female"): 4, ("31-50", "Male"): 10}


def test_t17(fx):
    r = rows(Q.t17_above_tariff_average(fx, AS_OF))
    assert len(r) == 35
    assert {(x["subscribers_id"], x["tariff_id"]) for x in r if x["above_tariff_avg"]} == {
        (1, 1000), (4, 1000), (5, 1000), (1, 1001), (4, 1001), (4, 1004)
    }
    assert {x["subscribers_id"] for x in r if x["above_tariff_avg"] is None} == {2, 3}


def test_t18(fx):
    r = rows(Q.t18_above_age_average(fx, AS_OF))
    means = {x["age_band"]: x["band_avg_seconds"] for x in r}
    assert round(means["19-30"], 2) == 103.33 and round(means["31-50"], 2) == 44.64
    assert {x["subscribers_id"] for x in r if x["above_band_avg"]} == {1, 4, 6, 8, 9, 11, 12, 13, 14, 19}


def test_profiles(fx):
    p = by(s01_subscriber_profile(fx, AS_OF), "subscribers_id")
    assert len(p) == 20
    assert sum(x["calls"] for x in p.values()) == 61 and sum(x["sms"] for x in p.values()) == 47
    assert sum(x["complaints"] for x in p.values()) == 28
    assert [p[i]["services"] for i in range(1, 21)] == SERVICES_8
    s = by(s02_service_performance(fx, AS_OF), "service_id")
    assert len(s) == 11 and sum(x["calls"] for x in s.values()) == 61
    assert int(s[1]["amount"]) == 4700 and s[2]["subscribers"] == 12
    e = s03_call_enrichment(fx)
    assert e.count() == 61 and e.where(F.col("kind").isNull()).count() == 0
