"""The two-phase ordered roll-up (D8, T10) against brute force: a heavy sender spread over many hour
buckets, equal times broken by id, null contents skipped, the window edges respected."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from conftest import AS_OF, load_fixture
from telcolens.plans import questions as Q

SMS_COLS = ["sms_id", "sender_id", "sms_date", "receiver_phone", "sms_content", "sms_type_id",
            "insert_date", "service_id"]


def test_heavy_sender_order(spark):
    rnd = random.Random(7)
    rows = []
    start = AS_OF - timedelta(days=364)
    for i in range(600):
        sender = 6 if i % 3 else rnd.choice([7, 8, 9])  # subscriber 6 holds two thirds
        t = start + timedelta(minutes=rnd.randrange(0, 364 * 24 * 60, 37))
        content = None if i % 41 == 0 else f"m{i}"
        rows.append([10_000 + rnd.randrange(10**6) * 1000 + i, sender, t, "1", content, 1, AS_OF, 2])
    # equal timestamps: the id decides
    rows.append([5, 6, start + timedelta(hours=5), "1", "tie-a", 1, AS_OF, 2])
    rows.append([4, 6, start + timedelta(hours=5), "1", "tie-b", 1, AS_OF, 2])
    # outside the window on both sides
    rows.append([3, 6, AS_OF - timedelta(days=366), "1", "too-old", 1, AS_OF, 2])
    rows.append([2, 6, AS_OF + timedelta(seconds=1), "1", "too-new", 1, AS_OF, 2])
    t = load_fixture(spark, {"sms_informations": (SMS_COLS, rows)})
    got = {r["subscribers_id"]: r.asDict() for r in Q.t10_sms_count_contents_12m(t, AS_OF).collect()}

    lo = datetime(2023, 2, 1)
    fixture_sms = [x.asDict() for x in t["sms_informations"].collect()]
    for sub in (6, 7, 8, 9):
        mine = [x for x in fixture_sms if x["sender_id"] == sub and lo <= x["sms_date"] <= AS_OF]
        mine.sort(key=lambda x: (x["sms_date"], x["sms_id"]))
        expected = "; ".join(x["sms_content"] for x in mine if x["sms_content"] is not None)
        assert got[sub]["sms_count"] == len(mine)
        assert got[sub]["sms_contents"] == expected
    assert "tie-b; tie-a" in got[6]["sms_contents"]
    assert "too-old" not in got[6]["sms_contents"] and "too-new" not in got[6]["sms_contents"]


def test_hour_parts_rebuild_the_text(spark):
    rnd = random.Random(11)
    start = AS_OF - timedelta(days=30)
    rows = [[100 + i, 6 if i % 2 else 7, start + timedelta(minutes=rnd.randrange(0, 30 * 24 * 60, 13)), "1",
             None if i % 17 == 0 else f"p{i}", 1, AS_OF, 2] for i in range(300)]
    t = load_fixture(spark, {"sms_informations": (SMS_COLS, rows)})
    whole = {r["subscribers_id"]: r for r in Q.t10_sms_count_contents_12m(t, AS_OF).collect()}
    parts = {}
    for r in Q.t10_sms_contents_by_hour_12m(t, AS_OF).collect():
        parts.setdefault(r["subscribers_id"], []).append(r)
    assert set(parts) == set(whole)
    for sub, ps in parts.items():
        ps.sort(key=lambda r: (r["part_start"] is not None, r["part_start"]))
        text = "; ".join(r["sms_contents"] for r in ps if r["sms_contents"] is not None) or None
        assert text == whole[sub]["sms_contents"], sub
        assert sum(r["sms_count"] for r in ps) == whole[sub]["sms_count"]
    assert len(parts[6]) > 50  # the heavy sender is spread over many rows
