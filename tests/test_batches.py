"""Batches are whole or not there. A2: rejected lines beside the good ones. A3: defaults held by the catalog."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import LOAD_TS, load_fixture

from telcolens.functions.timewin import MONTH_COLUMN, restrict
from telcolens.sources import batches
from telcolens.sources.load import from_rows
from telcolens.sources.rejects import read_csv


def counts(spark, root, names=("subscribers", "payments", "calls", "call_type")):
    return {n: batches.read_committed(spark, root, n).count() for n in names}


def test_a_batch_is_whole_or_not_there(spark, tmp_path, monkeypatch):
    root, t = str(tmp_path / "lake"), load_fixture(spark)
    first = {n: t[n] for n in ("subscribers", "payments", "calls")}
    assert counts(spark, root) == {"subscribers": 0, "payments": 0, "calls": 0, "call_type": 0}
    assert batches.append_batch(spark, root, "day-1", first)
    want = {n: first[n].count() for n in first} | {"call_type": 0}
    assert counts(spark, root) == want

    # A failure between two tables, and one after all tables but before the commit.
    broken = t["calls"].selectExpr(*[c if c != "call_id" else "CAST(raise_error('lost') AS BIGINT) AS call_id" for c in t["calls"].columns])
    with pytest.raises(Exception, match="lost"):
        batches.append_batch(spark, root, "day-2", {"payments": t["payments"], "calls": broken})
    batches.stage_batch(root, "day-2", {"payments": t["payments"]})
    assert counts(spark, root) == want
    left = batches.vacuum(spark, root)
    assert len(left) >= 2 and counts(spark, root) == want and batches.vacuum(spark, root) == []

    # The failed batch again, then twice more.
    assert batches.append_batch(spark, root, "day-2", {"payments": t["payments"], "call_type": t["call_type"]})
    twice = want | {"payments": 2 * want["payments"], "call_type": t["call_type"].count()}
    assert counts(spark, root) == twice
    assert not batches.append_batch(spark, root, "day-2", {"payments": t["payments"]})
    assert counts(spark, root) == twice and set(batches.committed(spark, root)) == {"day-1", "day-2"}


def test_of_two_attempts_one_is_committed(spark, tmp_path, monkeypatch):
    root, t = str(tmp_path / "lake"), load_fixture(spark)
    other = dict(batches.stage_batch(root, "b", {"payments": t["payments"]}))
    plain = batches.stage_batch

    def overtaken(*a):
        got = plain(*a)
        assert batches._publish(spark, f"{root}/_commits/b.json", __import__("json").dumps(other))
        return got

    monkeypatch.setattr(batches, "stage_batch", overtaken)
    assert not batches.append_batch(spark, root, "b", {"payments": t["payments"]})
    assert counts(spark, root)["payments"] == t["payments"].count() and batches.committed(spark, root) == {"b": other}
    assert len(batches.vacuum(spark, root)) == 1


def test_committed_facts_prune_by_month(spark, tmp_path):
    root, t = str(tmp_path / "lake"), load_fixture(spark)
    batches.append_batch(spark, root, "a", {"payments": t["payments"]})
    df = batches.read_committed(spark, root, "payments")
    assert df.schema["amount"].dataType == t["payments"].schema["amount"].dataType
    got = restrict(df, "payment_date", "2024-02-01 00:00:00", 2)
    assert got.count() == restrict(t["payments"], "payment_date", "2024-02-01 00:00:00", 2).count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and MONTH_COLUMN in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("bad", ["", "a/b", "../x", ".hidden", "a b"])
def test_batch_ids(spark, tmp_path, bad):
    with pytest.raises(ValueError):
        batches.append_batch(spark, str(tmp_path), bad, {})


def test_rejected_lines_are_kept_with_reasons(spark, tmp_path):
    header = "payment_id,subscribers_id,amount,payment_date,note"
    lines = [
        "1,7,10.50,2024-01-02 03:04:05,ok",
        '2,7,"1,5",2024-01-02 03:04:05,quoted',
        "x3,7,5,2024-01-02 03:04:05,",
        "4,7,5,2024-13-02 03:04:05,no such month",
        "5,abc,many,2024-01-02,three",
        "6,7,5",
        "7,7,5,2024-01-02 03:04:05,a,b",
        "8,,,,",
        "9,1.5,5,2024-1-2 03:04:05,",
        "99999999999999999999,1,5,2024-01-02 03:04:05,",
    ]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([header, *lines[:5], "", "   "]) + "\n")
    (folder / "b.csv").write_text("\n".join([header, *lines[5:]]) + "\n")
    got = read_csv(spark, str(folder), "payments", LOAD_TS)
    good = {r["payment_id"]: r for r in got.good.collect()}
    bad = {r["line"].split(",")[0]: r for r in got.rejected.collect()}
    assert len(good) + len(bad) == len(lines) and set(good) == {1, 8}
    assert good[1]["amount"] == Decimal("10.50") and good[1]["payment_date"] == datetime(2024, 1, 2, 3, 4, 5)
    assert good[8]["subscribers_id"] is None and good[8]["payment_date"] is None  # present, so no default
    errors = {k: [(e["column"], e["reason"].split("(")[0]) for e in r["errors"]] for k, r in bad.items()}
    assert errors["2"] == [("amount", "not a decimal")] and bad["2"]["line"] == lines[1]
    assert errors["5"] == [("subscribers_id", "not a bigint"), ("amount", "not a decimal"), ("payment_date", "not a timestamp_ntz")]
    assert errors["6"] == [(None, "not 5 fields")] and errors["7"] == [(None, "not 5 fields")]
    assert errors["9"][0] == ("subscribers_id", "not a bigint") and errors["99999999999999999999"] == [("payment_id", "not a bigint")]
    assert bad["6"]["file"].endswith("b.csv") and bad["x3"]["file"].endswith("a.csv")


def test_files_without_rows_or_header(spark, tmp_path):
    (tmp_path / "e.csv").write_text("payment_id,amount\n")
    got = read_csv(spark, str(tmp_path / "e.csv"), "payments", LOAD_TS)
    assert got.good.count() == got.rejected.count() == 0 and "subscribers_id" in got.good.columns
    (tmp_path / "n.csv").write_text("1,2.5\n-,3\n")
    got = read_csv(spark, str(tmp_path / "n.csv"), "payments", LOAD_TS, columns=("payment_id", "amount"), null_value="-")
    assert [(r["payment_id"], r["amount"], r["payment_date"]) for r in got.good.orderBy("amount").collect()] == [(1, Decimal("2.50"), LOAD_TS), (None, Decimal("3.00"), LOAD_TS)]
