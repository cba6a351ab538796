"""A4 / A5 of one batch against all history: equal to the full checks on the union, without shuffling history."""

from __future__ import annotations

import pytest
from conftest import load_fixture
from test_plans import explain

from telcolens.operators import key_filters as kf
from telcolens.operators.quality import fk_summary, pk_violations
from telcolens.sources import batches

SCHEMA = "id long, part string, parent long"
KEYS = {"facts": ("id", "part"), "lookup": ("parent",)}
FKS = [("facts", "parent", "lookup", "parent"), ("facts", "id", "facts", "parent")]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def given(spark):
    old = [(i, "a", i % 7) for i in range(300)] + [(5, None, 1), (None, "a", None)] + [(400, "hot", 900)] * 150
    new = [(i, "a", i % 11) for i in range(290, 330)] + [(5, None, 901), (7, "b", None), (None, "a", 3), (400, "hot", 3), (1, "a|", 1)]
    new += [(500, "twice", 900)] * 2
    history = {"facts": spark.createDataFrame(old, SCHEMA), "lookup": spark.createDataFrame([(i,) for i in range(8)], "parent long")}
    batch = {"facts": spark.createDataFrame(new, SCHEMA), "lookup": spark.createDataFrame([(9,), (3,), (None,)], "parent long")}
    return history, batch


def whole(history, batch):
    union = {t: history[t].unionByName(batch[t]) if t in batch else history[t] for t in history}
    held = {t: {tuple(r) for r in batch[t].select(*KEYS[t]).collect()} for t in batch}
    texts = {(t, "|".join("<null>" if v is None else str(v) for v in key)) for t in held for key in held[t]}
    pk = [r for r in rows(pk_violations(union, KEYS)) if (r[0], r[1]) in texts]
    return pk, rows(fk_summary({**union, **{f"new {t}": batch[t] for t in batch}}, [(f"new {c}", x, p, y) for c, x, p, y in FKS if c in batch]))


@pytest.mark.parametrize("limit", [kf.CONFIRM_BYTES, 100])
@pytest.mark.parametrize("capacity", [1, 100_000])
def test_equal_to_the_full_checks(spark, capacity, limit):
    history, batch = given(spark)
    pk, fk = whole(history, batch)
    assert len(pk) > 10 and all(r[3] for r in fk)
    got = kf.batch_pk_violations(batch, history, kf.history_filter(history, kf.spaces(KEYS), capacity), KEYS, limit)
    assert got.columns == ["table_name", "key_value", "n_rows"] and rows(got) == pk
    got = kf.batch_fk_summary(batch, history, kf.history_filter(history, kf.spaces({}, FKS), capacity), FKS, limit)
    assert rows(got) == sorted(((t.removeprefix("new "), *r) for t, *r in fk), key=str)


def test_a_filter_holds_all_its_keys_and_few_others(spark):
    order = {("lookup", ("parent",)): 0}
    history = {"lookup": spark.range(20_000).selectExpr("id * 3 AS parent")}
    filters = kf.history_filter(history, order, 20_000)
    asked = kf.keys_of(spark.range(60_000).selectExpr("id AS parent"), 0, ("parent",))
    found = kf.maybe_known(asked, kf.merged(filters)).count()
    assert 20_000 <= found <= 20_400  # of 40,000 others one in 400 is expected
    # Filters of halves merge into the filter of the whole; filters of two sizes serve beside each other.
    halves = [kf.key_filter(kf.keys_of(history["lookup"].where(f"parent % 2 = {i}"), 0, ("parent",)), kf.blocks_for(20_000)) for i in (0, 1)]
    assert rows(kf.merged(halves[0].unionByName(halves[1]))) == rows(filters)
    other = kf.key_filter(kf.keys_of(history["lookup"].where("parent % 2 = 1"), 0, ("parent",)), kf.blocks_for(200_000))
    both = kf.maybe_known(asked, kf.merged(halves[0].unionByName(other)))
    assert 20_000 <= both.count() <= 20_400 and both.distinct().count() == both.count()


def test_empty_sides(spark):
    history, batch = given(spark)
    for h, b in (({t: d.limit(0) for t, d in history.items()}, batch), (history, {t: d.limit(0) for t, d in batch.items()})):
        pk, fk = whole(h, b)
        assert rows(kf.batch_pk_violations(b, h, kf.history_filter(h, kf.spaces(KEYS)), KEYS)) == pk
        got = rows(kf.batch_fk_summary(b, h, kf.history_filter(h, kf.spaces({}, FKS)), FKS))
        assert got == sorted(((t.removeprefix("new "), *r) for t, *r in fk), key=str)


def test_history_is_not_shuffled_and_not_read_without_hits(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.range(1000).selectExpr("id", "'a' AS part", "id % 5 AS parent").write.parquet(path)
    keys = {"facts": KEYS["facts"]}
    history = {"facts": spark.read.schema(SCHEMA).parquet(path)}
    filters = kf.history_filter(history, kf.spaces(keys)).checkpoint()
    batch = {"facts": spark.createDataFrame([(1, "a", 1), (2000, "a", 1), (2000, "a", 2)], SCHEMA)}
    got = kf.batch_pk_violations(batch, history, filters, keys)
    tree = explain(got).splitlines()
    assert rows(got) == [("facts", "1|a", 2), ("facts", "2000|a", 2)]
    scan = next(i for i, x in enumerate(tree) if "FileScan parquet" in x)
    depth = [len(x) - len(x.lstrip(" :+-")) for x in tree]
    # Between the scan and the semi join with the broadcast hits nothing is exchanged: the hits' count is.
    path_up, at = [], depth[scan]
    for i in range(scan - 1, -1, -1):
        if depth[i] < at:
            path_up.append(tree[i].strip(" :+-"))
            at = depth[i]
    join = next(i for i, x in enumerate(path_up) if x.startswith("BroadcastHashJoin"))
    assert "LeftSemi" in path_up[join] and not any("Exchange" in x for x in path_up[:join])
    none = {"facts": batch["facts"].where("id = 2000")}
    p = explain(kf.batch_pk_violations(none, history, filters, keys))
    assert "FileScan" not in p


def test_batches_of_a_store(spark, tmp_path):
    root, t = str(tmp_path / "lake"), load_fixture(spark)
    keys = {"payments": ("payment_id",), "subscribers": ("subscribers_id",)}
    fks = [("payments", "subscribers_id", "subscribers", "subscribers_id")]
    pk, fk = batches.check_batch(spark, root, {n: t[n] for n in keys}, keys, fks)
    assert rows(pk) == [] and [r[3:] for r in rows(fk)] == [(0, 0)]
    assert batches.append_batch(spark, root, "1", {n: t[n] for n in keys})
    again = {"payments": t["payments"].limit(3)}
    pk, fk = batches.check_batch(spark, root, again, keys, fks)
    assert [r[2] for r in rows(pk)] == [2, 2, 2] and [r[3:] for r in rows(fk)] == [(0, 0)]
    assert batches.append_batch(spark, root, "2", again)
    stray = {"payments": t["payments"].limit(2).selectExpr("*").drop("subscribers_id", "payment_id").selectExpr("*", "-1L AS subscribers_id", "-5L AS payment_id")}
    pk, fk = batches.check_batch(spark, root, stray, keys, fks, capacity=10)
    assert [r[1:] for r in rows(pk)] == [("-5", 2)] and [r[3:] for r in rows(fk)] == [(2, 1)]
    third = rows(batches.check_batch(spark, root, again, keys)[0])
    assert [r[2] for r in third] == [3, 3, 3]
