"""S3: the walk over foreign keys, roles, nested arrays and their parts."""

from __future__ import annotations

from telcolens.operators.star import column_name, nested, star, walk
from telcolens.plans.profile import PROFILES
from conftest import AS_OF


def test_walk_follows_declared_keys():
    assert [(s.role, s.parent, s.key) for s in walk("calls")] == [
        ("caller", "subscribers", "caller_id"),
        ("service", "services", "service_id"),
        ("call_type", "call_type", "call_type_id"),
        ("tariff", "tariff_informations", "service_tariff_id"),
    ]
    assert [s.parent for s in walk("address", follow=("address_type",))] == ["address_type"]
    assert column_name("service", "service_name") == "service_name" and column_name("caller", "name") == "caller_name"


def test_two_keys_to_one_parent_have_roles_of_their_own(monkeypatch):
    from telcolens.sources import schemas

    two = schemas.Table("t", "", (), foreign_keys=(("a_id", "subscribers", "subscribers_id"), ("b_id", "subscribers", "subscribers_id"), ("c_id", "address", "x"), ("type_id", "call_type", "call_type_id")))
    monkeypatch.setitem(schemas.TABLES, "t", two)
    assert [s.role for s in walk("t")] == ["a", "b", "c", "type", "subscribers", "c_type"]


def test_cycles_end(monkeypatch):
    from telcolens.sources import schemas

    own = schemas.Table("own", "", (), foreign_keys=(("up_id", "own", "id"), ("other_id", "other", "id")))
    other = schemas.Table("other", "", (), foreign_keys=(("own_id", "own", "id"),))
    monkeypatch.setitem(schemas.TABLES, "own", own)
    monkeypatch.setitem(schemas.TABLES, "other", other)
    assert [s.role for s in walk("own")] == ["other"]


def test_fixture_rows_are_kept_and_enriched(fx):
    for name in ("address", "technical_data", "complaints_and_support_requests", "calls", "payments", "sms_informations"):
        assert star(fx, name).count() == fx[name].count(), name
    rows = star(fx, "address").collect()
    kinds = {r["type_id"]: r["type_name"] for r in fx["address_type"].collect()}
    names = {r["subscribers_id"]: r["name"] for r in fx["subscribers"].collect()}
    assert rows and all(r["type_name"] == kinds.get(r["type_id"]) and r["subscribers_name"] == names.get(r["subscribers_id"]) for r in rows)


def test_enrichments_of_the_fixture(fx):
    for name, table in {"s03_device_enrichment": "technical_data", "s03_complaint_enrichment": "complaints_and_support_requests"}.items():
        assert PROFILES[name](fx, AS_OF).count() == fx[table].count()
    owned = {}
    for r in fx["address"].collect():
        owned[r["subscribers_id"]] = owned.get(r["subscribers_id"], 0) + 1
    assert all(r["n_addresses"] == owned.get(r["subscribers_id"], 0) for r in PROFILES["s03_device_enrichment"](fx, AS_OF).collect())


def test_a_hot_key_is_nested_in_parts(spark):
    rows = [(1, f"v{i}", i) for i in range(500)] + [(2, "x", 1), (2, "x", 1), (2, None, 0), (None, "y", 1)]
    got = nested(spark.createDataFrame(rows, "k int, v string, n int"), "k", ("v", "n"), "own", part=20).collect()
    hot = [r for r in got if r["k"] == 1]
    assert len(hot) > 15 and max(len(r["own"]) for r in hot) < 60
    assert sorted((x["v"], x["n"]) for r in hot for x in r["own"]) == sorted((v, n) for k, v, n in rows if k == 1)
    assert [[tuple(x) for x in r["own"]] for r in got if r["k"] == 2] == [[(None, 0), ("x", 1), ("x", 1)]] and len(got) == len(hot) + 1
