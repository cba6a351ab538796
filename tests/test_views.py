"""Tables and reports as SQL views give the same rows as the DataFrame functions."""

from __future__ import annotations

from conftest import AS_OF
from telcolens.plans import questions as Q
from telcolens.plans.views import register_views
from tools.compare_oracle import canon


def test_sql_over_views(spark, fx):
    names = register_views(spark, fx, AS_OF, ["t09_top10_complainers", "t11_calls_payments"])
    try:
        _check(spark, fx, names)
    finally:
        for n in names:
            spark.catalog.dropTempView(n)


def _check(spark, fx, names):
    assert "subscribers" in names and "t11_calls_payments" in names
    top = spark.sql("SELECT subscribers_id, complaints FROM t09_top10_complainers ORDER BY complaints DESC, subscribers_id")
    assert [tuple(r) for r in top.collect()][:3] == [(1, 4), (2, 4), (3, 3)]
    joined = spark.sql(
        "SELECT t.subscribers_id, t.seconds, s.gender FROM t11_calls_payments t "
        "JOIN subscribers s ON s.subscribers_id = t.subscribers_id WHERE t.seconds > 100"
    )
    df = Q.t11_calls_payments(fx, AS_OF).where("seconds > 100").select("subscribers_id", "seconds")
    assert sorted(r[0] for r in joined.collect()) == sorted(r[0] for r in df.collect())
    again = spark.sql("SELECT * FROM t11_calls_payments")
    ref = Q.t11_calls_payments(fx, AS_OF)
    assert canon(again.columns, [tuple(r) for r in again.collect()]) == canon(ref.columns, [tuple(r) for r in ref.collect()])
