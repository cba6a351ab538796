"""Co-located layout: subscriber-keyed tables bucketed by subscriber id give the same results with
no shuffle at all in the per-subscriber reports."""

from __future__ import annotations

import contextlib
import io
import tempfile

import pytest

from conftest import AS_OF
from telcolens.plans import questions as Q
from telcolens.plans.profile import s01_subscriber_profile
from telcolens.sources.load import SUBSCRIBER_KEY, save_bucketed
from tools.compare_oracle import canon


def exchanges(df) -> int:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def bucketed(spark, fx):
    base = tempfile.mkdtemp(prefix="telcolens-bucketed-")
    t = dict(fx)
    for name in SUBSCRIBER_KEY:
        t[name] = spark.table(save_bucketed(fx[name], name, f"{base}/{name}", 8, name=f"b_{name}"))
    return t


@pytest.mark.parametrize(
    "fn", [Q.t04_calls_by_direction, Q.t11_calls_payments, Q.t15_payments_complaints, s01_subscriber_profile]
)
def test_no_shuffle_same_result(spark, fx, bucketed, fn):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at scale: nothing fits
    try:
        plain, co = fn(fx, AS_OF), fn(bucketed, AS_OF)
        assert exchanges(co) == 0 < exchanges(plain)
        assert canon(co.columns, [tuple(r) for r in co.collect()]) == canon(
            plain.columns, [tuple(r) for r in plain.collect()]
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
