"""A batch run with the checkpointed usage aggregate writes the same results as single reports."""

from __future__ import annotations

import tempfile

from conftest import AS_OF
from telcolens.plans.batch import REPORTS, run_reports
from tools.compare_oracle import canon


def test_batch_equals_single_reports(spark, fx):
    out = tempfile.mkdtemp(prefix="telcolens-batch-")
    names = ["t03_active_service_totals", "t05_tariff_fee_calls", "t12_tariff_average",
             "t17_above_tariff_average", "s01_subscriber_profile", "s02_service_performance"]
    run_reports(spark, fx, AS_OF, out, names)
    for n in names:
        single = REPORTS[n](fx, AS_OF)
        back = spark.read.parquet(f"{out}/{n}")
        assert sorted(back.columns) == sorted(single.columns)
        assert canon(back.columns, [tuple(r) for r in back.collect()]) == canon(
            single.columns, [tuple(r) for r in single.collect()]
        ), n
