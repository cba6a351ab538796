"""Run many reports for one report time as one batch.

The usage aggregate per (subscriber, service) feeds T3, T5, T12, T17, S1 and S2. A batch computes it once and checkpoints it into the cluster's shared checkpoint folder
(``spark.checkpoint.dir``): the lineage is cut after the largest scan and join, so a lost executor
later in the batch re-reads the checkpoint instead of recomputing calls and SMS. Each report is then
written to its own folder.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from telcolens.functions.timewin import AsOf
from telcolens.plans.profile import PROFILES
from telcolens.plans.questions import QUESTIONS, Tables, _usage_agg, shared_usage_key
from telcolens.session import ensure_checkpoint_dir

REPORTS = {**QUESTIONS, **PROFILES}
# Reports that read the shared aggregate.
USES_SHARED = {
    "t03_active_service_totals",
    "t05_tariff_fee_calls",
    "t12_tariff_average",
    "t17_above_tariff_average",
    "s01_subscriber_profile",
    "s01_subscriber_segments",
    "s02_service_performance",
}


def with_shared_usage(spark: SparkSession, tables: Tables, as_of: AsOf) -> dict[str, DataFrame]:
    """The tables plus the checkpointed usage aggregate (of every fact)."""
    ensure_checkpoint_dir(spark)
    out = dict(tables)
    out[shared_usage_key(as_of)] = _usage_agg(tables, as_of).checkpoint(eager=True)
    return out


def run_reports(
    spark: SparkSession,
    tables: Tables,
    as_of: AsOf,
    out_dir: str,
    names: Iterable[str] | None = None,
    mode: str = "overwrite",
) -> list[str]:
    """Write each report (default: all T and S reports) to ``out_dir/<name>`` as Parquet."""
    names = list(names or REPORTS)
    t = with_shared_usage(spark, tables, as_of) if USES_SHARED & set(names) else tables
    written = []
    for name in names:
        REPORTS[name](t, as_of).write.mode(mode).parquet(f"{out_dir}/{name}")
        written.append(name)
    return written
