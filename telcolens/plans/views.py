"""SQL access: the data-model tables, and each report for one report time, as temporary views, so
that a Spark SQL user can write ``SELECT ... FROM t02_last_payment JOIN subscribers ...``. Views are
lazy; each query over them is planned by Catalyst like the DataFrame it stands for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from telcolens.functions.timewin import AsOf
from telcolens.plans.batch import REPORTS
from telcolens.plans.questions import Tables


def register_views(
    spark: SparkSession,
    tables: Tables,
    as_of: AsOf | None = None,
    reports: Iterable[str] | None = None,
) -> list[str]:
    """Register every table (and, with ``as_of``, every report or the named ones) as a temp view."""
    names = []
    for name in tables:
        if "@" in name:  # internal shared aggregates of a batch run
            continue
        tables[name].createOrReplaceTempView(name)
        names.append(name)
    if as_of is not None:
        for name in reports or REPORTS:
            REPORTS[name](tables, as_of).createOrReplaceTempView(name)
            names.append(name)
    return names
