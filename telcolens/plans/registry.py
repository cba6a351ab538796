"""Registered queries over the driver's tables: ``(spark, sf_dir) -> DataFrame`` and the matching SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telcolens.functions.timewin import ts_lit
from telcolens.operators import key_filters
from telcolens.operators.lookup import enrich_receiver_phone
from telcolens.operators.quality import domain_violations, fk_summary, pk_violations
from telcolens.operators.usage import subscriber_tariff, usage_union
from telcolens.plans import oracle, series
from telcolens.plans.profile import PROFILES
from telcolens.plans.questions import QUESTIONS, _usage_agg
from telcolens.session import ensure_checkpoint_dir
from telcolens.sources.driver_adapter import (
    AS_OF,
    AS_OF_SERIES,
    AS_OF_SMS_12M,
    BATCH_FKS,
    BATCH_FROM,
    BATCH_KEYS,
    BATCH_TIMES,
    DRIVER_FKS,
    DRIVER_KEYS,
    driver_domain_checks,
    driver_tables,
)

Query = Callable[[SparkSession, str], DataFrame]

# The two 12-month SMS questions use a later report time so that the window edge cuts the data.
_AS_OF_FOR = {
    "t10_sms_count_contents_12m": AS_OF_SMS_12M,
    "t10_sms_contents_by_hour_12m": AS_OF_SMS_12M,
    "t10_sms_contents_by_rows_12m": AS_OF_SMS_12M,
    "t13_sms_detail_12m": AS_OF_SMS_12M,
}


SMS_ROWS = 3


def _report(fn, as_of: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(driver_tables(spark, sf_dir), as_of)

    run.__name__ = fn.__name__
    return run


def _tables_query(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(driver_tables(spark, sf_dir))

    run.__name__ = fn.__name__
    return run


def _t03_active_tariff(t, as_of):
    """T3 with its option: services of a non-active tariff are dropped too."""
    return QUESTIONS["t03_active_service_totals"](t, as_of, require_active_tariff=True)


def _t10_by_rows(t, as_of):
    """T10 in parts of few rows, so that senders of the given tables have several."""
    return QUESTIONS["t10_sms_contents_by_rows_12m"](t, as_of, rows=SMS_ROWS)


def _usage_union(t):
    return usage_union(t["calls"], t["sms_informations"], AS_OF)


def _subscriber_tariff(t):
    return subscriber_tariff(_usage_agg(t, AS_OF), t["services"])


def _enrich(t):
    return enrich_receiver_phone(t["calls"], t["subscribers"])


def _s03(t):
    return PROFILES["s03_call_enrichment"](t)


def _dq_pk(t):
    return pk_violations(t, DRIVER_KEYS)


def _dq_fk(t):
    return fk_summary(t, DRIVER_FKS)


def _series(fn, *stores: str) -> Query:
    """A report at twelve dates, from tiles written once into the shared folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = driver_tables(spark, sf_dir)
        root = f"{ensure_checkpoint_dir(spark)}/tiles-{uuid.uuid4().hex}"
        series.append_stores(t, root, stores)
        return fn(t, root, AS_OF_SERIES) if stores else fn(t, AS_OF_SERIES)

    run.__name__ = fn.__name__
    return run


def _last_batch(t):
    """A delivery that sends its first month again: history is all facts before AS_OF and all lookups, the batch all facts
    from BATCH_FROM on."""
    batch = {n: t[n].where(F.col(c) >= ts_lit(BATCH_FROM)) for n, c in BATCH_TIMES.items()}
    history = {n: t[n].where(F.col(BATCH_TIMES[n]) < ts_lit(AS_OF)) if n in BATCH_TIMES else t[n] for n in t}
    return batch, history


def _dq_batch_pk(t):
    batch, history = _last_batch(t)
    filters = key_filters.history_filter(history, key_filters.spaces(BATCH_KEYS))
    return key_filters.batch_pk_violations(batch, history, filters, BATCH_KEYS)


def _dq_batch_fk(t):
    batch, history = _last_batch(t)
    filters = key_filters.history_filter(history, key_filters.spaces({}, BATCH_FKS))
    return key_filters.batch_fk_summary(batch, history, filters, BATCH_FKS)


def _dq_domain(t):
    return domain_violations(t, driver_domain_checks())


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name, fn in QUESTIONS.items():
        out[name] = _report(fn, _AS_OF_FOR.get(name, AS_OF))
    out["t10_sms_contents_by_rows_12m"] = _report(_t10_by_rows, AS_OF_SMS_12M)
    out["t03_active_service_totals_active_tariff"] = _report(_t03_active_tariff, AS_OF)
    out["s01_subscriber_profile"] = _report(PROFILES["s01_subscriber_profile"], AS_OF)
    out["s01_subscriber_segments"] = _report(PROFILES["s01_subscriber_segments"], AS_OF)
    out["s02_service_performance"] = _report(PROFILES["s02_service_performance"], AS_OF)
    out["s03_call_enrichment"] = _tables_query(_s03)
    out["s03_sms_enrichment"] = _report(PROFILES["s03_sms_enrichment"], AS_OF)
    out["s03_payment_enrichment"] = _report(PROFILES["s03_payment_enrichment"], AS_OF)
    for name in ("s03_address_enrichment", "s03_device_enrichment", "s03_complaint_enrichment"):
        out[name] = _report(PROFILES[name], AS_OF)
    out["t01_service_usage_at_dates"] = _series(series.t01_at_dates, "uses")
    out["t06_calls_by_kind_at_dates"] = _series(series.t06_at_dates, "callers")
    out["t07_inactive_recent_payers_at_dates"] = _series(series.t07_at_dates)
    out["t08_payments_services_at_dates"] = _series(series.t08_at_dates, "payments", "uses")
    out["t14_all_payments_services_at_dates"] = _series(series.t14_at_dates, "payments", "uses")
    out["usage_union"] = _tables_query(_usage_union)
    out["subscriber_tariff"] = _tables_query(_subscriber_tariff)
    out["enrich_receiver_phone"] = _tables_query(_enrich)
    out["dq_pk"] = _tables_query(_dq_pk)
    out["dq_fk"] = _tables_query(_dq_fk)
    out["dq_batch_pk"] = _tables_query(_dq_batch_pk)
    out["dq_batch_fk"] = _tables_query(_dq_batch_fk)
    out["dq_domain"] = _tables_query(_dq_domain)
    return out


def oracle_sql() -> dict[str, str]:
    sql = dict(oracle.SQL)
    sql["dq_domain"] = oracle.domain_sql(driver_domain_checks())
    return sql
