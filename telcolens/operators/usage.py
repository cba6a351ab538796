"""Service usage: the bag union of calls and SMS (G1), its per (subscriber, service) aggregate,
and the subscriber -> tariff relation derived from it (C6).

A subscriber has no tariff column; usage defines membership: subscriber -> call / SMS ->
service -> tariff. Every usage consumer reads the pre-aggregated form, so at most one row per
(subscriber, service) reaches a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolens.functions.timewin import AsOf, restrict

KIND_CALL = "call"
KIND_SMS = "sms"


def usage_union(calls: DataFrame, sms: DataFrame, as_of: AsOf, months: int | None = None) -> DataFrame:
    """G1: (subscribers_id, service_id, used_at, kind, seconds) for calls and SMS in the window."""
    c = restrict(calls, "call_date", as_of, months).select(
        F.col("caller_id").alias("subscribers_id"),
        "service_id",
        F.col("call_date").alias("used_at"),
        F.lit(KIND_CALL).alias("kind"),
        F.col("call_duration").cast("bigint").alias("seconds"),
    )
    s = restrict(sms, "sms_date", as_of, months).select(
        F.col("sender_id").alias("subscribers_id"),
        "service_id",
        F.col("sms_date").alias("used_at"),
        F.lit(KIND_SMS).alias("kind"),
        F.lit(None).cast("bigint").alias("seconds"),
    )
    return c.unionByName(s)


def usage_by_subscriber_service(usage: DataFrame) -> DataFrame:
    """One row per (subscriber, service): calls, SMS, call seconds. Partial aggregation runs before
    the shuffle, so a heavy user costs one row per map task, not one per event."""
    is_call = F.col("kind") == KIND_CALL
    return usage.groupBy("subscribers_id", "service_id").agg(
        F.count_if(is_call).alias("calls"),
        F.count_if(~is_call).alias("sms"),
        F.sum("seconds").alias("seconds"),
    )


def subscriber_tariff(usage_agg: DataFrame, services: DataFrame) -> DataFrame:
    """Distinct (subscriber, tariff) pairs with the calls made on that tariff.

    Usage on a service without a tariff, or on an unknown service, gives no pair.
    """
    svc = services.select("service_id", "tariff_id").where(F.col("tariff_id").isNotNull())
    return (
        usage_agg.join(svc, "service_id")
        .groupBy("subscribers_id", "tariff_id")
        .agg(F.sum("calls").cast("bigint").alias("calls"))
    )
