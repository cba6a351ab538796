"""The two README themes and the star join: subscriber profile for segmentation (S1), service
performance (S2), and the star enrichments (S3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telcolens.functions.people import age_band, age_years, money_total, zero
from telcolens.functions.timewin import AsOf, up_to
from telcolens.operators.joins import for_each_subscriber
from telcolens.operators.lookup import enrich_receiver_phone
from telcolens.operators.ranking import compare_to_group_mean
from telcolens.operators.star import nested, star, text_of
from telcolens.plans.questions import (
    NAMES,
    Tables,
    _complaint_counts,
    _payment_totals,
    _usage_agg,
)
from telcolens.session import ensure_checkpoint_dir


def _profile(t: Tables, as_of: AsOf, usage: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Every subscriber with the sums of ``usage`` (one row per subscriber), payments and complaints."""
    subs = t["subscribers"].select(*NAMES, "gender", age_band(age_years("birth_date", as_of)).alias("age_band"))
    out = for_each_subscriber(
        subs, usage, _payment_totals(t, as_of), _complaint_counts(t, as_of), extra=("gender", "age_band")
    )
    return out.select(
        *NAMES,
        "gender",
        "age_band",
        zero("calls"),
        zero("seconds"),
        zero("sms"),
        zero("services"),
        zero("payments"),
        zero("amount", "decimal(38,2)"),
        "last_payment_date",
        zero("complaints"),
        *extra,
    )


def _usage_sums() -> list[Column]:
    return [
        F.sum("calls").cast("bigint").alias("calls"),
        F.sum("seconds").cast("bigint").alias("seconds"),
        F.sum("sms").cast("bigint").alias("sms"),
        F.count("service_id").alias("services"),
    ]


def s01_subscriber_profile(t: Tables, as_of: AsOf) -> DataFrame:
    """One row per subscriber with call, SMS, service-use, payment and complaint behaviour, age
    band and gender (the segments of T16)."""
    return _profile(t, as_of, _usage_agg(t, as_of).groupBy("subscribers_id").agg(*_usage_sums()))


def s01_subscriber_segments(t: Tables, as_of: AsOf) -> DataFrame:
    """The profile with the segments that compare: call time above the age band's mean (T18), and
    payments above the mean of any tariff used (T17; null without a tariff).

    Usage is read once: the profile with each subscriber's distinct known tariffs (as many at most as there are
    services) is checkpointed, and both means and the flags come from it. Building this report therefore runs a job."""
    known = t["services"].join(t["tariff_informations"].select("tariff_id"), "tariff_id", "left_semi")
    of_service = known.groupBy("service_id").agg(F.collect_set("tariff_id").alias("of_service"))
    usage = (
        _usage_agg(t, as_of)
        .join(of_service, "service_id", "left")
        .groupBy("subscribers_id")
        .agg(*_usage_sums(), F.array_distinct(F.flatten(F.collect_list("of_service"))).alias("tariffs"))
    )
    ensure_checkpoint_dir(t["subscribers"].sparkSession)
    base = _profile(t, as_of, usage, extra=("tariffs",)).checkpoint()
    used = base.select("subscribers_id", "amount", F.explode("tariffs").alias("tariff_id"))
    tariff = (
        compare_to_group_mean(used, "tariff_id", "amount", "tariff_mean", "above")
        .groupBy("subscribers_id")
        .agg(F.max("above").alias("above_tariff_avg"))
    )
    out = compare_to_group_mean(base, "age_band", "seconds", "band_mean", "above_band_avg", fixed_groups=True)
    return out.drop("tariffs", "band_mean").join(tariff, "subscribers_id", "left")


def s02_service_performance(t: Tables, as_of: AsOf) -> DataFrame:
    """One row per service: tariff, calls, seconds, SMS, distinct users and the users' payment
    total (counted as in T3)."""
    # One pass over the (subscriber, service) aggregate: usage sums and, per distinct user, the
    # user's payment total (counted once per service used, as in T3).
    totals = (
        t["payments"]
        .groupBy("subscribers_id")
        .agg(F.sum("amount").alias("total"))
    )
    per = (
        _usage_agg(t, as_of)
        .where(F.col("service_id").isNotNull())
        .join(totals, "subscribers_id", "left")
        .groupBy("service_id")
        .agg(
            F.sum("calls").cast("bigint").alias("calls"),
            F.sum("seconds").cast("bigint").alias("seconds"),
            F.sum("sms").cast("bigint").alias("sms"),
            F.count("subscribers_id").alias("subscribers"),
            money_total("total").alias("amount"),
        )
    )
    out = t["services"].select("service_id", "service_name", "tariff_id").join(per, "service_id", "left")
    return out.select(
        "service_id",
        "service_name",
        "tariff_id",
        zero("calls"),
        zero("seconds"),
        zero("sms"),
        zero("subscribers"),
        zero("amount", "decimal(38,2)"),
    )


# What the enrichments take of each parent.
TAKEN = {
    "subscribers": ("name", "surname"),
    "services": ("service_name",),
    "tariff_informations": ("tariff_name",),
    "call_type": ("name",),
    "sms_types": ("name",),
    "payment_method_type": ("name",),
    "address_type": ("type_name",),
    "complaint_type": ("complaint_type_name",),
}


def s03_call_enrichment(t: Tables, as_of: AsOf | None = None, until: AsOf | None = None) -> DataFrame:
    """S3: every call with caller names, receiver phone (C4), service, tariff and call-kind names.

    ``as_of`` is taken as every report takes it and cuts nothing, as no window is named; ``until``
    keeps the calls up to a time. The call table stays the streamed side of every join."""
    calls = t["calls"] if until is None else t["calls"].where(up_to("call_date", until))
    calls = enrich_receiver_phone(calls, t["subscribers"])
    return star(t, "calls", columns=TAKEN, rows=calls).selectExpr(
        *calls.columns, "caller_name", "caller_surname", "service_name", "service_tariff_id AS tariff_id", "tariff_name",
        "call_type_name AS kind",
    )


def s03_sms_enrichment(t: Tables, as_of: AsOf | None = None) -> DataFrame:
    """S3: every SMS with sender names, SMS kind, service and tariff names."""
    sms = t["sms_informations"].select("sms_id", "sender_id", "sms_date", "sms_content", "sms_type_id", "service_id")
    return star(t, "sms_informations", columns=TAKEN, rows=sms).selectExpr(
        *sms.columns, "sender_name AS name", "sender_surname AS surname", "sms_type_name AS sms_type", "service_name",
        "service_tariff_id AS tariff_id", "tariff_name",
    )


def s03_payment_enrichment(t: Tables, as_of: AsOf | None = None) -> DataFrame:
    """S3: every payment with the payer's names and the payment method."""
    pay = t["payments"].select("payment_id", "subscribers_id", "amount", "payment_type_id", "payment_date")
    return star(t, "payments", columns=TAKEN, rows=pay).selectExpr(
        *pay.columns, "subscribers_name AS name", "subscribers_surname AS surname", "payment_type_name AS payment_method"
    )


def s03_address_enrichment(t: Tables, as_of: AsOf | None = None) -> DataFrame:
    """S3: every address with its kind and the subscriber's names."""
    own = t["address"].select("subscribers_id", "address_name", "type_id")
    return star(t, "address", columns=TAKEN, rows=own).selectExpr(
        *own.columns, "type_name", "subscribers_name AS name", "subscribers_surname AS surname"
    )


def _addresses(t: Tables) -> DataFrame:
    """The addresses of each subscriber, with their kinds, as an array (in parts for very many)."""
    return nested(
        star(t, "address", follow=("address_type",), columns=TAKEN), "subscribers_id", ("type_name", "address_name"), "addresses"
    )


def s03_device_enrichment(t: Tables, as_of: AsOf | None = None) -> DataFrame:
    """S3: every device with its owner's names and addresses (one text; a subscriber with more than about 1,000 addresses has a row
    for each part of them, ``address_part``)."""
    own = t["technical_data"].select("device_id", "subscribers_id", "device_type", "operating_system", "network_type", "connection_history")
    out = star(t, "technical_data", columns=TAKEN, rows=own).join(_addresses(t), "subscribers_id", "left")
    return out.select(
        *own.columns,
        F.col("subscribers_name").alias("name"),
        F.col("subscribers_surname").alias("surname"),
        F.coalesce("part_no", F.lit(0)).alias("address_part"),
        F.size(F.coalesce("addresses", F.array().cast(out.schema["addresses"].dataType))).alias("n_addresses"),
        text_of("addresses", ("type_name", "address_name")).alias("addresses"),
    )


def s03_complaint_enrichment(t: Tables, as_of: AsOf | None = None) -> DataFrame:
    """S3: every complaint with its kind, the subscriber's names, and the devices that the subscriber owns (one text; in parts as above)."""
    own = t["complaints_and_support_requests"].select("complaint_id", "subscribers_id", "complaint_type_id", "status", "submission_date")
    devices = nested(t["technical_data"], "subscribers_id", ("device_type", "operating_system"), "devices")
    out = star(t, "complaints_and_support_requests", columns=TAKEN, rows=own).join(devices, "subscribers_id", "left")
    return out.select(
        *own.columns,
        "complaint_type_name",
        F.col("subscribers_name").alias("name"),
        F.col("subscribers_surname").alias("surname"),
        F.coalesce("part_no", F.lit(0)).alias("device_part"),
        text_of("devices", ("device_type", "operating_system")).alias("devices"),
    )


PROFILES = {
    "s01_subscriber_profile": s01_subscriber_profile,
    "s01_subscriber_segments": s01_subscriber_segments,
    "s02_service_performance": s02_service_performance,
    "s03_call_enrichment": s03_call_enrichment,
    "s03_sms_enrichment": s03_sms_enrichment,
    "s03_payment_enrichment": s03_payment_enrichment,
    "s03_address_enrichment": s03_address_enrichment,
    "s03_device_enrichment": s03_device_enrichment,
    "s03_complaint_enrichment": s03_complaint_enrichment,
}
