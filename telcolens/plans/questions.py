"""The eighteen report questions (T1-T18), one reading each.

Every function takes the tables (a mapping name -> DataFrame in the data model's shape) and an explicit
``as_of`` report time, and returns a lazy DataFrame. Common rules:

1. the grain is ``subscribers_id``; names are attached after aggregation, never grouped on;
2. "each subscriber" questions start from all subscribers and fill counts and sums with 0;
3. "last n months" is ``[as_of - n months, as_of]``, both ends inclusive (a fact without a time is
   outside every window); a question that names no window reads every fact, and ``as_of`` then
   only anchors ages and service activity;
4. each fact is filtered, aggregated to the join key, and only then joined (no fan-out).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolens.functions.people import (
    age_band,
    age_years,
    money_total,
    not_active,
    service_active,
    zero,
)
from telcolens.functions.timewin import AsOf, as_of_text, restrict
from telcolens.operators.joins import attach_names, for_each_subscriber
from telcolens.operators.ranking import compare_to_group_mean, latest_per_key, top_k
from telcolens.operators.rollup import ordered_concat, ordered_concat_parts, ordered_concat_rows
from telcolens.operators.usage import (
    subscriber_tariff,
    usage_by_subscriber_service,
    usage_union,
)

Tables = Mapping[str, DataFrame]
NAMES = ("subscribers_id", "name", "surname")


def shared_usage_key(as_of: AsOf) -> str:
    """Key under which a batch run places the precomputed usage aggregate (of every fact)."""
    return f"usage_by_subscriber_service@{as_of_text(as_of)}"


def _usage_agg(t: Tables, as_of: AsOf, months: int | None = None) -> DataFrame:
    if months is None and shared_usage_key(as_of) in t:
        return t[shared_usage_key(as_of)]
    return usage_by_subscriber_service(
        usage_union(t["calls"], t["sms_informations"], as_of, months)
    )


def _payment_totals(t: Tables, as_of: AsOf, months: int | None = None) -> DataFrame:
    """Per subscriber: number of payments, amount, last payment time."""
    p = t["payments"]
    p = restrict(p, "payment_date", as_of, months)
    return p.groupBy("subscribers_id").agg(
        F.count(F.lit(1)).alias("payments"),
        money_total("amount").alias("amount"),
        F.max("payment_date").alias("last_payment_date"),
    )


def _calls_totals(t: Tables, as_of: AsOf) -> DataFrame:
    return (
        t["calls"]
        .groupBy(F.col("caller_id").alias("subscribers_id"))
        .agg(F.count(F.lit(1)).alias("calls"), F.sum("call_duration").cast("bigint").alias("seconds"))
    )


def _complaint_counts(t: Tables, as_of: AsOf) -> DataFrame:
    return (
        t["complaints_and_support_requests"]
        .groupBy("subscribers_id")
        .agg(F.count(F.lit(1)).alias("complaints"))
    )


def t01_service_usage_3m(t: Tables, as_of: AsOf, months: int = 3) -> DataFrame:
    """Services each subscriber used in the last 3 months, with the number of uses
    (a use is a call or an SMS on the service)."""
    uses = (
        usage_union(t["calls"], t["sms_informations"], as_of, months)
        .where(F.col("service_id").isNotNull())
        .groupBy("subscribers_id", "service_id")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    svc = t["services"].select("service_id", "service_name")
    out = attach_names(uses.join(svc, "service_id", "left"), t["subscribers"])
    return out.select(*NAMES, "service_id", "service_name", "uses")


def t02_last_payment(t: Tables, as_of: AsOf) -> DataFrame:
    """Each subscriber's last payment (newest date, ties by highest payment id) with method."""
    pay = t["payments"].select(
        "payment_id", "subscribers_id", "payment_date", "amount", "payment_type_id"
    )
    last = latest_per_key(
        pay, "subscribers_id", [F.col("payment_date").desc_nulls_last(), F.col("payment_id").desc()]
    )
    methods = t["payment_method_type"].select("payment_type_id", F.col("name").alias("payment_method"))
    out = (
        t["subscribers"].select(*NAMES)
        .join(last, "subscribers_id", "left")
        .join(methods, "payment_type_id", "left")
    )
    return out.select(
        *NAMES, "payment_id", "payment_date", "amount", "payment_type_id", "payment_method"
    )


def t03_active_service_totals(t: Tables, as_of: AsOf, require_active_tariff: bool = False) -> DataFrame:
    """Per active service, the subscribers who used it and the total they paid.

    A subscriber's total payment counts once for every service the subscriber used, so amounts do not
    add up across services. ``require_active_tariff`` also drops services of a non-active tariff.
    """
    svc = t["services"].where(service_active(as_of)).select("service_id", "service_name", "tariff_id")
    if require_active_tariff:
        active = t["tariff_informations"].where(F.col("status") == "ACTIVE").select("tariff_id")
        svc = svc.join(active, "tariff_id", "left_semi")
    per_service = _service_users_amount(t, as_of)
    out = svc.join(per_service, "service_id", "left")
    return out.select("service_id", "service_name", zero("subscribers"), zero("amount", "decimal(38,2)"))


def _service_users_amount(t: Tables, as_of: AsOf) -> DataFrame:
    """Per service: distinct users and the sum of their payment totals."""
    pairs = (
        _usage_agg(t, as_of)
        .where(F.col("service_id").isNotNull() & F.col("subscribers_id").isNotNull())
        .select("service_id", "subscribers_id")
    )
    totals = (
        t["payments"]
        .groupBy("subscribers_id")
        .agg(F.sum("amount").alias("total"))
    )
    return (
        pairs.join(totals, "subscribers_id", "left")
        .groupBy("service_id")
        .agg(F.count(F.lit(1)).alias("subscribers"), money_total("total").alias("amount"))
    )


def t04_calls_by_direction(t: Tables, as_of: AsOf) -> DataFrame:
    """T4: each subscriber's calls and seconds per call direction; non-callers get 0, 0, null."""
    agg = (
        t["calls"]
        .groupBy(F.col("caller_id").alias("subscribers_id"), F.col("call_type").alias("direction"))
        .agg(F.count(F.lit(1)).alias("calls"), F.sum("call_duration").cast("bigint").alias("seconds"))
    )
    out = for_each_subscriber(t["subscribers"], agg)
    return out.select(*NAMES, "direction", zero("calls"), zero("seconds"))


def t05_tariff_fee_calls(t: Tables, as_of: AsOf) -> DataFrame:
    """T5: per subscriber and tariff used, the tariff's monthly fee and the calls on that tariff.
    Subscribers without a tariff get one row with null tariff and 0 calls."""
    pairs = subscriber_tariff(_usage_agg(t, as_of), t["services"])
    tariffs = (
        t["tariff_informations"].select(
            "tariff_id", "tariff_name", F.col("monthly_subscription").alias("monthly_fee")
        )
    )
    out = for_each_subscriber(t["subscribers"], pairs).join(tariffs, "tariff_id", "left")
    return out.select(*NAMES, "tariff_id", "tariff_name", "monthly_fee", zero("calls"))


def t06_calls_by_kind(t: Tables, as_of: AsOf) -> DataFrame:
    """Per call kind, the number of distinct callers and the total seconds."""
    agg = (
        t["calls"]
        .groupBy("call_type_id")
        .agg(
            F.count_distinct("caller_id").alias("subscribers"),
            F.sum("call_duration").cast("bigint").alias("seconds"),
        )
    )
    kinds = t["call_type"].select("call_type_id", F.col("name").alias("kind"))
    return agg.join(kinds, "call_type_id", "left").select("call_type_id", "kind", "subscribers", "seconds")


def t07_inactive_recent_payers(t: Tables, as_of: AsOf, months: int = 6) -> DataFrame:
    """Subscribers who are not active yet paid in the last 6 months; one row per payment."""
    subs = t["subscribers"].where(not_active("status")).select(*NAMES, "status")
    pay = restrict(t["payments"], "payment_date", as_of, months).select(
        "payment_id", "subscribers_id", "payment_date"
    )
    return pay.join(subs, "subscribers_id").select(*NAMES, "status", "payment_id", "payment_date")


def _payments_services(t: Tables, as_of: AsOf, months: int) -> tuple[DataFrame, DataFrame]:
    pay = (
        restrict(t["payments"], "payment_date", as_of, months)
        .groupBy("subscribers_id")
        .agg(money_total("amount").alias("amount"))
    )
    svc = (
        _usage_agg(t, as_of, months)
        .where(F.col("service_id").isNotNull())
        .groupBy("subscribers_id")
        .agg(F.count(F.lit(1)).alias("services"))
    )
    return pay, svc


def t08_payments_services_6m(t: Tables, as_of: AsOf, months: int = 6) -> DataFrame:
    """Last 6 months, per subscriber with a payment or a service use: amount paid and
    number of distinct services used."""
    pay, svc = _payments_services(t, as_of, months)
    active = pay.join(svc, "subscribers_id", "full").where(F.col("subscribers_id").isNotNull())
    out = attach_names(active, t["subscribers"])
    return out.select(*NAMES, zero("services"), zero("amount", "decimal(38,2)"))


def t09_top10_complainers(t: Tables, as_of: AsOf, k: int = 10) -> DataFrame:
    """The ``k`` subscribers with most complaints (ties by lower id)."""
    counts = _complaint_counts(t, as_of).where(F.col("subscribers_id").isNotNull())
    top = top_k(counts, k, [F.col("complaints").desc(), F.col("subscribers_id").asc()])
    # ``top`` has at most k rows: broadcast it to pick the names without shuffling subscribers.
    names = t["subscribers"].select(*NAMES).join(F.broadcast(top.select("subscribers_id")), "subscribers_id", "left_semi")
    out = top.join(names, "subscribers_id", "left").select(*NAMES, "complaints")
    return out.orderBy(F.col("complaints").desc(), F.col("subscribers_id").asc())  # k rows


def t10_sms_count_contents_12m(t: Tables, as_of: AsOf, months: int = 12) -> DataFrame:
    """Each subscriber's SMS count and contents of the last 12 months, joined by '; ' oldest
    first (ties by SMS id); null contents when there are none."""
    sms = (
        restrict(t["sms_informations"], "sms_date", as_of, months)
        .select(F.col("sender_id").alias("subscribers_id"), "sms_content", "sms_date", "sms_id")
    )
    roll = ordered_concat(
        sms, "subscribers_id", "sms_content", "sms_date", "sms_id", "sms_contents", "sms_count"
    )
    out = for_each_subscriber(t["subscribers"], roll)
    return out.select(*NAMES, zero("sms_count"), "sms_contents")


def t10_sms_contents_by_hour_12m(t: Tables, as_of: AsOf, months: int = 12) -> DataFrame:
    """T10, skew-safe form: the same SMS contents in the same order, one row per subscriber and hour
    with SMS (``part_start``, the hour's count and text); subscribers without SMS appear once with
    null part, 0 and null. Concatenating a subscriber's parts in ``part_start`` order with '; '
    gives the T10 text. No row holds more than one hour of one subscriber, so a sender with a third
    of all SMS is spread over many rows and tasks."""
    sms = (
        restrict(t["sms_informations"], "sms_date", as_of, months)
        .select(F.col("sender_id").alias("subscribers_id"), "sms_content", "sms_date", "sms_id")
    )
    parts = ordered_concat_parts(
        sms, "subscribers_id", "sms_content", "sms_date", "sms_id", "sms_contents", "sms_count"
    )
    out = for_each_subscriber(t["subscribers"], parts)
    return out.select(*NAMES, "part_start", zero("sms_count"), "sms_contents")


def t10_sms_contents_by_rows_12m(t: Tables, as_of: AsOf, months: int = 12, rows: int = 1000) -> DataFrame:
    """T10 in parts of ``rows`` SMS: the same contents in the same order, whatever the hours; subscribers without SMS appear once
    with null part, 0 and null. The parts are the streamed side of the join with the names, so a heavy sender's are split."""
    sms = (
        restrict(t["sms_informations"], "sms_date", as_of, months)
        .select(F.col("sender_id").alias("subscribers_id"), "sms_content", "sms_date", "sms_id")
    )
    parts = ordered_concat_rows(
        sms, "subscribers_id", "sms_content", "sms_date", "sms_id", "sms_contents", "sms_count", rows
    )
    names = t["subscribers"].select(*NAMES)
    sent = parts.join(names, "subscribers_id").select(*NAMES, "part_no", "sms_count", "sms_contents")
    silent = names.join(sms.select("subscribers_id").distinct(), "subscribers_id", "left_anti").selectExpr(
        *NAMES, "CAST(NULL AS BIGINT) AS part_no", "0L AS sms_count", "CAST(NULL AS STRING) AS sms_contents"
    )
    return sent.unionByName(silent)


def t11_calls_payments(t: Tables, as_of: AsOf) -> DataFrame:
    """Each subscriber's calls and seconds, and payments: count, amount, last payment time."""
    out = for_each_subscriber(t["subscribers"], _calls_totals(t, as_of), _payment_totals(t, as_of))
    return out.select(
        *NAMES,
        zero("calls"),
        zero("seconds"),
        zero("payments"),
        zero("amount", "decimal(38,2)"),
        "last_payment_date",
    )


def t12_tariff_average(t: Tables, as_of: AsOf) -> DataFrame:
    """Per tariff, the average monthly payment of its subscribers and the calls on it.

    A subscriber's monthly payment is the sum of payments in a calendar month with payments; the
    average is over all (subscriber, month) of the tariff's subscribers. Tariffs without users get a
    null average and 0 calls.
    """
    monthly = (
        t["payments"]
        .groupBy("subscribers_id", F.date_trunc("month", "payment_date").alias("month"))
        .agg(F.sum("amount").alias("month_total"))
        .groupBy("subscribers_id")
        .agg(F.sum("month_total").alias("total"), F.count(F.lit(1)).alias("months"))
    )
    pairs = subscriber_tariff(_usage_agg(t, as_of), t["services"])
    # One pass over the pairs: calls of every pair, payments of the pairs whose subscriber paid.
    per_tariff = (
        pairs.join(monthly, "subscribers_id", "left")
        .groupBy("tariff_id")
        .agg(
            (F.sum("total").cast("double") / F.sum("months").cast("double")).alias("avg_monthly_payment"),
            F.sum("calls").cast("bigint").alias("calls"),
        )
    )
    out = t["tariff_informations"].select("tariff_id", "tariff_name").join(per_tariff, "tariff_id", "left")
    return out.select("tariff_id", "tariff_name", "avg_monthly_payment", zero("calls"))


def t13_sms_detail_12m(t: Tables, as_of: AsOf, months: int = 12) -> DataFrame:
    """Each subscriber's SMS of the last 12 months with content and kind; subscribers
    without SMS appear once with nulls."""
    sms = restrict(t["sms_informations"], "sms_date", as_of, months).select(
        F.col("sender_id").alias("subscribers_id"), "sms_id", "sms_date", "sms_content", "sms_type_id"
    )
    kinds = t["sms_types"].select("sms_type_id", F.col("name").alias("sms_type"))
    subs = t["subscribers"].select(*NAMES)
    cols = (*NAMES, "sms_id", "sms_date", "sms_content", "sms_type")
    # SMS rows stay on the streamed side, so a heavy sender is split by AQE, never buffered.
    with_sms = sms.join(kinds, "sms_type_id", "left").join(subs, "subscribers_id").select(*cols)
    senders = sms.select("subscribers_id").distinct()
    without = subs.join(senders, "subscribers_id", "left_anti").select(
        *NAMES,
        F.lit(None).cast("bigint").alias("sms_id"),
        F.lit(None).cast("timestamp_ntz").alias("sms_date"),
        F.lit(None).cast("string").alias("sms_content"),
        F.lit(None).cast("string").alias("sms_type"),
    )
    return with_sms.unionByName(without.select(*cols), allowMissingColumns=False)


def t14_all_payments_services_6m(t: Tables, as_of: AsOf, months: int = 6) -> DataFrame:
    """As T8, for every subscriber (zeros for the inactive)."""
    pay, svc = _payments_services(t, as_of, months)
    out = for_each_subscriber(t["subscribers"], pay, svc)
    return out.select(*NAMES, zero("amount", "decimal(38,2)"), zero("services"))


def t15_payments_complaints(t: Tables, as_of: AsOf) -> DataFrame:
    """Each subscriber's number of payments, amount paid and number of complaints."""
    pay = _payment_totals(t, as_of).drop("last_payment_date")
    out = for_each_subscriber(t["subscribers"], pay, _complaint_counts(t, as_of))
    return out.select(*NAMES, zero("payments"), zero("amount", "decimal(38,2)"), zero("complaints"))


def t16_age_gender(t: Tables, as_of: AsOf) -> DataFrame:
    """Subscribers per age band and gender (only combinations that occur)."""
    return (
        t["subscribers"]
        .select(age_band(age_years("birth_date", as_of)).alias("age_band"), "gender")
        .groupBy("age_band", "gender")
        .agg(F.count(F.lit(1)).alias("subscribers"))
    )


def t17_above_tariff_average(t: Tables, as_of: AsOf) -> DataFrame:
    """Per subscriber and tariff used: the subscriber's total paid, the average total of the
    tariff's subscribers, and whether the total is strictly above it (null without a tariff)."""
    pairs = subscriber_tariff(_usage_agg(t, as_of), t["services"]).select("subscribers_id", "tariff_id")
    totals = (
        t["payments"]
        .groupBy("subscribers_id")
        .agg(money_total("amount").alias("total_paid"))
    )
    per = for_each_subscriber(t["subscribers"], pairs, totals).select(
        *NAMES, "tariff_id", zero("total_paid", "decimal(38,2)")
    )
    tariffs = t["tariff_informations"].select("tariff_id")
    out = compare_to_group_mean(
        per,
        "tariff_id",
        "total_paid",
        "tariff_avg_paid",
        "above_tariff_avg",
        known=tariffs,
    )
    return out.select(*NAMES, "tariff_id", "total_paid", "tariff_avg_paid", "above_tariff_avg")


def t18_above_age_average(t: Tables, as_of: AsOf) -> DataFrame:
    """Each subscriber's total call seconds, the average of the subscriber's age band (all
    subscribers, non-callers as 0), and whether the seconds are strictly above it."""
    subs = t["subscribers"].select(*NAMES, age_band(age_years("birth_date", as_of)).alias("age_band"))
    per = for_each_subscriber(subs, _calls_totals(t, as_of), extra=("age_band",)).select(
        *NAMES, "age_band", zero("seconds")
    )
    out = compare_to_group_mean(
        per, "age_band", "seconds", "band_avg_seconds", "above_band_avg", fixed_groups=True
    )
    return out.select(*NAMES, "age_band", "seconds", "band_avg_seconds", "above_band_avg")


QUESTIONS = {
    "t01_service_usage_3m": t01_service_usage_3m,
    "t02_last_payment": t02_last_payment,
    "t03_active_service_totals": t03_active_service_totals,
    "t04_calls_by_direction": t04_calls_by_direction,
    "t05_tariff_fee_calls": t05_tariff_fee_calls,
    "t06_calls_by_kind": t06_calls_by_kind,
    "t07_inactive_recent_payers": t07_inactive_recent_payers,
    "t08_payments_services_6m": t08_payments_services_6m,
    "t09_top10_complainers": t09_top10_complainers,
    "t10_sms_count_contents_12m": t10_sms_count_contents_12m,
    "t10_sms_contents_by_hour_12m": t10_sms_contents_by_hour_12m,
    "t10_sms_contents_by_rows_12m": t10_sms_contents_by_rows_12m,
    "t11_calls_payments": t11_calls_payments,
    "t12_tariff_average": t12_tariff_average,
    "t13_sms_detail_12m": t13_sms_detail_12m,
    "t14_all_payments_services_6m": t14_all_payments_services_6m,
    "t15_payments_complaints": t15_payments_complaints,
    "t16_age_gender": t16_age_gender,
    "t17_above_tariff_average": t17_above_tariff_average,
    "t18_above_age_average": t18_above_age_average,
}
