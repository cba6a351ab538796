"""Independent SQL for every registered query, runnable by DuckDB over the driver's tables.

Each text starts with the adapter mapping as CTEs (``driver_adapter.ORACLE_CTES``) and then states the
question's reading directly in SQL: no shared code with the DataFrame implementation beyond the
mapping constants. Types are pinned so both engines agree: counts and integer sums as BIGINT, money
as DECIMAL(38,2), means as exact sum / count in DOUBLE.
"""

from __future__ import annotations

from telcolens.functions.people import (
    BAND_18_AND_BELOW,
    BAND_19_30,
    BAND_31_50,
    BAND_51_AND_ABOVE,
    BAND_UNKNOWN,
)
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
    ORACLE_CTES,
)

A = f"TIMESTAMP '{AS_OF}'"
A12 = f"TIMESTAMP '{AS_OF_SMS_12M}'"


def _with(*ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {ORACLE_CTES.strip()}{extra}\n"


def _usage(as_of: str, months: int | None) -> str:
    def win(col: str) -> str:
        if months is None:  # no window named: every fact
            return "TRUE"
        return f"{col} >= {as_of} - INTERVAL {months} MONTH AND {col} <= {as_of}"

    return f"""usage AS (
  SELECT caller_id AS subscribers_id, service_id, call_date AS used_at, 'call' AS kind,
         CAST(call_duration AS BIGINT) AS seconds
  FROM calls WHERE {win('call_date')}
  UNION ALL
  SELECT sender_id, service_id, sms_date, 'sms', CAST(NULL AS BIGINT)
  FROM sms_informations WHERE {win('sms_date')}),
usage_agg AS (
  SELECT subscribers_id, service_id,
         COUNT(*) FILTER (WHERE kind = 'call') AS calls,
         COUNT(*) FILTER (WHERE kind <> 'call') AS sms,
         SUM(seconds) AS seconds
  FROM usage GROUP BY subscribers_id, service_id)"""


PAIRS = """pairs AS (
  SELECT u.subscribers_id, v.tariff_id, CAST(SUM(u.calls) AS BIGINT) AS calls
  FROM usage_agg u JOIN services v ON u.service_id = v.service_id
  WHERE v.tariff_id IS NOT NULL
  GROUP BY u.subscribers_id, v.tariff_id)"""


def _age(birth: str, as_of: str) -> str:
    """Whole years as Oracle/Spark ``months_between``: a day-of-month short of the birthday takes
    a month off, unless both days are month ends."""
    months = (
        f"((year({as_of}) - year({birth})) * 12 + month({as_of}) - month({birth}) - "
        f"CASE WHEN day({as_of}) < day({birth}) AND NOT (day({as_of}) = day(last_day({as_of})) "
        f"AND day({birth}) = day(last_day({birth}))) THEN 1 ELSE 0 END)"
    )
    return f"CAST(floor({months} / 12.0) AS INTEGER)"


def _band(birth: str, as_of: str) -> str:
    age = _age(birth, as_of)
    return (
        f"CASE WHEN {birth} IS NULL THEN '{BAND_UNKNOWN}' WHEN {age} <= 18 THEN '{BAND_18_AND_BELOW}' "
        f"WHEN {age} <= 30 THEN '{BAND_19_30}' WHEN {age} <= 50 THEN '{BAND_31_50}' "
        f"ELSE '{BAND_51_AND_ABOVE}' END"
    )


def _last(col: str, months: int, as_of: str = A) -> str:
    return f"{col} >= {as_of} - INTERVAL {months} MONTH AND {col} <= {as_of}"


PAY_TOTALS = """pay AS (
  SELECT subscribers_id, COUNT(*) AS payments, CAST(SUM(amount) AS DECIMAL(38,2)) AS amount,
         MAX(payment_date) AS last_payment_date
  FROM payments GROUP BY subscribers_id)"""

CALL_TOTALS = """ct AS (
  SELECT caller_id AS subscribers_id, COUNT(*) AS calls, CAST(SUM(call_duration) AS BIGINT) AS seconds
  FROM calls GROUP BY caller_id)"""

COMPLAINTS = """cc AS (
  SELECT subscribers_id, COUNT(*) AS complaints
  FROM complaints_and_support_requests GROUP BY subscribers_id)"""

SERVICE_AMOUNT = """svc_pairs AS (
  SELECT DISTINCT service_id, subscribers_id FROM usage_agg
  WHERE service_id IS NOT NULL AND subscribers_id IS NOT NULL),
totals AS (
  SELECT subscribers_id, SUM(amount) AS total FROM payments
  GROUP BY subscribers_id),
per_service AS (
  SELECT p.service_id, COUNT(*) AS subscribers, CAST(SUM(t.total) AS DECIMAL(38,2)) AS amount
  FROM svc_pairs p LEFT JOIN totals t ON p.subscribers_id = t.subscribers_id
  GROUP BY p.service_id)"""


def _z(expr: str, name: str, typ: str = "BIGINT") -> str:
    return f"CAST(COALESCE({expr}, 0) AS {typ}) AS {name}"


M = "DECIMAL(38,2)"

SQL: dict[str, str] = {}

SQL["t01_service_usage_3m"] = _with(_usage(A, 3)) + """
SELECT u.subscribers_id, s.name, s.surname, u.service_id, v.service_name, u.uses
FROM (SELECT subscribers_id, service_id, COUNT(*) AS uses FROM usage
      WHERE service_id IS NOT NULL GROUP BY subscribers_id, service_id) u
LEFT JOIN services v ON v.service_id = u.service_id
LEFT JOIN subscribers s ON s.subscribers_id = u.subscribers_id
"""

SQL["t02_last_payment"] = _with(
    """last_pay AS (
  SELECT * FROM (
    SELECT payment_id, subscribers_id, payment_date, amount, payment_type_id,
           row_number() OVER (PARTITION BY subscribers_id
                              ORDER BY payment_date DESC NULLS LAST, payment_id DESC) AS rn
    FROM payments) WHERE rn = 1)"""
) + """
SELECT s.subscribers_id, s.name, s.surname, l.payment_id, l.payment_date, l.amount,
       l.payment_type_id, m.name AS payment_method
FROM subscribers s
LEFT JOIN last_pay l ON l.subscribers_id = s.subscribers_id
LEFT JOIN payment_method_type m ON m.payment_type_id = l.payment_type_id
"""

SQL["t03_active_service_totals"] = _with(_usage(A, None), SERVICE_AMOUNT) + f"""
SELECT v.service_id, v.service_name, {_z('ps.subscribers', 'subscribers')}, {_z('ps.amount', 'amount', M)}
FROM services v LEFT JOIN per_service ps ON ps.service_id = v.service_id
WHERE v.deactivation_date IS NULL OR v.deactivation_date > {A}
"""

SQL["t03_active_service_totals_active_tariff"] = _with(_usage(A, None), SERVICE_AMOUNT) + f"""
SELECT v.service_id, v.service_name, {_z('ps.subscribers', 'subscribers')}, {_z('ps.amount', 'amount', M)}
FROM services v LEFT JOIN per_service ps ON ps.service_id = v.service_id
WHERE (v.deactivation_date IS NULL OR v.deactivation_date > {A})
  AND v.tariff_id IN (SELECT tariff_id FROM tariff_informations WHERE status = 'ACTIVE')
"""

SQL["t04_calls_by_direction"] = _with(
    """agg AS (
  SELECT caller_id AS subscribers_id, call_type AS direction, COUNT(*) AS calls,
         CAST(SUM(call_duration) AS BIGINT) AS seconds
  FROM calls GROUP BY caller_id, call_type)"""
) + f"""
SELECT s.subscribers_id, s.name, s.surname, a.direction, {_z('a.calls', 'calls')}, {_z('a.seconds', 'seconds')}
FROM subscribers s LEFT JOIN agg a ON a.subscribers_id = s.subscribers_id
"""

SQL["t05_tariff_fee_calls"] = _with(_usage(A, None), PAIRS) + f"""
SELECT s.subscribers_id, s.name, s.surname, p.tariff_id, t.tariff_name,
       t.monthly_subscription AS monthly_fee, {_z('p.calls', 'calls')}
FROM subscribers s
LEFT JOIN pairs p ON p.subscribers_id = s.subscribers_id
LEFT JOIN tariff_informations t ON t.tariff_id = p.tariff_id
"""

SQL["t06_calls_by_kind"] = _with() + """
SELECT a.call_type_id, k.name AS kind, a.subscribers, a.seconds
FROM (SELECT call_type_id, COUNT(DISTINCT caller_id) AS subscribers,
             CAST(SUM(call_duration) AS BIGINT) AS seconds
      FROM calls GROUP BY call_type_id) a
LEFT JOIN call_type k ON k.call_type_id = a.call_type_id
"""

SQL["t07_inactive_recent_payers"] = _with() + f"""
SELECT s.subscribers_id, s.name, s.surname, s.status, p.payment_id, p.payment_date
FROM payments p JOIN subscribers s ON s.subscribers_id = p.subscribers_id
WHERE s.status <> 'ACTIVE' AND {_last('p.payment_date', 6)}
"""

PAY6 = f"""pay6 AS (
  SELECT subscribers_id, CAST(SUM(amount) AS DECIMAL(38,2)) AS amount FROM payments
  WHERE {_last('payment_date', 6)} GROUP BY subscribers_id),
svc6 AS (
  SELECT subscribers_id, COUNT(DISTINCT service_id) AS services FROM usage
  WHERE service_id IS NOT NULL GROUP BY subscribers_id)"""

SQL["t08_payments_services_6m"] = _with(_usage(A, 6), PAY6) + f"""
SELECT a.subscribers_id, s.name, s.surname, {_z('a.services', 'services')}, {_z('a.amount', 'amount', M)}
FROM (SELECT COALESCE(p.subscribers_id, v.subscribers_id) AS subscribers_id, v.services, p.amount
      FROM pay6 p FULL OUTER JOIN svc6 v ON p.subscribers_id = v.subscribers_id) a
LEFT JOIN subscribers s ON s.subscribers_id = a.subscribers_id
WHERE a.subscribers_id IS NOT NULL
"""

SQL["t09_top10_complainers"] = _with(COMPLAINTS) + """
SELECT t.subscribers_id, s.name, s.surname, t.complaints
FROM (SELECT * FROM cc WHERE subscribers_id IS NOT NULL
      ORDER BY complaints DESC, subscribers_id ASC LIMIT 10) t
LEFT JOIN subscribers s ON s.subscribers_id = t.subscribers_id
"""

SQL["t10_sms_count_contents_12m"] = _with(
    f"""agg AS (
  SELECT sender_id AS subscribers_id, COUNT(*) AS sms_count,
         STRING_AGG(sms_content, '; ' ORDER BY sms_date ASC NULLS FIRST, sms_id ASC NULLS FIRST) AS sms_contents
  FROM sms_informations WHERE {_last('sms_date', 12, A12)} GROUP BY sender_id)"""
) + f"""
SELECT s.subscribers_id, s.name, s.surname, {_z('a.sms_count', 'sms_count')}, a.sms_contents
FROM subscribers s LEFT JOIN agg a ON a.subscribers_id = s.subscribers_id
"""

SQL["t10_sms_contents_by_hour_12m"] = _with(
    f"""parts AS (
  SELECT sender_id AS subscribers_id, date_trunc('hour', sms_date) AS part_start, COUNT(*) AS sms_count,
         STRING_AGG(sms_content, '; ' ORDER BY sms_date ASC NULLS FIRST, sms_id ASC NULLS FIRST) AS sms_contents
  FROM sms_informations WHERE {_last('sms_date', 12, A12)} GROUP BY sender_id, date_trunc('hour', sms_date))"""
) + f"""
SELECT s.subscribers_id, s.name, s.surname, p.part_start, {_z('p.sms_count', 'sms_count')}, p.sms_contents
FROM subscribers s LEFT JOIN parts p ON p.subscribers_id = s.subscribers_id
"""

SQL["t10_sms_contents_by_rows_12m"] = _with(
    f"""numbered AS (
  SELECT sender_id AS subscribers_id, sms_content,
         row_number() OVER (PARTITION BY sender_id ORDER BY sms_date ASC NULLS FIRST, sms_id ASC NULLS FIRST) - 1 AS number
  FROM sms_informations WHERE {_last('sms_date', 12, A12)}), parts AS (
  SELECT subscribers_id, number // 3 AS part_no, COUNT(*) AS sms_count, STRING_AGG(sms_content, '; ' ORDER BY number) AS sms_contents
  FROM numbered GROUP BY subscribers_id, number // 3)"""
) + f"""
SELECT s.subscribers_id, s.name, s.surname, p.part_no, {_z('p.sms_count', 'sms_count')}, p.sms_contents
FROM subscribers s LEFT JOIN parts p ON p.subscribers_id = s.subscribers_id
"""

SQL["t11_calls_payments"] = _with(CALL_TOTALS, PAY_TOTALS) + f"""
SELECT s.subscribers_id, s.name, s.surname, {_z('c.calls', 'calls')}, {_z('c.seconds', 'seconds')},
       {_z('p.payments', 'payments')}, {_z('p.amount', 'amount', M)}, p.last_payment_date
FROM subscribers s
LEFT JOIN ct c ON c.subscribers_id = s.subscribers_id
LEFT JOIN pay p ON p.subscribers_id = s.subscribers_id
"""

SQL["t12_tariff_average"] = _with(
    _usage(A, None),
    PAIRS,
    """monthly AS (
  SELECT subscribers_id, SUM(month_total) AS total, COUNT(*) AS months
  FROM (SELECT subscribers_id, date_trunc('month', payment_date) AS m, SUM(amount) AS month_total
        FROM payments GROUP BY subscribers_id, date_trunc('month', payment_date))
  GROUP BY subscribers_id),
paid AS (
  SELECT p.tariff_id, CAST(SUM(m.total) AS DOUBLE) / CAST(SUM(m.months) AS DOUBLE) AS avg_monthly_payment
  FROM pairs p JOIN monthly m ON m.subscribers_id = p.subscribers_id GROUP BY p.tariff_id),
tcalls AS (SELECT tariff_id, CAST(SUM(calls) AS BIGINT) AS calls FROM pairs GROUP BY tariff_id)""",
) + f"""
SELECT t.tariff_id, t.tariff_name, pd.avg_monthly_payment, {_z('c.calls', 'calls')}
FROM tariff_informations t
LEFT JOIN paid pd ON pd.tariff_id = t.tariff_id
LEFT JOIN tcalls c ON c.tariff_id = t.tariff_id
"""

SQL["t13_sms_detail_12m"] = _with(
    f"""sms AS (
  SELECT sender_id AS subscribers_id, sms_id, sms_date, sms_content, sms_type_id
  FROM sms_informations WHERE {_last('sms_date', 12, A12)})"""
) + """
SELECT s.subscribers_id, s.name, s.surname, m.sms_id, m.sms_date, m.sms_content, k.name AS sms_type
FROM subscribers s
LEFT JOIN sms m ON m.subscribers_id = s.subscribers_id
LEFT JOIN sms_types k ON k.sms_type_id = m.sms_type_id
"""

SQL["t14_all_payments_services_6m"] = _with(_usage(A, 6), PAY6) + f"""
SELECT s.subscribers_id, s.name, s.surname, {_z('p.amount', 'amount', M)}, {_z('v.services', 'services')}
FROM subscribers s
LEFT JOIN pay6 p ON p.subscribers_id = s.subscribers_id
LEFT JOIN svc6 v ON v.subscribers_id = s.subscribers_id
"""

SQL["t15_payments_complaints"] = _with(PAY_TOTALS, COMPLAINTS) + f"""
SELECT s.subscribers_id, s.name, s.surname, {_z('p.payments', 'payments')}, {_z('p.amount', 'amount', M)},
       {_z('c.complaints', 'complaints')}
FROM subscribers s
LEFT JOIN pay p ON p.subscribers_id = s.subscribers_id
LEFT JOIN cc c ON c.subscribers_id = s.subscribers_id
"""

SQL["t16_age_gender"] = _with() + f"""
SELECT age_band, gender, COUNT(*) AS subscribers
FROM (SELECT {_band('birth_date', A)} AS age_band, gender FROM subscribers)
GROUP BY age_band, gender
"""

SQL["t17_above_tariff_average"] = _with(
    _usage(A, None),
    PAIRS,
    f"""tot AS (
  SELECT subscribers_id, CAST(SUM(amount) AS DECIMAL(38,2)) AS total_paid FROM payments
  GROUP BY subscribers_id),
per AS (
  SELECT s.subscribers_id, s.name, s.surname, p.tariff_id, {_z('t.total_paid', 'total_paid', M)}
  FROM subscribers s
  LEFT JOIN pairs p ON p.subscribers_id = s.subscribers_id
  LEFT JOIN tot t ON t.subscribers_id = s.subscribers_id),
means AS (
  SELECT tariff_id, CAST(SUM(total_paid) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS tariff_avg_paid,
         CAST(SUM(total_paid) AS DECIMAL(38,2)) AS total, CAST(COUNT(*) AS DECIMAL(14,0)) AS n
  FROM per WHERE tariff_id IN (SELECT tariff_id FROM tariff_informations) GROUP BY tariff_id)""",
) + """
SELECT per.subscribers_id, per.name, per.surname, per.tariff_id, per.total_paid, m.tariff_avg_paid,
       CAST(per.total_paid AS DECIMAL(24,2)) * m.n > m.total AS above_tariff_avg
FROM per LEFT JOIN means m ON m.tariff_id = per.tariff_id
"""

SQL["t18_above_age_average"] = _with(
    CALL_TOTALS,
    f"""per AS (
  SELECT s.subscribers_id, s.name, s.surname, {_band('s.birth_date', A)} AS age_band,
         {_z('c.seconds', 'seconds')}
  FROM subscribers s LEFT JOIN ct c ON c.subscribers_id = s.subscribers_id),
means AS (
  SELECT age_band, CAST(SUM(seconds) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS band_avg_seconds
  FROM per GROUP BY age_band)""",
) + """
SELECT per.subscribers_id, per.name, per.surname, per.age_band, per.seconds, m.band_avg_seconds,
       CAST(per.seconds AS DOUBLE) > m.band_avg_seconds AS above_band_avg
FROM per LEFT JOIN means m ON m.age_band = per.age_band
"""

SQL["s01_subscriber_profile"] = _with(
    _usage(A, None),
    PAY_TOTALS,
    COMPLAINTS,
    """u AS (
  SELECT subscribers_id, CAST(SUM(calls) AS BIGINT) AS calls, CAST(SUM(seconds) AS BIGINT) AS seconds,
         CAST(SUM(sms) AS BIGINT) AS sms, COUNT(service_id) AS services
  FROM usage_agg GROUP BY subscribers_id)""",
) + f"""
SELECT s.subscribers_id, s.name, s.surname, s.gender, {_band('s.birth_date', A)} AS age_band,
       {_z('u.calls', 'calls')}, {_z('u.seconds', 'seconds')}, {_z('u.sms', 'sms')},
       {_z('u.services', 'services')}, {_z('p.payments', 'payments')}, {_z('p.amount', 'amount', M)},
       p.last_payment_date, {_z('c.complaints', 'complaints')}
FROM subscribers s
LEFT JOIN u ON u.subscribers_id = s.subscribers_id
LEFT JOIN pay p ON p.subscribers_id = s.subscribers_id
LEFT JOIN cc c ON c.subscribers_id = s.subscribers_id
"""

SQL["s01_subscriber_segments"] = f"""
SELECT s.*, b.above_band_avg, f.above_tariff_avg FROM ({SQL['s01_subscriber_profile']}) s
LEFT JOIN ({SQL['t18_above_age_average']}) b ON b.subscribers_id = s.subscribers_id
LEFT JOIN (SELECT subscribers_id, bool_or(above_tariff_avg) AS above_tariff_avg
           FROM ({SQL['t17_above_tariff_average']}) GROUP BY subscribers_id) f ON f.subscribers_id = s.subscribers_id
"""

SQL["s02_service_performance"] = _with(
    _usage(A, None),
    SERVICE_AMOUNT,
    """per AS (
  SELECT service_id, CAST(SUM(calls) AS BIGINT) AS calls, CAST(SUM(seconds) AS BIGINT) AS seconds,
         CAST(SUM(sms) AS BIGINT) AS sms, COUNT(subscribers_id) AS subscribers
  FROM usage_agg WHERE service_id IS NOT NULL GROUP BY service_id)""",
) + f"""
SELECT v.service_id, v.service_name, v.tariff_id, {_z('p.calls', 'calls')}, {_z('p.seconds', 'seconds')},
       {_z('p.sms', 'sms')}, {_z('p.subscribers', 'subscribers')}, {_z('ps.amount', 'amount', M)}
FROM services v
LEFT JOIN per p ON p.service_id = v.service_id
LEFT JOIN per_service ps ON ps.service_id = v.service_id
"""

_CALL_COLS = (
    "order_key, line_number, caller_id, call_date, call_duration, "
    "COALESCE(c.receiver_phone, r.phone_number) AS receiver_phone, receiver_subscriber_id, "
    "c.call_type_id, c.service_id, call_type"
)

SQL["s03_call_enrichment"] = _with() + f"""
SELECT {_CALL_COLS}, s.name AS caller_name, s.surname AS caller_surname, v.service_name, v.tariff_id,
       t.tariff_name, k.name AS kind
FROM calls c
LEFT JOIN subscribers r ON r.subscribers_id = c.receiver_subscriber_id
LEFT JOIN subscribers s ON s.subscribers_id = c.caller_id
LEFT JOIN services v ON v.service_id = c.service_id
LEFT JOIN tariff_informations t ON t.tariff_id = v.tariff_id
LEFT JOIN call_type k ON k.call_type_id = c.call_type_id
"""

SQL["s03_sms_enrichment"] = _with() + """
SELECT m.sms_id, m.sender_id, m.sms_date, m.sms_content, m.sms_type_id, m.service_id, s.name, s.surname,
       k.name AS sms_type, v.service_name, v.tariff_id, t.tariff_name
FROM sms_informations m
LEFT JOIN subscribers s ON s.subscribers_id = m.sender_id
LEFT JOIN sms_types k ON k.sms_type_id = m.sms_type_id
LEFT JOIN services v ON v.service_id = m.service_id
LEFT JOIN tariff_informations t ON t.tariff_id = v.tariff_id
"""

SQL["s03_payment_enrichment"] = _with() + """
SELECT p.payment_id, p.subscribers_id, p.amount, p.payment_type_id, p.payment_date, s.name, s.surname,
       k.name AS payment_method
FROM payments p
LEFT JOIN subscribers s ON s.subscribers_id = p.subscribers_id
LEFT JOIN payment_method_type k ON k.payment_type_id = p.payment_type_id
"""

SQL["s03_address_enrichment"] = _with() + """
SELECT a.subscribers_id, a.address_name, a.type_id, k.type_name, s.name, s.surname
FROM address a LEFT JOIN address_type k ON k.type_id = a.type_id LEFT JOIN subscribers s ON s.subscribers_id = a.subscribers_id
"""

SQL["s03_device_enrichment"] = _with() + """
, lists AS (
  SELECT a.subscribers_id, CAST(count(*) AS INTEGER) AS n,
         string_agg(coalesce(k.type_name, '') || ': ' || coalesce(a.address_name, ''), '; ' ORDER BY k.type_name NULLS FIRST, a.address_name NULLS FIRST) AS addresses
  FROM address a LEFT JOIN address_type k ON k.type_id = a.type_id GROUP BY a.subscribers_id)
SELECT d.device_id, d.subscribers_id, d.device_type, d.operating_system, d.network_type, d.connection_history,
       s.name, s.surname, 0 AS address_part, coalesce(l.n, 0) AS n_addresses, l.addresses
FROM technical_data d LEFT JOIN subscribers s ON s.subscribers_id = d.subscribers_id LEFT JOIN lists l ON l.subscribers_id = d.subscribers_id
"""

SQL["s03_complaint_enrichment"] = _with() + """
, lists AS (
  SELECT subscribers_id, string_agg(device_type || ': ' || operating_system, '; ' ORDER BY device_type, operating_system) AS devices
  FROM technical_data GROUP BY subscribers_id)
SELECT c.complaint_id, c.subscribers_id, c.complaint_type_id, c.status, c.submission_date, k.complaint_type_name,
       s.name, s.surname, 0 AS device_part, l.devices
FROM complaints_and_support_requests c LEFT JOIN complaint_type k ON k.complaint_type_id = c.complaint_type_id
LEFT JOIN subscribers s ON s.subscribers_id = c.subscribers_id LEFT JOIN lists l ON l.subscribers_id = c.subscribers_id
"""

SQL["enrich_receiver_phone"] = _with() + f"""
SELECT {_CALL_COLS}
FROM calls c LEFT JOIN subscribers r ON r.subscribers_id = c.receiver_subscriber_id
"""

SQL["usage_union"] = _with(_usage(A, None)) + """
SELECT subscribers_id, service_id, used_at, kind, seconds FROM usage
"""

SQL["subscriber_tariff"] = _with(_usage(A, None), PAIRS) + """
SELECT subscribers_id, tariff_id, calls FROM pairs
"""


def _pk_sql() -> str:
    parts = []
    for table, cols in DRIVER_KEYS.items():
        key = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '<null>')" for c in cols)
        nulls = " OR ".join(f"{c} IS NULL" for c in cols)
        parts.append(
            f"SELECT '{table}' AS table_name, concat_ws('|', {key}) AS key_value, COUNT(*) AS n_rows "
            f"FROM {table} GROUP BY {', '.join(cols)} HAVING COUNT(*) > 1 OR {nulls}"
        )
    return _with() + "\nUNION ALL\n".join(parts)


def _fk_sql() -> str:
    parts = []
    for child, col, parent, pcol in DRIVER_FKS:
        parts.append(
            f"SELECT '{child}' AS table_name, '{col}' AS column_name, '{parent}' AS parent_table, "
            f"CAST(COALESCE(SUM(n), 0) AS BIGINT) AS orphan_rows, COUNT(*) AS orphan_keys "
            f"FROM (SELECT {col} AS k, COUNT(*) AS n FROM {child} WHERE {col} IS NOT NULL GROUP BY {col}) c "
            f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.k)"
        )
    return _with() + "\nUNION ALL\n".join(parts)


def domain_sql(checks: list[tuple[str, str, str, int]]) -> str:
    parts = []
    for table, col, rule, limit in checks:
        if rule == "max_length":
            bad = f"length({col}) > {limit}"
        elif rule == "max_bytes":
            bad = f"strlen({col}) > {limit}"
        else:
            bad = f"abs({col}) >= {10**limit}"
        parts.append(
            f"SELECT '{table}' AS table_name, '{col}' AS column_name, '{rule}' AS rule, "
            f"CAST({limit} AS BIGINT) AS limit_value, COUNT(*) FILTER (WHERE {bad}) AS violations FROM {table}"
        )
    return _with() + "\nUNION ALL\n".join(parts)


DATES = "dates AS (SELECT as_of FROM (VALUES " + ", ".join(f"(TIMESTAMP '{d}')" for d in AS_OF_SERIES) + ") v(as_of))"


def _at(table: str, time: str, months: int) -> str:
    return f"dates d JOIN {table} f ON f.{time} >= d.as_of - INTERVAL {months} MONTH AND f.{time} <= d.as_of"


SQL["t01_service_usage_at_dates"] = _with(_usage(A, None), DATES) + f"""
SELECT u.as_of, u.subscribers_id, s.name, s.surname, u.service_id, v.service_name, u.uses
FROM (SELECT d.as_of, f.subscribers_id, f.service_id, COUNT(*) AS uses FROM {_at('usage', 'used_at', 3)}
      WHERE f.service_id IS NOT NULL GROUP BY ALL) u
LEFT JOIN services v ON v.service_id = u.service_id
LEFT JOIN subscribers s ON s.subscribers_id = u.subscribers_id
"""

SQL["t06_calls_by_kind_at_dates"] = _with(DATES) + f"""
SELECT c.as_of, c.call_type_id, k.name AS kind, c.subscribers, c.seconds
FROM (SELECT d.as_of, f.call_type_id, COUNT(DISTINCT f.caller_id) AS subscribers, CAST(SUM(f.call_duration) AS BIGINT) AS seconds
      FROM {_at('calls', 'call_date', 12)} GROUP BY ALL) c
LEFT JOIN call_type k ON k.call_type_id = c.call_type_id
"""

SQL["t07_inactive_recent_payers_at_dates"] = _with(DATES) + f"""
SELECT d.as_of, s.subscribers_id, s.name, s.surname, s.status, f.payment_id, f.payment_date
FROM {_at('payments', 'payment_date', 6)} JOIN subscribers s ON s.subscribers_id = f.subscribers_id
WHERE s.status <> 'ACTIVE'
"""

AT_DATES6 = f"""pay6 AS (
  SELECT d.as_of, f.subscribers_id, CAST(SUM(f.amount) AS DECIMAL(38,2)) AS amount
  FROM {_at('payments', 'payment_date', 6)} GROUP BY ALL),
svc6 AS (
  SELECT d.as_of, f.subscribers_id, COUNT(DISTINCT f.service_id) AS services
  FROM {_at('usage', 'used_at', 6)} WHERE f.service_id IS NOT NULL GROUP BY ALL)"""

SQL["t08_payments_services_at_dates"] = _with(_usage(A, None), DATES, AT_DATES6) + f"""
SELECT a.as_of, a.subscribers_id, s.name, s.surname, {_z('a.services', 'services')}, {_z('a.amount', 'amount', M)}
FROM (SELECT COALESCE(p.as_of, v.as_of) AS as_of, COALESCE(p.subscribers_id, v.subscribers_id) AS subscribers_id, v.services, p.amount
      FROM pay6 p FULL OUTER JOIN svc6 v ON p.subscribers_id = v.subscribers_id AND p.as_of = v.as_of) a
LEFT JOIN subscribers s ON s.subscribers_id = a.subscribers_id
WHERE a.subscribers_id IS NOT NULL
"""

SQL["t14_all_payments_services_at_dates"] = _with(_usage(A, None), DATES, AT_DATES6) + f"""
SELECT d.as_of, s.subscribers_id, s.name, s.surname, {_z('v.services', 'services')}, {_z('p.amount', 'amount', M)}
FROM subscribers s CROSS JOIN dates d
LEFT JOIN pay6 p ON p.subscribers_id = s.subscribers_id AND p.as_of = d.as_of
LEFT JOIN svc6 v ON v.subscribers_id = s.subscribers_id AND v.as_of = d.as_of
"""


def _batch_rows(table: str, cols: str) -> str:
    """History and batch one after the other: a row that both hold counts twice."""
    time = BATCH_TIMES[table]
    return (
        f"(SELECT {cols}, FALSE AS new FROM {table} WHERE {time} < {A} "
        f"UNION ALL SELECT {cols}, TRUE FROM {table} WHERE {time} >= TIMESTAMP '{BATCH_FROM}')"
    )


def _batch_pk_sql() -> str:
    parts = []
    for table, cols in BATCH_KEYS.items():
        key = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '<null>')" for c in cols)
        nulls = " OR ".join(f"{c} IS NULL" for c in cols)
        parts.append(
            f"SELECT '{table}' AS table_name, concat_ws('|', {key}) AS key_value, COUNT(*) AS n_rows "
            f"FROM {_batch_rows(table, ', '.join(cols))} GROUP BY {', '.join(cols)} HAVING bool_or(new) AND (COUNT(*) > 1 OR {nulls})"
        )
    return _with() + "\nUNION ALL\n".join(parts)


def _batch_fk_sql() -> str:
    parts = []
    for child, col, parent, pcol in BATCH_FKS:
        known = _batch_rows(parent, pcol) if parent in BATCH_TIMES else parent
        parts.append(
            f"SELECT '{child}' AS table_name, '{col}' AS column_name, '{parent}' AS parent_table, "
            f"CAST(COALESCE(SUM(n), 0) AS BIGINT) AS orphan_rows, COUNT(*) AS orphan_keys "
            f"FROM (SELECT {col} AS k, COUNT(*) AS n FROM {_batch_rows(child, col)} WHERE new AND {col} IS NOT NULL GROUP BY {col}) c "
            f"WHERE NOT EXISTS (SELECT 1 FROM {known} p WHERE p.{pcol} = c.k)"
        )
    return _with() + "\nUNION ALL\n".join(parts)


SQL["dq_batch_pk"] = _batch_pk_sql()
SQL["dq_batch_fk"] = _batch_fk_sql()
SQL["dq_pk"] = _pk_sql()
SQL["dq_fk"] = _fk_sql()
