"""Presents the driver's TPC-H-like tables in the operator data model.

Each adapted table is a lazy projection of the given Parquet files; nothing is materialised. Ids keep
the driver's types (e.g. a tariff id is the part type text), which the reports do not depend on.

| ours                 | from                          |
|----------------------|-------------------------------|
| subscribers          | customer                      |
| payments, methods    | orders (priority = method)    |
| services, tariffs    | part (type = tariff)          |
| calls, call kinds    | lineitem join orders          |
| SMS, SMS kinds       | events, type <> 'error'       |
| complaints           | events, type = 'error'        |
| complaint kinds      | events, type = 'error' (id mod COMPLAINT_KINDS) |
| addresses            | customer, 1 to 3 each, and nation |
| address kinds        | region                        |
| devices              | customer, 1 or 2 each         |
"""

from __future__ import annotations

import weakref
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telcolens.session import small_tasks

# Fixed values of the mapping.
AS_OF = "2001-08-02 00:00:00"  # report time for every question
AS_OF_SMS_12M = "2002-07-15 00:00:00"  # report time for the two 12-month SMS questions
AS_OF_SERIES = tuple(f"{2001 - (k > 7)}-{(7 - k) % 12 + 1:02d}-02 00:00:00" for k in range(12))  # the day of AS_OF in twelve months
SMS_SHIFT_MONTHS = 270  # events are moved back onto the orders' clock
SMS_SERVICES = 200  # SMS service id = event_id mod this
BIRTH_ORIGIN = "1940-01-01"
BIRTH_STEP = 7919
BIRTH_SPAN_DAYS = 20000
RECEIVER_STEP = 31
RECEIVER_OFFSET = 7
RECEIVER_SPAN = 2000
SERVICE_ACTIVE_MAX_SIZE = 25
COMPLAINT_KINDS = 6  # a complaint's kind = event_id mod this; kind 0 is not in the list of kinds
ADDRESSES = 3  # a subscriber has 1 to this many addresses
ADDRESS_KINDS = 6  # one more than there are regions, so some addresses are of no known kind
SERVICE_DEACTIVATED_AT = "1998-01-01 00:00:00"

# Primary keys as they exist in the adapted tables (calls have a two-column key).
DRIVER_KEYS: dict[str, tuple[str, ...]] = {
    "subscribers": ("subscribers_id",),
    "payments": ("payment_id",),
    "services": ("service_id",),
    "calls": ("order_key", "line_number"),
    "sms_informations": ("sms_id",),
    "complaints_and_support_requests": ("complaint_id",),
}

# Foreign keys of the data model that exist in the adapted tables.
DRIVER_FKS: tuple[tuple[str, str, str, str], ...] = (
    ("payments", "subscribers_id", "subscribers", "subscribers_id"),
    ("payments", "payment_type_id", "payment_method_type", "payment_type_id"),
    ("services", "tariff_id", "tariff_informations", "tariff_id"),
    ("calls", "caller_id", "subscribers", "subscribers_id"),
    ("calls", "service_id", "services", "service_id"),
    ("calls", "call_type_id", "call_type", "call_type_id"),
    ("sms_informations", "sender_id", "subscribers", "subscribers_id"),
    ("sms_informations", "sms_type_id", "sms_types", "sms_type_id"),
    ("sms_informations", "service_id", "services", "service_id"),
    ("complaints_and_support_requests", "subscribers_id", "subscribers", "subscribers_id"),
    # Not a key of the model: subscribers who never sent an SMS, so that the check has something to find.
    ("subscribers", "subscribers_id", "sms_informations", "sender_id"),
)
# A batch of facts that overlaps history by a month, for the checks of one batch against all history.
BATCH_FROM = "2001-07-02 00:00:00"
BATCH_TIMES: dict[str, str] = {"payments": "payment_date", "calls": "call_date", "sms_informations": "sms_date"}
BATCH_KEYS: dict[str, tuple[str, ...]] = {name: DRIVER_KEYS[name] for name in BATCH_TIMES}
BATCH_FKS: tuple[tuple[str, str, str, str], ...] = (
    *(fk for fk in DRIVER_FKS if fk[0] in BATCH_TIMES),
    # Not keys of the model: senders who never called or paid, by facts of history and batch together.
    ("sms_informations", "sender_id", "calls", "caller_id"),
    ("sms_informations", "sender_id", "payments", "subscribers_id"),
)
# Tariffs that are not on offer any more, as some of the sample rows are.
TARIFF_STATUS = "CASE WHEN tariff_id < 'L' THEN 'PASSIVE' ELSE 'ACTIVE' END"


# Declared schemas of the driver files that the mapping reads (never inferred: no footer jobs).
RAW_SCHEMAS: dict[str, str] = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


class DriverTables(Mapping[str, DataFrame]):
    """The adapted tables, each built on first use and then reused, so one query that reads a
    table twice gets the same plan subtree (and Spark can reuse its exchanges)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self._spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self._dir}/{name}.parquet")
        return self._raw[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _BUILDERS[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(_BUILDERS)

    def __len__(self) -> int:
        return len(_BUILDERS)


_DEFINED: "weakref.WeakKeyDictionary[SparkSession, dict[str, DriverTables]]" = weakref.WeakKeyDictionary()


def driver_tables(spark: SparkSession, sf_dir: str) -> DriverTables:
    """The adapted tables of ``sf_dir``, defined once per session (like registering views): later
    queries reuse the same lazy definitions. Only plans are kept, never data; a new session gets
    its own definitions. Sets the session's ``small_tasks``."""
    small_tasks(spark)
    per_session = _DEFINED.setdefault(spark, {})
    if sf_dir not in per_session:
        per_session[sf_dir] = DriverTables(spark, sf_dir)
    return per_session[sf_dir]


# Each adapted table is one projection written as SQL expressions (``selectExpr``): one call into the
# JVM per table instead of one per column expression, which keeps building a query cheap.


def _subscribers(d: DriverTables) -> DataFrame:
    return d.raw("customer").selectExpr(
        "c_custkey AS subscribers_id",
        "c_name AS name",
        "CAST(NULL AS STRING) AS surname",
        f"date_add(DATE '{BIRTH_ORIGIN}', CAST((c_custkey * {BIRTH_STEP}) % {BIRTH_SPAN_DAYS} AS INT)) AS birth_date",
        "c_mktsegment AS gender",
        "c_name AS phone_number",
        "CASE WHEN c_acctbal < 0 THEN 'PASSIVE' ELSE 'ACTIVE' END AS status",
    )


def _payments(d: DriverTables) -> DataFrame:
    return d.raw("orders").selectExpr(
        "o_orderkey AS payment_id",
        "o_custkey AS subscribers_id",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS amount",
        "o_orderpriority AS payment_type_id",
        "o_orderdate AS payment_date",
    )


def _payment_method_type(d: DriverTables) -> DataFrame:
    return (
        d.raw("orders").selectExpr("o_orderpriority AS payment_type_id").distinct()
        .selectExpr("payment_type_id", "payment_type_id AS name")
    )


def _services(d: DriverTables) -> DataFrame:
    return d.raw("part").selectExpr(
        "p_partkey AS service_id",
        "p_name AS service_name",
        f"CASE WHEN p_size <= {SERVICE_ACTIVE_MAX_SIZE} THEN CAST(NULL AS TIMESTAMP_NTZ) "
        f"ELSE TIMESTAMP_NTZ '{SERVICE_DEACTIVATED_AT}' END AS deactivation_date",
        "p_type AS tariff_id",
    )


def _tariff_informations(d: DriverTables) -> DataFrame:
    return (
        d.raw("part").groupBy(F.col("p_type").alias("tariff_id"))
        .agg(F.min("p_retailprice").cast("decimal(18,4)").alias("monthly_subscription"))
        .selectExpr("tariff_id", "tariff_id AS tariff_name", "monthly_subscription", f"{TARIFF_STATUS} AS status")
    )


def _calls(d: DriverTables) -> DataFrame:
    orders = d.raw("orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
    return d.raw("lineitem").join(orders, "l_orderkey").selectExpr(
        "l_orderkey AS order_key",
        "l_linenumber AS line_number",
        "o_custkey AS caller_id",
        "l_shipdate AS call_date",
        "CAST(l_quantity AS BIGINT) AS call_duration",
        "CAST(NULL AS STRING) AS receiver_phone",
        f"(o_custkey * {RECEIVER_STEP} + {RECEIVER_OFFSET}) % {RECEIVER_SPAN} AS receiver_subscriber_id",
        "l_returnflag AS call_type_id",
        "l_partkey AS service_id",
        "l_linestatus AS call_type",
    )


def _call_type(d: DriverTables) -> DataFrame:
    return (
        d.raw("lineitem").selectExpr("l_returnflag AS call_type_id").distinct()
        .selectExpr("call_type_id", "call_type_id AS name")
    )


def _sms_events(d: DriverTables) -> DataFrame:
    return d.raw("events").where("event_type <> 'error'")


SHIFTED_TS = f"ts - INTERVAL {SMS_SHIFT_MONTHS} MONTHS"


def _sms_informations(d: DriverTables) -> DataFrame:
    return _sms_events(d).selectExpr(
        "event_id AS sms_id",
        "user_id AS sender_id",
        f"{SHIFTED_TS} AS sms_date",
        "CAST(NULL AS STRING) AS receiver_phone",
        "props AS sms_content",
        "event_type AS sms_type_id",
        f"event_id % {SMS_SERVICES} AS service_id",
    )


def _sms_types(d: DriverTables) -> DataFrame:
    return (
        _sms_events(d).selectExpr("event_type AS sms_type_id").distinct()
        .selectExpr("sms_type_id", "sms_type_id AS name")
    )


def _complaints(d: DriverTables) -> DataFrame:
    return d.raw("events").where("event_type = 'error'").selectExpr(
        "event_id AS complaint_id",
        "user_id AS subscribers_id",
        f"event_id % {COMPLAINT_KINDS} AS complaint_type_id",
        "'UNSOLVED' AS status",
        f"{SHIFTED_TS} AS submission_date",
    )


def _complaint_type(d: DriverTables) -> DataFrame:
    kinds = d.raw("events").where("event_type = 'error'").selectExpr(f"event_id % {COMPLAINT_KINDS} AS complaint_type_id")
    return kinds.where("complaint_type_id > 0").distinct().selectExpr(
        "complaint_type_id", "concat('Kind ', complaint_type_id) AS complaint_type_name"
    )


def _address_type(d: DriverTables) -> DataFrame:
    return d.raw("region").selectExpr("CAST(r_regionkey AS BIGINT) AS type_id", "r_name AS type_name")


def _address(d: DriverTables) -> DataFrame:
    own = d.raw("customer").selectExpr(
        "c_custkey", "c_nationkey AS n_nationkey", f"explode(sequence(0L, c_custkey % {ADDRESSES})) AS k"
    )
    return own.join(d.raw("nation"), "n_nationkey", "left").selectExpr(
        "c_custkey AS subscribers_id",
        "concat('House ', c_custkey * 10 + k, ', ', n_name) AS address_name",
        f"(c_custkey + k) % {ADDRESS_KINDS} AS type_id",
    )


def _technical_data(d: DriverTables) -> DataFrame:
    own = d.raw("customer").selectExpr("*", "explode(sequence(0L, c_custkey % 2)) AS k")
    return own.selectExpr(
        "c_custkey * 2 + k AS device_id",
        "c_custkey AS subscribers_id",
        "CASE WHEN k = 0 THEN 'PHONE' ELSE 'MODEM' END AS device_type",
        "lpad(CAST(c_custkey * 2 + k AS STRING), 15, '0') AS imei_number",
        "concat('OS-', c_mktsegment) AS operating_system",
        "CASE WHEN c_acctbal < 0 THEN '3G' ELSE '4G' END AS network_type",
        "TIMESTAMP_NTZ '1998-01-01 00:00:00' + make_dt_interval(CAST(c_custkey % 365 AS INT)) AS connection_history",
    )


_BUILDERS = {
    "address_type": _address_type,
    "address": _address,
    "technical_data": _technical_data,
    "complaint_type": _complaint_type,
    "subscribers": _subscribers,
    "payments": _payments,
    "payment_method_type": _payment_method_type,
    "services": _services,
    "tariff_informations": _tariff_informations,
    "calls": _calls,
    "call_type": _call_type,
    "sms_informations": _sms_informations,
    "sms_types": _sms_types,
    "complaints_and_support_requests": _complaints,
}


# The same mapping as DuckDB CTEs, for the independent SQL check. Table names are the driver's views.
ORACLE_CTES = f"""
subscribers AS (
  SELECT c_custkey AS subscribers_id, c_name AS name, CAST(NULL AS VARCHAR) AS surname,
         CAST(DATE '{BIRTH_ORIGIN}' + CAST((c_custkey * {BIRTH_STEP}) % {BIRTH_SPAN_DAYS} AS INTEGER) AS DATE) AS birth_date,
         c_mktsegment AS gender, c_name AS phone_number,
         CASE WHEN c_acctbal < 0 THEN 'PASSIVE' ELSE 'ACTIVE' END AS status
  FROM customer),
payments AS (
  SELECT o_orderkey AS payment_id, o_custkey AS subscribers_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         o_orderpriority AS payment_type_id, o_orderdate AS payment_date
  FROM orders),
payment_method_type AS (
  SELECT DISTINCT o_orderpriority AS payment_type_id, o_orderpriority AS name FROM orders),
services AS (
  SELECT p_partkey AS service_id, p_name AS service_name,
         CASE WHEN p_size <= {SERVICE_ACTIVE_MAX_SIZE} THEN CAST(NULL AS TIMESTAMP)
              ELSE TIMESTAMP '{SERVICE_DEACTIVATED_AT}' END AS deactivation_date,
         p_type AS tariff_id
  FROM part),
tariff_informations AS (
  SELECT p_type AS tariff_id, p_type AS tariff_name,
         CAST(MIN(p_retailprice) AS DECIMAL(18,4)) AS monthly_subscription,
         {TARIFF_STATUS.replace('tariff_id', 'p_type')} AS status
  FROM part GROUP BY p_type),
calls AS (
  SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_number, o.o_custkey AS caller_id,
         l.l_shipdate AS call_date, CAST(l.l_quantity AS BIGINT) AS call_duration,
         CAST(NULL AS VARCHAR) AS receiver_phone,
         (o.o_custkey * {RECEIVER_STEP} + {RECEIVER_OFFSET}) % {RECEIVER_SPAN} AS receiver_subscriber_id,
         l.l_returnflag AS call_type_id, l.l_partkey AS service_id, l.l_linestatus AS call_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
call_type AS (
  SELECT DISTINCT l_returnflag AS call_type_id, l_returnflag AS name FROM lineitem),
sms_informations AS (
  SELECT event_id AS sms_id, user_id AS sender_id, ts - INTERVAL {SMS_SHIFT_MONTHS} MONTH AS sms_date,
         CAST(NULL AS VARCHAR) AS receiver_phone, props AS sms_content, event_type AS sms_type_id,
         event_id % {SMS_SERVICES} AS service_id
  FROM events WHERE event_type <> 'error'),
sms_types AS (
  SELECT DISTINCT event_type AS sms_type_id, event_type AS name FROM events WHERE event_type <> 'error'),
complaints_and_support_requests AS (
  SELECT event_id AS complaint_id, user_id AS subscribers_id, event_id % {COMPLAINT_KINDS} AS complaint_type_id,
         'UNSOLVED' AS status, ts - INTERVAL {SMS_SHIFT_MONTHS} MONTH AS submission_date
  FROM events WHERE event_type = 'error'),
complaint_type AS (
  SELECT DISTINCT event_id % {COMPLAINT_KINDS} AS complaint_type_id, 'Kind ' || (event_id % {COMPLAINT_KINDS}) AS complaint_type_name
  FROM events WHERE event_type = 'error' AND event_id % {COMPLAINT_KINDS} > 0),
address_type AS (SELECT CAST(r_regionkey AS BIGINT) AS type_id, r_name AS type_name FROM region),
address AS (
  SELECT c.c_custkey AS subscribers_id, 'House ' || (c.c_custkey * 10 + c.k) || ', ' || n.n_name AS address_name,
         (c.c_custkey + c.k) % {ADDRESS_KINDS} AS type_id
  FROM (SELECT *, unnest(range(c_custkey % {ADDRESSES} + 1)) AS k FROM customer) c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey),
technical_data AS (
  SELECT c_custkey * 2 + k AS device_id, c_custkey AS subscribers_id, CASE WHEN k = 0 THEN 'PHONE' ELSE 'MODEM' END AS device_type,
         lpad(CAST(c_custkey * 2 + k AS VARCHAR), 15, '0') AS imei_number, 'OS-' || c_mktsegment AS operating_system,
         CASE WHEN c_acctbal < 0 THEN '3G' ELSE '4G' END AS network_type,
         TIMESTAMP '1998-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS connection_history
  FROM (SELECT *, unnest(range(c_custkey % 2 + 1)) AS k FROM customer))
"""


# Column names of each adapted table, in order (checked against the DataFrames by the tests).
ADAPTED_COLUMNS: dict[str, tuple[str, ...]] = {
    "subscribers": ("subscribers_id", "name", "surname", "birth_date", "gender", "phone_number", "status"),
    "payments": ("payment_id", "subscribers_id", "amount", "payment_type_id", "payment_date"),
    "payment_method_type": ("payment_type_id", "name"),
    "services": ("service_id", "service_name", "deactivation_date", "tariff_id"),
    "tariff_informations": ("tariff_id", "tariff_name", "monthly_subscription", "status"),
    "calls": (
        "order_key", "line_number", "caller_id", "call_date", "call_duration", "receiver_phone",
        "receiver_subscriber_id", "call_type_id", "service_id", "call_type",
    ),
    "call_type": ("call_type_id", "name"),
    "sms_informations": (
        "sms_id", "sender_id", "sms_date", "receiver_phone", "sms_content", "sms_type_id", "service_id",
    ),
    "sms_types": ("sms_type_id", "name"),
    "complaints_and_support_requests": (
        "complaint_id", "subscribers_id", "complaint_type_id", "status", "submission_date",
    ),
    "complaint_type": ("complaint_type_id", "complaint_type_name"),
    "address_type": ("type_id", "type_name"),
    "address": ("subscribers_id", "address_name", "type_id"),
    "technical_data": (
        "device_id", "subscribers_id", "device_type", "imei_number", "operating_system", "network_type", "connection_history",
    ),
}


def driver_domain_checks() -> list[tuple[str, str, str, int]]:
    """Declared lengths / precisions (A6) of the columns the adapted tables carry. Ids that the
    mapping turns into text (tariff, call kind, SMS kind, method) have no declared bound."""
    from telcolens.sources.schemas import TABLES

    out = []
    for table, cols in ADAPTED_COLUMNS.items():
        for col in TABLES[table].columns:
            if col.name not in cols:
                continue
            if col.max_len is not None:
                out.append((table, col.name, "max_bytes" if col.byte_len else "max_length", col.max_len))
            if col.max_digits is not None:
                out.append((table, col.name, "max_digits", col.max_digits))
    return out
