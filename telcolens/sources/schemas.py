"""Typed table definitions (A1) with their comments (A7), keys and load defaults.

Every table of the operator data model is a fixed ``StructType``; nothing is inferred.
Comments travel as ``StructField.metadata["comment"]`` so they survive a Parquet write.
Column types: keys -> long, prices -> decimal(18,4), money -> decimal(18,2),
durations -> long seconds, calendar dates -> date, event times -> timestamp_ntz.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG = T.LongType()
STR = T.StringType()
DATE = T.DateType()
TS = T.TimestampNTZType()
PRICE = T.DecimalType(18, 4)
MONEY = T.DecimalType(18, 2)

# Marker values for load-time defaults (A3): SYSDATE means "the batch load time".
SYSDATE = "__load_ts__"


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    comment: str = ""
    default: object = None  # SYSDATE, a literal, or None (= no default)
    max_len: int | None = None  # varchar2(n) length, checked by dq_domain
    byte_len: bool = False  # varchar2(n) without CHAR counts bytes (the default length semantics)
    max_digits: int | None = None  # number(n) precision, checked by dq_domain


@dataclass(frozen=True)
class Table:
    name: str
    comment: str
    columns: tuple[Col, ...]
    primary_key: tuple[str, ...] = ()
    # (column, parent table, parent column)
    foreign_keys: tuple[tuple[str, str, str], ...] = field(default_factory=tuple)
    event_time: str | None = None  # timestamp used for month partitioning of facts

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(c.name, c.dtype, True, {"comment": c.comment} if c.comment else {})
                for c in self.columns
            ]
        )

    def column(self, name: str) -> Col:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name}.{name}")


def _status(default: str = "ACTIVE") -> Col:
    return Col("status", STR, "Row status", default, max_len=20, byte_len=True)


TABLES: dict[str, Table] = {
    t.name: t
    for t in [
        Table(
            "subscribers",
            "Subscriber master data",
            (
                Col("subscribers_id", LONG, "Unique subscriber id", max_digits=10),
                Col("name", STR, "First name", max_len=60),
                Col("surname", STR, "Surname", max_len=60),
                Col("patronymic", STR, "Father's name", max_len=60),
                Col("birth_date", DATE, "Date of birth"),
                Col("gender", STR, "Gender", max_len=20),
                Col("registration_date", TS, "Registration time", SYSDATE),
                Col("email", STR, "E-mail address", max_len=200, byte_len=True),
                Col("phone_number", STR, "Phone number", max_len=20, byte_len=True),
                Col("status", STR, "ACTIVE or PASSIVE", "ACTIVE", max_len=20, byte_len=True),
                Col("changed_date", TS, "Time of the last status change"),
            ),
            primary_key=("subscribers_id",),
        ),
        Table(
            "address_type",
            "Address kinds",
            (
                Col("type_id", LONG, "Address kind id"),
                Col("type_name", STR, "Address kind", max_len=250),
                Col("insert_date", TS, "Row insert time", SYSDATE),
                _status(),
                Col("changed_date", TS, "Time of the last status change"),
            ),
            primary_key=("type_id",),
        ),
        Table(
            "address",
            "Subscriber addresses",
            (
                Col("subscribers_id", LONG, "Subscriber id", max_digits=10),
                Col("address_name", STR, "Address text", max_len=2000),
                Col("type_id", LONG, "Address kind id"),
                Col("insert_date", TS, "Row insert time", SYSDATE),
                _status(),
                Col("changed_date", TS, "Time of the last status change"),
            ),
            foreign_keys=(
                ("subscribers_id", "subscribers", "subscribers_id"),
                ("type_id", "address_type", "type_id"),
            ),
        ),
        Table(
            "tariff_informations",
            "Tariff plans",
            (
                Col("tariff_id", LONG, "Tariff id"),
                Col("tariff_name", STR, "Tariff name", max_len=1000),
                Col("call_price", PRICE, "Call price per minute"),
                Col("message_price", PRICE, "Price per SMS"),
                Col("internet_price", PRICE, "Price per MB"),
                Col("monthly_subscription", PRICE, "Monthly subscription fee"),
                Col("insert_date", TS, "Row insert time", SYSDATE),
                _status(),
                Col("activation_date", TS, "Activation time"),
                Col("deactivation_date", TS, "Deactivation time"),
            ),
            primary_key=("tariff_id",),
        ),
        Table(
            "call_type",
            "Call kinds (domestic, external, international)",
            (
                Col("call_type_id", LONG, "Call kind id"),
                Col("name", STR, "Call kind", max_len=500),
                Col("insert_date", TS, "Row insert time", SYSDATE),
                _status(),
                Col("changed_date", TS, "Time of the last status change"),
            ),
            primary_key=("call_type_id",),
        ),
        Table(
            "services",
            "Services offered under a tariff",
            (
                Col("service_id", LONG, "Service id"),
                Col("service_name", STR, "Service name", max_len=500),
                Col("description", STR, "Service description", max_len=500),
                Col("activation_date", TS, "Activation time"),
                Col("deactivation_date", TS, "Deactivation time"),
                Col("insert_date", TS, "Row insert time", SYSDATE),
                Col("tariff_id", LONG, "Tariff id"),
            ),
            primary_key=("service_id",),
            foreign_keys=(("tariff_id", "tariff_informations", "tariff_id"),),
        ),
        Table(
            "calls",
            "Calls",
            (
                Col("call_id", LONG, "Call id"),
                Col("caller_id", LONG, "Calling subscriber", max_digits=10),
                Col("call_date", TS, "Call date and time", SYSDATE),
                Col("call_duration", LONG, "Duration in seconds"),
                Col("receiver_phone", STR, "Called phone number", max_len=20, byte_len=True),
                Col("call_type_id", LONG, "Call kind id"),
                Col("service_id", LONG, "Service id"),
                Col("call_type", STR, "Direction (Send / Receive)", max_len=100),
            ),
            primary_key=("call_id",),
            foreign_keys=(
                ("caller_id", "subscribers", "subscribers_id"),
                ("service_id", "services", "service_id"),
                ("call_type_id", "call_type", "call_type_id"),
            ),
            event_time="call_date",
        ),
        Table(
            "sms_types",
            "SMS kinds",
            (
                Col("sms_type_id", LONG, "SMS kind id"),
                Col("name", STR, "SMS kind", max_len=500),
                _status(),
                Col("insert_date", TS, "Row insert time", SYSDATE),
                Col("changed_date", TS, "Time of the last status change"),
            ),
            primary_key=("sms_type_id",),
        ),
        Table(
            "sms_informations",
            "SMS records",
            (
                Col("sms_id", LONG, "SMS id"),
                Col("sender_id", LONG, "Sending subscriber"),
                Col("sms_date", TS, "SMS date and time", SYSDATE),
                Col("receiver_phone", STR, "Receiving phone number", max_len=20, byte_len=True),
                Col("sms_content", STR, "Message text", max_len=4000),
                Col("sms_type_id", LONG, "SMS kind id"),
                Col("insert_date", TS, "Row insert time", SYSDATE),
                Col("service_id", LONG, "Service the SMS belongs to"),
            ),
            primary_key=("sms_id",),
            foreign_keys=(
                ("sender_id", "subscribers", "subscribers_id"),
                ("sms_type_id", "sms_types", "sms_type_id"),
                ("service_id", "services", "service_id"),
            ),
            event_time="sms_date",
        ),
        Table(
            "payment_method_type",
            "Payment methods",
            (
                Col("payment_type_id", LONG, "Payment method id"),
                Col("name", STR, "Payment method", max_len=500),
                Col("insert_date", TS, "Row insert time", SYSDATE),
                _status(),
                Col("changed_date", TS, "Time of the last status change"),
            ),
            primary_key=("payment_type_id",),
        ),
        Table(
            "payments",
            "Payments",
            (
                Col("payment_id", LONG, "Payment id"),
                Col("subscribers_id", LONG, "Paying subscriber"),
                Col("amount", MONEY, "Amount"),
                Col("payment_type_id", LONG, "Payment method id (no declared key)"),
                Col("payment_date", TS, "Payment time", SYSDATE),
            ),
            primary_key=("payment_id",),
            # The method reference is documented but not declared; it is checked all the same.
            foreign_keys=(
                ("subscribers_id", "subscribers", "subscribers_id"),
                ("payment_type_id", "payment_method_type", "payment_type_id"),
            ),
            event_time="payment_date",
        ),
        Table(
            "complaint_type",
            "Complaint and request kinds",
            (
                Col("complaint_type_id", LONG, "Complaint kind id"),
                Col("complaint_type_name", STR, "Complaint kind", max_len=250),
                _status(),
                Col("insert_date", TS, "Row insert time", SYSDATE),
                Col("changed_date", TS, "Time of the last status change"),
            ),
            primary_key=("complaint_type_id",),
        ),
        Table(
            "complaints_and_support_requests",
            "Complaints and support requests",
            (
                Col("complaint_id", LONG, "Complaint id"),
                Col("subscribers_id", LONG, "Complaining subscriber"),
                Col("complaint_type_id", LONG, "Complaint kind id"),
                Col("description", STR, "Description", max_len=250),
                Col("status", STR, "SOLVED or UNSOLVED", "UNSOLVED", max_len=100, byte_len=True),
                Col("submission_date", TS, "Submission time"),
                Col("resolution_date", TS, "Resolution time"),
                Col("insert_date", TS, "Row insert time", SYSDATE),
            ),
            primary_key=("complaint_id",),
            foreign_keys=(
                ("subscribers_id", "subscribers", "subscribers_id"),
                ("complaint_type_id", "complaint_type", "complaint_type_id"),
            ),
            event_time="submission_date",
        ),
        Table(
            "technical_data",
            "Subscriber devices",
            (
                Col("device_id", LONG, "Device id"),
                Col("subscribers_id", LONG, "Owning subscriber"),
                Col("device_type", STR, "PHONE or MODEM", max_len=250),
                Col("imei_number", STR, "IMEI", max_len=250),
                Col("operating_system", STR, "Operating system", max_len=250),
                Col("network_type", STR, "Network generation", max_len=250),
                Col("connection_history", TS, "Last connection time", SYSDATE),
            ),
            primary_key=("device_id",),
            foreign_keys=(("subscribers_id", "subscribers", "subscribers_id"),),
        ),
    ]
}


def schema(table: str) -> T.StructType:
    """A1: the declared schema of ``table``."""
    return TABLES[table].schema


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _default_sql(c: Col, load_ts: str | None) -> str:
    """A3 for SQL users: the column's DEFAULT clause."""
    if c.default is None:
        return ""
    if c.default == SYSDATE:
        now = "localtimestamp()" if load_ts is None else f"TIMESTAMP_NTZ {_quote(load_ts)}"
        return f" DEFAULT {now}"
    return f" DEFAULT {_quote(c.default) if isinstance(c.default, str) else c.default}"


def create_table_sql(table: str, location: str, partition_column: str | None = "event_month", load_ts: str | None = None) -> str:
    """A1 + A3 + A7 as catalog DDL: ``CREATE TABLE ... USING parquet`` with the table and column comments and the columns' defaults,
    partitioned by event month for fact tables (the layout ``load.append`` writes).

    An SQL ``INSERT`` that names a subset of the columns then fills the others as a load does; a named null stays null. ``sysdate``
    columns take the session's time, or ``load_ts`` where a batch has a load time of its own (``ALTER TABLE`` can move it on)."""
    t = TABLES[table]
    cols = [
        f"{c.name} {c.dtype.simpleString()}{_default_sql(c, load_ts)}" + (f" COMMENT {_quote(c.comment)}" if c.comment else "")
        for c in t.columns
    ]
    part = ""
    if t.event_time is not None and partition_column:
        cols.append(f"{partition_column} date")
        part = f" PARTITIONED BY ({partition_column})"
    return (
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(cols)}) USING parquet{part} "
        f"COMMENT {_quote(t.comment)} LOCATION {_quote(location)}"
    )
