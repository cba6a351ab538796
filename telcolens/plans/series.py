"""Windowed reports (T1, T6, T7, T8, T14) at many report dates in one pass.

The rows of each report are those of the direct report at that date, with the date as ``as_of``. Facts are read once to make the tiles
(``operators.tiles``); later dates read tiles and the few edge rows. T7 lists payments, which no tile can hold: it reads the payments of all windows in one scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolens.functions.people import not_active, zero
from telcolens.functions.timewin import AsOf, as_datetime, in_last_months, ts_lit
from telcolens.operators.joins import attach_names
from telcolens.operators.tiles import Tile, append_tiles, at_dates, set_size, with_dates
from telcolens.operators.usage import usage_union
from telcolens.plans.questions import NAMES

Tables = Mapping[str, DataFrame]

PAYMENTS = Tile("payment_date", ("subscribers_id",), {"payments": ("count(1)", "sum"), "amount": ("CAST(sum(amount) AS DECIMAL(38,2))", "sum")})
USES = Tile("used_at", ("subscribers_id", "service_id"), {"uses": ("count(1)", "sum")})
CALLERS = Tile("call_date", ("call_type_id",), {"seconds": ("CAST(sum(call_duration) AS BIGINT)", "sum")}, distinct="caller_id")
ANY = "1970-01-01"  # the report time of a union of all facts, which it does not depend on
STORES = {"payments": PAYMENTS, "uses": USES, "callers": CALLERS}


def store_facts(t: Tables, name: str) -> DataFrame:
    """The facts of a store."""
    if name == "uses":
        return usage_union(t["calls"], t["sms_informations"], ANY).select("subscribers_id", "service_id", "used_at")
    return t["payments"] if name == "payments" else t["calls"]


def append_stores(t: Tables, root: str, names: Iterable[str] = tuple(STORES)) -> None:
    """Adds the tiles of the given facts (all of them, or a batch) to the stores below ``root``."""
    for name in names:
        append_tiles(store_facts(t, name), STORES[name], f"{root}/{name}")


def _at(t: Tables, root: str, name: str, as_ofs: Iterable[AsOf], months: int) -> DataFrame:
    return at_dates(t["subscribers"].sparkSession, f"{root}/{name}", store_facts(t, name), STORES[name], as_ofs, months)


def t01_at_dates(t: Tables, root: str, as_ofs: Iterable[AsOf], months: int = 3) -> DataFrame:
    uses = _at(t, root, "uses", as_ofs, months).where(F.col("service_id").isNotNull())
    svc = t["services"].select("service_id", "service_name")
    out = attach_names(uses.join(svc, "service_id", "left"), t["subscribers"])
    return out.select("as_of", *NAMES, "service_id", "service_name", "uses")


def t06_at_dates(t: Tables, root: str, as_ofs: Iterable[AsOf], months: int = 12) -> DataFrame:
    """T6 on the last ``months`` months; distinct callers are counted from merged sets."""
    sets = _at(t, root, "callers", as_ofs, months)
    agg = sets.groupBy("as_of", "call_type_id").agg(set_size().alias("subscribers"), F.sum("seconds").cast("bigint").alias("seconds"))
    kinds = t["call_type"].select("call_type_id", F.col("name").alias("kind"))
    return agg.join(kinds, "call_type_id", "left").select("as_of", "call_type_id", "kind", "subscribers", "seconds")


def t07_at_dates(t: Tables, as_ofs: Iterable[AsOf], months: int = 6) -> DataFrame:
    subs = t["subscribers"].where(not_active("status")).select(*NAMES, "status")
    when = {as_datetime(a): in_last_months("payment_date", a, months) for a in as_ofs}
    pay = with_dates(t["payments"].select("payment_id", "subscribers_id", "payment_date"), when)
    return pay.join(subs, "subscribers_id").select("as_of", *NAMES, "status", "payment_id", "payment_date")


def _payments_services(t: Tables, root: str, as_ofs: Iterable[AsOf], months: int) -> tuple[DataFrame, DataFrame]:
    pay = _at(t, root, "payments", as_ofs, months).select("as_of", "subscribers_id", "amount")
    uses = _at(t, root, "uses", as_ofs, months).where(F.col("service_id").isNotNull())
    return pay, uses.groupBy("as_of", "subscribers_id").agg(F.count(F.lit(1)).alias("services"))


def t08_at_dates(t: Tables, root: str, as_ofs: Iterable[AsOf], months: int = 6) -> DataFrame:
    pay, svc = _payments_services(t, root, as_ofs, months)
    active = pay.join(svc, ["as_of", "subscribers_id"], "full").where(F.col("subscribers_id").isNotNull())
    out = attach_names(active, t["subscribers"])
    return out.select("as_of", *NAMES, zero("services"), zero("amount", "decimal(38,2)"))


def t14_at_dates(t: Tables, root: str, as_ofs: Iterable[AsOf], months: int = 6) -> DataFrame:
    """Every subscriber at every date."""
    as_ofs = list(as_ofs)
    pay, svc = _payments_services(t, root, as_ofs, months)
    dates = F.explode(F.array(*[ts_lit(a) for a in as_ofs])).alias("as_of")
    # Shuffled first: the files of all subscribers may be one task, which would hold a row a date of each.
    out = t["subscribers"].select(*NAMES).repartition("subscribers_id").select(dates, *NAMES)
    for part in (pay, svc):
        out = out.join(part, ["as_of", "subscribers_id"], "left")
    return out.select("as_of", *NAMES, zero("amount", "decimal(38,2)"), zero("services"))
