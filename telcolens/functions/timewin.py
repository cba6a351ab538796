"""Report time (H2), month arithmetic (H3) and relative windows (B2).

``as_of`` is always a parameter; no report reads the clock. Window bounds are computed once on the
driver as literals, so the predicate stays on the raw column and reaches the Parquet scan.
"""

from __future__ import annotations

import calendar
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = datetime | str


def as_datetime(value: AsOf) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(str(value))


def as_of_text(value: AsOf) -> str:
    return as_datetime(value).isoformat(sep=" ")


def ts_lit(value: AsOf) -> Column:
    """A timestamp_ntz literal (time-zone free)."""
    return F.expr(f"TIMESTAMP_NTZ '{as_datetime(value).isoformat(sep=' ')}'")


def months_before(value: AsOf, months: int) -> datetime:
    """``value - INTERVAL months MONTH``: the day is clamped to the target month's end."""
    ts = as_datetime(value)
    total = ts.year * 12 + (ts.month - 1) - months
    year, month0 = divmod(total, 12)
    day = min(ts.day, calendar.monthrange(year, month0 + 1)[1])
    return ts.replace(year=year, month=month0 + 1, day=day)


def up_to(col: str | Column, as_of: AsOf) -> Column:
    """``col <= as_of``: facts up to a time (used by the optional cut of the call enrichment)."""
    c = F.col(col) if isinstance(col, str) else col
    return c <= ts_lit(as_of)


def in_last_months(col: str | Column, as_of: AsOf, months: int) -> Column:
    """B2: ``as_of - n months <= col <= as_of``, both ends inclusive."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= ts_lit(months_before(as_of, months))) & (c <= ts_lit(as_of))


def window(col: str | Column, as_of: AsOf, months: int | None) -> Column:
    """The facts a question reads: its last ``months`` months, or every fact when it names no
    window (``months=None``; ``as_of`` then only anchors ages and service activity)."""
    return F.lit(True) if months is None else in_last_months(col, as_of, months)


# Partition column of fact tables written by ``sources.load.append``: first day of the event month.
MONTH_COLUMN = "event_month"


def month_predicate(as_of: AsOf, months: int | None) -> Column:
    """Partition filter covering ``[as_of - n months, as_of]`` (or everything up to ``as_of``'s
    month): a timestamp filter alone does not prune the derived month column."""
    hi = as_datetime(as_of).date().replace(day=1)
    c = F.col(MONTH_COLUMN)
    pred = c <= F.lit(hi.isoformat()).cast("date")
    if months is not None:
        lo = months_before(as_of, months).date().replace(day=1)
        pred = pred & (c >= F.lit(lo.isoformat()).cast("date"))
    return pred


def restrict(df: DataFrame, col: str, as_of: AsOf, months: int | None) -> DataFrame:
    """The rows of a fact table a question reads (``window``). On the month-partitioned layout
    (an ``event_month`` column) the matching partition predicate is added, so only the window's
    months are listed and read."""
    if months is None:
        return df
    out = df.where(in_last_months(col, as_of, months))
    if MONTH_COLUMN in df.columns:
        out = out.where(month_predicate(as_of, months))
    return out
