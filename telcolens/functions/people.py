"""Scalar helpers on subscriber and service rows: age (H4), age band (H5), predicates (B3, B4),
zero fill (H6) and the strict comparison flag (H7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telcolens.functions.timewin import AsOf, ts_lit

# The four age bands of the age-group question, in its order, plus our label for a
# missing birth date.
BAND_18_AND_BELOW = "18 and below"
BAND_19_30 = "19-30"
BAND_31_50 = "31-50"
BAND_51_AND_ABOVE = "51 and above"
BAND_UNKNOWN = "unknown"
AGE_BANDS = (BAND_18_AND_BELOW, BAND_19_30, BAND_31_50, BAND_51_AND_ABOVE, BAND_UNKNOWN)


def age_years(birth_date: str | Column, as_of: AsOf) -> Column:
    """Whole years between birth and ``as_of``; the birthday itself counts as a full year."""
    b = F.col(birth_date) if isinstance(birth_date, str) else birth_date
    return F.floor(F.months_between(ts_lit(as_of), b.cast("timestamp_ntz")) / 12).cast("int")


def age_band(age: Column) -> Column:
    return (
        F.when(age.isNull(), F.lit(BAND_UNKNOWN))
        .when(age <= 18, F.lit(BAND_18_AND_BELOW))
        .when(age <= 30, F.lit(BAND_19_30))
        .when(age <= 50, F.lit(BAND_31_50))
        .otherwise(F.lit(BAND_51_AND_ABOVE))
    )


def not_active(status: str | Column = "status") -> Column:
    """``status <> 'ACTIVE'``; a null status is unknown and does not match."""
    s = F.col(status) if isinstance(status, str) else status
    return s != F.lit("ACTIVE")


def service_active(as_of: AsOf, deactivation: str = "deactivation_date") -> Column:
    """A service is active unless it was deactivated at or before ``as_of``."""
    d = F.col(deactivation)
    return d.isNull() | (d > ts_lit(as_of))


def zero(col: str, dtype: str = "bigint") -> Column:
    """H6: null -> 0 for counts and sums after a left join."""
    return F.expr(f"coalesce(`{col}`, CAST(0 AS {dtype})) AS `{col}`")


def money_total(col: str) -> Column:
    """Money sums are decimal(18,2) summed exactly and widened to decimal(38,2)."""
    return F.expr(f"CAST(sum(`{col}`) AS DECIMAL(38,2))")


def strictly_above(value: Column, reference: Column) -> Column:
    """H7: true if strictly higher; null if either side is unknown."""
    return value > reference
