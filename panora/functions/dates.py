"""Date helpers (inventory C13-C15) and period keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_from_parts(year, month, day) -> Column:
    """DATE from (year, month, day); impossible dates and NULL parts -> NULL.

    ``make_date`` raises on an invalid date under ANSI, so the date is built
    as text and parsed with ``try_cast``.
    """
    parts = [_c(x).try_cast("int") for x in (year, month, day)]
    txt = F.format_string("%04d-%02d-%02d", *parts)
    ok = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    return F.when(ok, txt.try_cast("date"))


def week_block(d) -> Column:
    """Week of year as 7-day blocks counted from 1 January (1..53), not ISO."""
    return (F.floor((F.dayofyear(_c(d)) - 1) / 7) + 1).cast("int")


def year_month(d) -> Column:
    """``YYYY-MM`` label."""
    return F.date_format(_c(d), "yyyy-MM")


def month_index(d) -> Column:
    """Months since year 0 (a gap-aware integer period key for monthly panels)."""
    return (F.year(_c(d)) * 12 + F.month(_c(d)) - 1).cast("int")


def day_index(d, origin: str = "1970-01-01") -> Column:
    """Days since ``origin`` (integer period key for daily panels)."""
    return F.datediff(F.to_date(_c(d)), F.lit(origin).cast("date"))


PERIODS = {"day": lambda d: F.to_date(_c(d)),
           "week": week_block,
           "month": lambda d: F.month(_c(d)).cast("int"),
           "year_month": year_month,
           # keys that tell years apart
           "year_week": lambda d: F.concat(F.year(_c(d)).cast("string"), F.lit("-W"),
                                           F.lpad(week_block(d).cast("string"), 2, "0"))}
