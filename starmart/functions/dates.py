"""Date expressions (all built-in, null-safe, ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: day zero of the SAS day numbering (fixed value)
SAS_EPOCH = "1960-01-01"
#: day numbers of 0001-01-01 and 9999-12-31, the first and last day of the calendar (fixed values)
SAS_FIRST_DAY, SAS_LAST_DAY = -715_509, 2_936_549


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_date_safe(col: str | Column) -> Column:
    """Text or timestamp to ``date``; malformed text becomes null instead of an ANSI error."""
    return _c(col).try_cast("date")


def sas_date(day_number: str | Column) -> Column:
    """SAS day number (days since 1960-01-01, may be fractional) to ``date``.

    A fraction keeps the day it starts in (floor), so -0.5 is 1959-12-31.  Null, NaN or a
    number outside the years 1 to 9999 gives null.
    """
    x = _c(day_number).try_cast("double")
    # floor(NaN) would be 0
    ok = ~F.isnan(x) & (x >= F.lit(SAS_FIRST_DAY)) & (x < F.lit(SAS_LAST_DAY + 1))
    days = F.when(ok, F.floor(x)).try_cast("int")
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), days)


def sas_day_number(date: str | Column) -> Column:
    """Inverse of :func:`sas_date` for whole days."""
    return F.datediff(_c(date).cast("date"), F.lit(SAS_EPOCH).cast("date"))


def year_month(col: str | Column) -> dict[str, Column]:
    """``year`` and ``month`` of a date held as text (null when the text is not a date)."""
    d = to_date_safe(col)
    return {"year": F.year(d), "month": F.month(d)}


def calendar_parts(date: str | Column) -> dict[str, Column]:
    """Parts of the date dimension.  ``week`` is the ISO week (2016-01-01 is week 53)."""
    d = _c(date)
    return {
        "day": F.dayofmonth(d).cast("int"),
        "week": F.weekofyear(d).cast("int"),
        "month": F.month(d).cast("int"),
        "year": F.year(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
    }


def iso_year(date: str | Column) -> Column:
    """The year an ISO week belongs to; pair it with ``weekofyear`` for weekly series."""
    return F.extract(F.lit("YEAROFWEEK"), _c(date)).cast("int")
