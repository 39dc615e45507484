"""Dates, exact ages and calendar features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortry.functions.recode import case_when

SEASONS = ["Winter", "Spring", "Summer", "Fall"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(col: Column | str, pattern: str = "M/d/yyyy") -> Column:
    """Text → date. The one-letter pattern takes both 1/5/2011 and 01/05/2011; bad text becomes NULL."""
    return F.try_to_date(_col(col), pattern)


def age_years_exact(birth: Column | str, on: Column | str) -> Column:
    """Whole birthdays passed plus the share of the current birthday year (29 Feb falls back to 28 Feb)."""
    b, d = _col(birth).cast("date"), _col(on).cast("date")
    diff = F.year(d) - F.year(b)
    years = diff - (F.add_months(b, diff * 12) > d).cast("int")
    last, following = F.add_months(b, years * 12), F.add_months(b, (years + 1) * 12)
    return years + F.datediff(d, last) / F.datediff(following, last)


def season(month: Column | str) -> Column:
    m = _col(month)
    return case_when(
        (m.isin(12, 1, 2), "Winter"),
        (m.isin(3, 4, 5), "Spring"),
        (m.isin(6, 7, 8), "Summer"),
        (m.isin(9, 10, 11), "Fall"),
    )


def is_weekend(date: Column | str) -> Column:
    """Saturday or Sunday, from the date itself; an unknown date is not a weekend."""
    return F.coalesce(F.dayofweek(_col(date)).isin(1, 7), F.lit(False))
