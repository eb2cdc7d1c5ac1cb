"""Column expressions on dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(date) -> Column:
    """Calendar month as text, e.g. ``2024-07``."""
    return F.date_format(date, "yyyy-MM")


def month_name(date) -> Column:
    """Calendar month in words, e.g. ``July 2024``."""
    return F.date_format(date, "MMMM yyyy")


def weekday_name(date) -> Column:
    return F.date_format(date, "EEEE")


def is_weekend(date) -> Column:
    """True on Saturday and Sunday, False otherwise and for a missing date."""
    return F.coalesce(F.weekday(date).isin(5, 6), F.lit(False))
