"""Dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(year: Column, week: Column) -> Column:
    """Monday of a Monday-based week number; week 1 starts at the year's first Monday."""
    before_year = F.date_sub(F.make_date(year, F.lit(1), F.lit(1)), 1)
    return F.date_add(F.next_day(before_year, "MON"), (week - 1) * 7)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def timestamp_from_text(text: Column) -> Column:
    """ISO text, or epoch seconds written as a number."""
    seconds = F.when(text.rlike(r"^[0-9]+(?:\.[0-9]+)?$"), text.try_cast("double"))
    return F.coalesce(F.timestamp_seconds(seconds), F.try_to_timestamp(text))


def date_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def stamp_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def as_date(text: Column) -> Column:
    """Date of a text that starts with yyyy-mm-dd, with or without a time behind it, or null."""
    shaped = (
        (F.substring(text, 5, 1) == "-")
        & (F.substring(text, 8, 1) == "-")
        & F.substring(text, 11, 1).isin("", " ", "T")
    )
    return F.when(shaped, F.substring(text, 1, 10).try_cast("date"))
