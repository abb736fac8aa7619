"""Predicates and labels on text, numbers and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"
MONTH_FORMAT = "yyyy-MM"

# Country names shown on the map.
DISPLAY_COUNTRY = {"USA": "United States", "UK": "United Kingdom"}


def is_blank(column: Column) -> Column:
    """NULL or empty; the cast keeps ANSI mode from parsing '' as a number."""
    return column.isNull() | (column.cast("string") == "")


def is_present(column: Column) -> Column:
    return column.isNotNull() & (column.cast("string") != "")


def parsed_date(column: Column) -> Column:
    """Strict yyyy-MM-dd; anything else, including 2025-02-30, is NULL."""
    return F.try_to_date(column, DATE_FORMAT)


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The day that counts as today; the current date when none is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def month_of(column: Column) -> Column:
    return F.date_format(column, MONTH_FORMAT)


def display_country(column: Column) -> Column:
    label = column
    for short, long in DISPLAY_COUNTRY.items():
        label = F.when(column == short, long).otherwise(label)
    return label
