"""Period labels: a date's day, month, quarter or year, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "quarter": "yyyy'Q'q", "year": "yyyy"}


def label(date: Column, period: str) -> Column:
    return F.date_format(date, FORMATS[period])


def first_day(date: Column, period: str) -> Column:
    """First day of a date's period: a number to group many rows by, of which the label is made once a group."""
    return F.to_date(date) if period == "day" else F.trunc(date, {"month": "MM", "quarter": "QUARTER", "year": "YEAR"}[period]).cast("date")


def start(name: Column) -> Column:
    """First day of a label of any period; null for other text."""
    quarter = F.make_date(F.substring(name, 1, 4).cast("int"), (F.substring(name, 6, 1).cast("int") - 1) * 3 + 1, F.lit(1))
    return (
        F.when(name.rlike(r"^\d{4}$"), F.try_to_date(F.concat(name, F.lit("-01-01"))))
        .when(name.rlike(r"^\d{4}Q[1-4]$"), quarter)
        .when(name.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(name, F.lit("-01"))))
        .when(name.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(name))
    )


def end(name: Column) -> Column:
    """Last day of a label."""
    first = start(name)
    return F.when(F.length(name) == 4, F.add_months(first, 12) - 1).when(F.length(name) == 6, F.add_months(first, 3) - 1).when(F.length(name) == 7, F.last_day(first)).otherwise(first)


def previous(name: Column, period: str) -> Column:
    """Label of the period before."""
    back = {"day": lambda d: d - 1, "month": lambda d: F.add_months(d, -1), "quarter": lambda d: F.add_months(d, -3), "year": lambda d: F.add_months(d, -12)}[period]
    return label(back(start(name)), period)
