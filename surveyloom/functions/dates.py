"""Date predicates. Each is a plain range on the column, so the scan can skip row groups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: dt.date | None) -> Column:
    """The run date: a given day, or today in the session's time zone."""
    return F.current_date() if as_of is None else F.lit(as_of)


def on_previous_day(col: Column, as_of: dt.date | None = None) -> Column:
    day = as_of_date(as_of)
    return (col >= F.date_sub(day, 1)) & (col < day)


def in_previous_months(col: Column, as_of: dt.date | None = None, months: int = 2) -> Column:
    """True for the `months` complete calendar months before the month of `as_of`."""
    day = as_of_date(as_of)
    return (col >= F.trunc(F.add_months(day, -months), "month")) & (col < F.trunc(day, "month"))


def in_rolling_years(col: Column, as_of: dt.date | None = None, years: int = 2) -> Column:
    """True from 1 January of the year `years` before `as_of`; there is no upper bound."""
    return col >= F.make_date(F.year(as_of_date(as_of)) - years, F.lit(1), F.lit(1))


def dated_rule(date_col: Column, cutover: dt.date, before: Column, after: Column) -> Column:
    """`before` holds for days before the cut-over, `after` from that day on."""
    day = F.lit(cutover)
    return ((date_col < day) & before) | ((date_col >= day) & after)
