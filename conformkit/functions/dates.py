"""Date helpers for business-date labels (DAT-1..4).

One ``run_date`` parameter drives both the slice written and the slice
replaced (D5); nothing reads the wall clock inside a job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label format the reference's configs and delete use.
LABEL_FORMAT = "dd-MMM-yyyy"


def _d(c: Column | str | dt.date) -> Column:
    if isinstance(c, dt.date):
        return F.lit(c)
    if isinstance(c, str):
        return F.col(c)
    return c


def as_date(c: Column | str) -> Column:
    """Timestamps (the test tables hold ``timestamp_ntz``) cast to a date before
    any date logic, so no session time zone is involved."""
    return _d(c).cast("date")


def date_label(c: Column | str | dt.date) -> Column:
    """``dd-MMM-yyyy`` text, e.g. ``05-Jan-2024`` (DAT-1)."""
    return F.date_format(_d(c), LABEL_FORMAT)


def previous_day(c: Column | str | dt.date) -> Column:
    """The day before (DAT-2).  Formatting and parsing back, as the reference's
    config does, gives the same value."""
    return F.date_sub(_d(c), 1)


def upper_label(c: Column | str | dt.date) -> Column:
    """``DD-MON-YYYY`` upper-case label, e.g. ``05-JAN-2024`` (DAT-3)."""
    return F.upper(date_label(c))


def parse_label(c: Column | str) -> Column:
    """Parse a ``dd-MMM-yyyy`` label, upper case accepted (DAT-4); a plain cast
    would not accept it."""
    return F.to_date(_d(c), LABEL_FORMAT)


def business_date(run_date: dt.date | str | None = None) -> dt.date:
    """The default business date: yesterday (the reference's local job)."""
    if run_date is None:
        return dt.date.today() - dt.timedelta(days=1)
    if isinstance(run_date, str):
        return dt.date.fromisoformat(run_date)
    return run_date
