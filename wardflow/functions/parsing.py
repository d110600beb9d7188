"""Strict ISO dates and timestamps.

The pattern fixes the accepted form and the cast checks the calendar. A cast parses a value in a
fraction of the time a format string takes, but on its own would also accept "2024" or "2024-1-5".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The only accepted forms, yyyy-MM-dd and yyyy-MM-dd HH:mm:ss.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}\z"
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"


def _strict(column: str, pattern: str, kind: str) -> Column:
    text = F.col(column).cast("string")
    return F.when(text.rlike(pattern), text.try_cast(kind))


def iso_date(column: str) -> Column:
    """The date, or NULL for anything that is not one."""
    return _strict(column, ISO_DATE, "date")


def iso_timestamp(column: str) -> Column:
    """The timestamp in the session time zone, or NULL for anything that is not one."""
    return _strict(column, ISO_TIMESTAMP, "timestamp")
