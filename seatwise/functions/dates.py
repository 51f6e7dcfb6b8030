"""Days held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: month-day-year, one or two digits for month and day.
DAY_PATTERN = "M-d-yyyy"


def parse_day(text: Column, on_bad_date: str = "raise") -> Column:
    """The day as DATE; other text fails the query, or gives NULL when asked to."""
    if on_bad_date == "raise":
        # No time zone is involved, so the session's zone cannot shift the day.
        return F.to_timestamp_ntz(text, F.lit(DAY_PATTERN)).cast("date")
    if on_bad_date == "null":
        return F.try_to_date(text, DAY_PATTERN)
    raise ValueError(f"on_bad_date must be 'raise' or 'null', not {on_bad_date!r}")


def is_bad_day(text: Column) -> Column:
    return text.isNotNull() & F.try_to_date(text, DAY_PATTERN).isNull()
