"""Event time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(text: Column | str) -> Column:
    """ISO-8601 text as a timestamp; unreadable text gives NULL, never an error."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def utc_hour(timestamp: Column) -> Column:
    """Hour of day in UTC, whatever the session time zone is."""
    return F.pmod(F.floor(F.unix_seconds(timestamp) / F.lit(3600)), F.lit(24)).cast("int")
