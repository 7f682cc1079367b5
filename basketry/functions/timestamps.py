"""Timestamp parsing for the ISO-8601 UTC strings of the order source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the source format once 'T' and 'Z' are replaced by spaces and
# the string is trimmed. Exactly three fraction digits are required; other
# shapes parse to NULL.
ISO_UTC_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"


def parse_iso_utc(col: Column | str, pattern: str = ISO_UTC_PATTERN) -> Column:
    """``2021-03-04T05:06:07.089Z`` -> timestamp; unparsable -> NULL.

    ``try_to_timestamp`` keeps the non-ANSI behaviour (NULL instead of an
    error) that the original job relied on. The session zone must be UTC.
    """
    c = F.col(col) if isinstance(col, str) else col
    cleaned = F.trim(F.regexp_replace(c, "[TZ]", " "))
    return F.try_to_timestamp(cleaned, F.lit(pattern))


def time_of_day(ts: Column | str) -> Column:
    """Timestamp -> ``HH:mm:ss`` string (milliseconds dropped)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "HH:mm:ss")
