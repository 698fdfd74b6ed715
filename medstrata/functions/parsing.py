"""Tolerant parsing: text that cannot be read becomes NULL and its row stays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import MapType, StringType

# --- fixed values -----------------------------------------------------------
DATE_PATTERN = "yyyy-MM-dd"
WITH_ZONE = "offset"
WITHOUT_ZONE = "naive"
# ----------------------------------------------------------------------------

# A time of day, with seconds or without, and behind it the zone that ends the text:
# the letter Z, or a sign with hours and perhaps minutes.
_TIME_WITH_ZONE = r"[0-9]:[0-5][0-9](?::[0-9]{2}(?:[.][0-9]+)?)? *(?:Z|[-+][0-9]{2}(?::?[0-9]{2})?)\z"


def date_of(text: Column | str, pattern: str | None = None) -> Column:
    """Calendar date of ``text`` (ISO form unless a pattern is given)."""
    column = F.col(text) if isinstance(text, str) else text
    if pattern is None:
        return column.try_cast("date")
    return F.try_to_date(column, pattern)


def instant_of(text: Column | str, pattern: str | None = None) -> Column:
    """UTC instant of ``text``; a written offset is honoured.

    Text without an offset is read in the session zone, which
    :func:`medstrata.session.pin_session` fixes to UTC.
    """
    column = F.col(text) if isinstance(text, str) else text
    if pattern is None:
        return column.try_cast("timestamp")
    return F.try_to_timestamp(column, F.lit(pattern))


def zone_provenance(text: Column | str) -> Column:
    """``offset`` when the text names a zone behind its time, else ``naive`` (also for NULL)."""
    column = F.col(text) if isinstance(text, str) else text
    return F.when(column.rlike(_TIME_WITH_ZONE), WITH_ZONE).otherwise(WITHOUT_ZONE)


def local_time(instant: Column | str, zone: str) -> Column:
    """Wall-clock time of a stored UTC instant in ``zone``, for reports only."""
    return F.from_utc_timestamp(instant, zone)


def text_map(json_text: Column | str) -> Column:
    """JSON object text as a map of strings; malformed text gives NULL."""
    return F.from_json(json_text, MapType(StringType(), StringType()))
