"""ISO-8601 text. All of it assumes the session time zone UTC, which `prepare` sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A full date, optionally with a time, a fraction and a zone.
ISO_PATTERN = r"^\d{4}-\d{2}-(0[1-9]|[12]\d|3[01])([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def iso_timestamp(text: Column) -> Column:
    """The instant of an ISO-8601 text, null when it is none. The pattern keeps out words such as 'yesterday'.

    A day beyond the end of its month runs on into the next one, so 2026-02-30 is the second of March.
    """
    # Spark wants a colon in the zone; only text it did not take gets one, and its day checked apart.
    normal = F.regexp_replace(text, r"(:.*[+-]\d{2})(\d{2})$", "$1:$2")
    first_day = F.regexp_replace(normal, r"^(\d{4}-\d{2})-\d{2}", "$1-01").try_cast("timestamp")
    day = F.substring(text, 9, 2).try_cast("int")
    run_on = F.when(day.between(1, 31), first_day + F.make_interval(days=day - 1))
    # The usual form is told by its separators, which is cheaper than the pattern; the cast sees to the digits.
    usual = text.endswith("Z") & (F.length(text).isin(20, 24))
    for position, mark in {5: "-", 8: "-", 11: "T", 14: ":", 17: ":"}.items():
        usual &= F.substring(text, position, 1) == mark
    usual &= F.substring(text, 20, 1).isin("Z", ".")
    return F.when(usual | text.rlike(ISO_PATTERN), F.coalesce(text.try_cast("timestamp"), run_on))


def iso_text(instant: Column) -> Column:
    """Millisecond ISO text in UTC: 2026-09-30T10:00:00.000Z."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def millis_to_iso(millis: Column) -> Column:
    return iso_text(F.timestamp_millis(millis))


def run_id(instant: Column) -> Column:
    """A run id that is safe in file names: the ISO text with ':' and '.' replaced by '-'."""
    return F.translate(iso_text(instant), ":.", "--")
