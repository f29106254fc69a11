"""Time parsing that never raises: text that does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.schemas import KEY_TIME_FORMAT_MICROS, SCHEDULE_SHAPE


def parse_schedule(text: Column) -> Column:
    """Whole-second ISO text with an offset, as in ``SCHEDULE_FORMAT``; a fraction gives null."""
    # parsing with a format raises an exception inside for each text that does not fit, which
    # is far slower than this test and the plain cast
    return F.try_to_timestamp(F.when(text.rlike(SCHEDULE_SHAPE), F.upper(text)))


def parse_iso(text: Column) -> Column:
    """Any ISO date-time; no offset means UTC, a time without a date gives null."""
    # a bare time of day would be completed with today's date
    dated = F.when(F.substring(text, 5, 1) == "-", text)
    return F.try_to_timestamp(dated)


def parse_ingest_time(text: Column) -> Column:
    """Schedule format or any other ISO form, as stamps carry microseconds."""
    return parse_iso(text)


def iso_utc(text: Column) -> Column:
    """ISO text at UTC with a numeric offset; a non-zero fraction is kept as microseconds."""
    stamp = F.date_format(parse_iso(text), KEY_TIME_FORMAT_MICROS)
    return F.replace(stamp, F.lit(".000000"), F.lit(""))


def parse_date(text: Column) -> Column:
    return F.try_to_date(text)


def minutes_between(later: Column, earlier: Column) -> Column:
    """Difference in minutes from whole seconds; null if either side is null."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60.0)
