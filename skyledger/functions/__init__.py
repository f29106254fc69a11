"""Column expressions of the feed: times, codes and keys."""

from skyledger.functions.codes import clean_code, flight_identifier, flight_key
from skyledger.functions.times import (
    iso_utc,
    minutes_between,
    parse_date,
    parse_ingest_time,
    parse_iso,
    parse_schedule,
)

__all__ = [
    "clean_code", "flight_identifier", "flight_key", "iso_utc", "minutes_between",
    "parse_date", "parse_ingest_time", "parse_iso", "parse_schedule",
]
