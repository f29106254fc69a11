"""Codes and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_code(text: Column) -> Column:
    """Strip spaces; nothing left means null."""
    return F.nullif(F.trim(text), F.lit(""))


def flight_identifier(iata: Column, icao: Column, number: Column) -> Column:
    """First identifier that is present and not empty."""
    empty = F.lit("")
    return F.coalesce(F.nullif(iata, empty), F.nullif(icao, empty), F.nullif(number, empty))


def flight_key(iata: Column, icao: Column, number: Column, schedule: Column) -> Column:
    """``<identifier>_<departure time>``; null if either part is missing.

    The time is text as ``iso_utc`` gives it.
    """
    return F.concat(flight_identifier(iata, icao, number), F.lit("_"), schedule)
