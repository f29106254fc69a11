"""Staging rows to fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import clean_code
from skyledger.operators.dims import end_code, route_lookup
from skyledger.operators.fold import latest_per_key
from skyledger.operators.joins import lookup_join, measured_bytes
from skyledger.schemas import FACT, TIMELINE

FACT_INPUTS = [
    "flight_key", "flight_date", "status", "ingest_time", "flight_number", "flight_iata",
    "flight_icao", "airline_iata", "dep_airport_iata", "dep_airport_icao", "arr_airport_iata",
    "arr_airport_icao", *TIMELINE,
]


def latest_status(staging: DataFrame) -> DataFrame:
    """Last row per flight by ingest time, batch, then the row itself."""
    order = [c for c in ("ingest_time", "batch_id") if c in staging.columns]
    return latest_per_key(staging, ["flight_key"], order)


def enrich(
    staging: DataFrame,
    dim_airline: DataFrame,
    dim_route: DataFrame,
    dim_airport: DataFrame,
    icao_fallback: bool = False,
) -> DataFrame:
    """Fact rows: staging rows with the ids of their airline and route, null where unknown.

    The route table is joined with its airports first, which leaves two joins on the large
    side instead of four. Dimensions must be stored tables.
    """
    coded = staging.withColumns(
        {
            "airline_code": clean_code(F.col("airline_iata")),
            "dep_code": end_code("dep", icao_fallback),
            "arr_code": end_code("arr", icao_fallback),
        }
    )
    airlines = dim_airline.where(F.col("iata").isNotNull()).select(
        F.col("iata").alias("airline_code"), "airline_id"
    )
    routes = route_lookup(dim_route, dim_airport, icao_fallback)
    sizes = measured_bytes(airlines, routes)
    spread = ["flight_key"]
    with_airline = lookup_join(coded, airlines, ["airline_code"], spread=spread, size=sizes[0])
    with_route = lookup_join(
        with_airline, routes, ["dep_code", "arr_code"], spread=spread, size=sizes[1]
    )
    return with_route.select(FACT.fieldNames())


# Days outside of this range are no departures: such keys are stored like those without a day,
# so text in messages makes no more than these days.
FIRST_DAY, LAST_DAY = "1950-01-01", "2099-12-31"
KEY_BUCKETS = 64


def key_day(key: Column, buckets: int = KEY_BUCKETS) -> Column:
    """Storage partition of a flight key: the departure day it ends with.

    It depends on the key alone, so an update always finds the stored row in its own partition,
    also when the flight moves to another date. Keys of another form are spread over buckets.
    """
    day = F.substring(F.substring_index(key, "_", -1), 1, 10)
    parsed = F.try_to_date(day, "yyyy-MM-dd").cast("string")
    known = F.when(parsed.between(FIRST_DAY, LAST_DAY), parsed)
    bucket = F.concat(F.lit("key-"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"))
    return F.coalesce(known, bucket)
