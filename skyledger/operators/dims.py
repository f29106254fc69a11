"""Airline, airport and route dimensions.

All merges work on sightings: distinct attribute tuples with the time last seen. They are as
small as the dimensions themselves however often the feed repeats them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import clean_code
from skyledger.operators.fold import latest_non_null, sightings
from skyledger.operators.keys import assign_ids, highest_id
from skyledger.operators.upsert import insert_missing, upsert_coalesce
from skyledger.schemas import DIM_AIRLINE, DIM_AIRPORT, DIM_ROUTE, QUARANTINE
from skyledger.session import materialize

_ENTITY = ["iata", "icao", "name"]


def _entity(kind: str, iata: str, icao: str, name: str) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        clean_code(F.col(iata)).alias("iata"),
        clean_code(F.col(icao)).alias("icao"),
        clean_code(F.col(name)).alias("name"),
    )


# kind, then the staging columns of the codes and the name
_AIRLINE = ("airline", "airline_iata", "airline_icao", "airline_name")
_DEPARTURE = ("airport", "dep_airport_iata", "dep_airport_icao", "dep_airport")
_ARRIVAL = ("airport", "arr_airport_iata", "arr_airport_icao", "arr_airport")


def _sighted(staging: DataFrame, parts: list[tuple[str, str, str, str]]) -> DataFrame:
    entities = F.array(*[_entity(*part) for part in parts])
    rows = staging.select(F.explode(entities).alias("e"), "ingest_time").select(
        "e.*", "ingest_time"
    )
    return sightings(rows, ["kind", *_ENTITY], "ingest_time")


def entity_sightings(staging: DataFrame) -> DataFrame:
    """All airlines and airports (``kind``) named in staging, in one scan.

    Airlines need a code or a name; airports need a code.
    """
    found = _sighted(staging, [_AIRLINE, _DEPARTURE, _ARRIVAL])
    coded = F.col("iata").isNotNull() | F.col("icao").isNotNull()
    named = (F.col("kind") == "airline") & F.col("name").isNotNull()
    return found.where(coded | named)


def airline_candidates(staging: DataFrame) -> DataFrame:
    """Distinct clean airline triples with at least one value."""
    found = _sighted(staging, [_AIRLINE])
    present = F.coalesce("iata", "icao", "name").isNotNull()
    return found.where(present).select("iata", "icao", F.col("name").alias("airline_name"))


def airport_candidates(staging: DataFrame, code: str = "iata") -> DataFrame:
    """Distinct clean airport triples of departures and arrivals that have the code."""
    found = _sighted(staging, [_DEPARTURE, _ARRIVAL]).where(F.col(code).isNotNull())
    return found.select("iata", "icao", F.col("name").alias("airport_name"))


def unknown_airports(candidates: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Candidates whose IATA code no airport has; a null code is unknown."""
    return insert_missing(dim_airport, candidates, ["iata"])


def _with_ids(pool: DataFrame, dim: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Number the rows that have no id yet; ids given before never change."""
    new = assign_ids(
        pool.where(F.col(column).isNull()).drop(column), column, order, highest_id(dim, column)
    )
    return pool.where(F.col(column).isNotNull()).unionByName(new)


def merge_airlines(dim: DataFrame, seen: DataFrame) -> DataFrame:
    """New state of ``dim_airline`` after the sightings of airlines.

    With an IATA code: upsert on it, keeping old values where the new are null. With an ICAO
    code only: no change if a row with an IATA code carries that ICAO code, else an upsert of
    the row known by ICAO. With a name only: inserted if no row has the name.
    """
    seen = seen.withColumnRenamed("name", "airline_name")
    iata, icao = F.col("iata"), F.col("icao")

    by_iata = latest_non_null(seen, "iata", ["icao", "airline_name"], "seen")
    # read by each of the steps below
    pool = materialize(upsert_coalesce(dim, by_iata, ["iata"], ["icao", "airline_name"]))

    by_icao = latest_non_null(
        seen.where(iata.isNull()), "icao", ["airline_name"], "seen"
    )
    by_icao = insert_missing(pool.where(iata.isNotNull()), by_icao, ["icao"])
    known_by_icao = iata.isNull() & icao.isNotNull()
    merged = upsert_coalesce(
        pool.where(known_by_icao), by_icao, ["icao"], ["airline_name"]
    )
    pool = pool.where(~known_by_icao).unionByName(merged)

    by_name = seen.where(iata.isNull() & icao.isNull()).select("airline_name").distinct()
    by_name = insert_missing(pool, by_name, ["airline_name"])
    pool = pool.unionByName(by_name, allowMissingColumns=True)
    return _with_ids(pool, dim, "airline_id", ["iata", "icao", "airline_name"]).select(
        DIM_AIRLINE.fieldNames()
    )


def resolve_airports(dim: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Airports sighted with an IATA code, as ``(accepted, quarantined)``.

    ``airport_id`` of an accepted row is the stored row it updates: the one with its IATA code,
    else one without an IATA code that has its ICAO code; null means a new airport. Set aside
    is a row whose ICAO code belongs to another airport, stored or claimed in this load: an
    ICAO code goes to the lowest stored id that claims it, then to the first IATA code.
    """
    found = latest_non_null(seen, "iata", ["icao", "airport_name"], "seen")
    by_iata = dim.where(F.col("iata").isNotNull()).select(
        "iata", F.col("airport_id").alias("own_id")
    )
    by_icao = dim.where(F.col("icao").isNotNull()).select(
        "icao", F.col("airport_id").alias("holder_id"), F.col("iata").alias("holder_iata")
    )
    linked = found.join(by_iata, "iata", "left").join(by_icao, "icao", "left")
    adopts = F.col("own_id").isNull() & F.col("holder_iata").isNull()
    conflict = F.col("holder_id").isNotNull() & ~(
        F.col("own_id").eqNullSafe(F.col("holder_id")) | adopts
    )
    linked = materialize(
        linked.select(
            F.when(adopts, F.col("holder_id")).otherwise(F.col("own_id")).alias("airport_id"),
            "iata", "icao", "airport_name", conflict.alias("conflict"),
        )
    )
    claim = F.struct(F.col("airport_id").isNull().alias("fresh"), "airport_id", "iata")
    first = (
        linked.where(~F.col("conflict") & F.col("icao").isNotNull())
        .groupBy("icao")
        .agg(F.min(claim)["iata"].alias("first_iata"))
    )
    judged = linked.join(first, "icao", "left").withColumn(
        "conflict", F.col("conflict") | (F.col("first_iata") != F.col("iata"))
    )
    lost = F.coalesce("conflict", F.lit(False))
    accepted = judged.where(~lost).select(DIM_AIRPORT.fieldNames())
    quarantined = judged.where(lost).select(
        "iata", "icao", "airport_name", F.lit("icao_conflict").alias("reason")
    )
    return accepted, quarantined.select(QUARANTINE.fieldNames())


def merge_airports_by_iata(dim: DataFrame, accepted: DataFrame) -> DataFrame:
    """Pool of stored airports with accepted updates applied, and new ones without an id."""
    updates = accepted.where(F.col("airport_id").isNotNull())
    # an adopted airport takes its IATA code along, hence the match on the id
    pool = upsert_coalesce(dim, updates, ["airport_id"], ["iata", "icao", "airport_name"])
    return pool.unionByName(accepted.where(F.col("airport_id").isNull()))


def merge_airports_by_icao(pool: DataFrame, seen: DataFrame) -> DataFrame:
    """Pool after the sightings without an IATA code, matched on ICAO."""
    by_icao = latest_non_null(
        seen.where(F.col("iata").isNull()), "icao", ["airport_name"], "seen"
    )
    return upsert_coalesce(pool, by_icao, ["icao"], ["airport_name"])


def merge_airports(dim: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New state of ``dim_airport`` after the sightings of airports, and the rows set aside."""
    seen = seen.withColumnRenamed("name", "airport_name")
    accepted, quarantined = resolve_airports(dim, seen)
    pool = merge_airports_by_icao(merge_airports_by_iata(dim, accepted), seen)
    merged = _with_ids(pool, dim, "airport_id", ["iata", "icao"])
    return merged.select(DIM_AIRPORT.fieldNames()), quarantined


def airport_codes(dim_airport: DataFrame, icao_fallback: bool = False) -> DataFrame:
    """Code to airport id. With the fallback each ICAO code leads to its airport too."""
    iata = dim_airport.select(
        F.concat(F.lit("iata:"), F.col("iata")).alias("code"), "airport_id", "airport_name"
    )
    if not icao_fallback:
        return iata.where(F.col("code").isNotNull())
    icao = dim_airport.select(
        F.concat(F.lit("icao:"), F.col("icao")).alias("code"), "airport_id", "airport_name"
    )
    return iata.unionByName(icao).where(F.col("code").isNotNull())


def end_code(side: str, icao_fallback: bool = False) -> Column:
    """Clean code of a staging row's departure or arrival, as in ``airport_codes``."""
    iata = F.concat(F.lit("iata:"), clean_code(F.col(f"{side}_airport_iata")))
    if not icao_fallback:
        return iata
    return F.coalesce(iata, F.concat(F.lit("icao:"), clean_code(F.col(f"{side}_airport_icao"))))


def route_pairs(
    staging: DataFrame, dim_airport: DataFrame, icao_fallback: bool = False
) -> DataFrame:
    """Distinct pairs of airport ids flown in staging.

    Code pairs are made distinct first, so the joins see routes instead of flights.
    """
    flown = (
        staging.select(
            end_code("dep", icao_fallback).alias("dep_code"),
            end_code("arr", icao_fallback).alias("arr_code"),
        )
        .where(F.col("dep_code").isNotNull() & F.col("arr_code").isNotNull())
        .distinct()
    )
    codes = airport_codes(dim_airport, icao_fallback).drop("airport_name")
    departures = codes.toDF("dep_code", "dep_airport_id")
    arrivals = codes.toDF("arr_code", "arr_airport_id")
    return (
        flown.join(departures, "dep_code")
        .join(arrivals, "arr_code")
        .select("dep_airport_id", "arr_airport_id")
        .distinct()
    )


def merge_routes(dim: DataFrame, pairs: DataFrame) -> DataFrame:
    """New state of ``dim_route``: unknown pairs are added, known ones untouched."""
    ends = ["dep_airport_id", "arr_airport_id"]
    new = assign_ids(
        insert_missing(dim, pairs, ends), "route_id", ends, highest_id(dim, "route_id")
    )
    return dim.select(DIM_ROUTE.fieldNames()).unionByName(new.select(DIM_ROUTE.fieldNames()))


def route_lookup(
    dim_route: DataFrame, dim_airport: DataFrame, icao_fallback: bool = False
) -> DataFrame:
    """Pair of end codes to route id."""
    codes = airport_codes(dim_airport, icao_fallback).drop("airport_name")
    return (
        dim_route.join(codes.toDF("dep_code", "dep_airport_id"), "dep_airport_id")
        .join(codes.toDF("arr_code", "arr_airport_id"), "arr_airport_id")
        .select("dep_code", "arr_code", "route_id")
    )


def route_names(dim_route: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Route id to the names of its airports."""
    names = dim_airport.select("airport_id", "airport_name")
    return (
        dim_route.join(names.toDF("dep_airport_id", "dep_airport_name"), "dep_airport_id", "left")
        .join(names.toDF("arr_airport_id", "arr_airport_name"), "arr_airport_id", "left")
        .select("route_id", "dep_airport_name", "arr_airport_name")
    )
