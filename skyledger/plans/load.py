"""Warehouse load: staging batches to dimensions and fact."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.dims import (
    entity_sightings,
    merge_airlines,
    merge_airports,
    merge_routes,
    route_pairs,
)
from skyledger.operators.fact import FACT_INPUTS, enrich, latest_status
from skyledger.operators.joins import measured_bytes
from skyledger.operators.quality import duplicates, orphans
from skyledger.session import materialize, scratch_tables, together
from skyledger.sources.store import Batch, Warehouse


class ConstraintViolation(RuntimeError):
    """New tables break a uniqueness or reference rule; nothing was stored."""


def _violations(df: DataFrame, rule: str) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.to_json(F.struct("*")).alias("row"))


def _repeated(df: DataFrame, name: str, *keys: str) -> DataFrame:
    return _violations(duplicates(df, list(keys)), f"{name} is not unique on {', '.join(keys)}")


def dimension_violations(airline: DataFrame, airport: DataFrame, route: DataFrame) -> DataFrame:
    """Rows that break a rule of the dimensions: ``rule`` and the ``row`` as JSON."""
    parts = [
        _repeated(airline, "dim_airline", "airline_id"),
        _repeated(airline, "dim_airline", "iata"),
        _repeated(airport, "dim_airport", "airport_id"),
        _repeated(airport, "dim_airport", "iata"),
        _repeated(airport, "dim_airport", "icao"),
        _repeated(route, "dim_route", "route_id"),
        _repeated(route, "dim_route", "dep_airport_id", "arr_airport_id"),
    ]
    [size] = measured_bytes(airport.select("airport_id"))
    for end in ("dep_airport_id", "arr_airport_id"):
        lost = orphans(route, end, airport, "airport_id", ["route_id"], size)
        parts.append(_violations(lost, f"dim_route.{end} has no airport"))
    return reduce(DataFrame.unionAll, parts)


def fact_violations(rows: DataFrame, airline: DataFrame, route: DataFrame) -> DataFrame:
    """As ``dimension_violations``, for the fact."""
    sizes = measured_bytes(airline.select("airline_id"), route.select("route_id"))
    spread = ["flight_key"]
    columns = ["flight_key", "airline_id", "route_id"]
    rows = rows.select(columns)
    parts = [
        _repeated(rows, "fact", "flight_key"),
        _violations(
            orphans(rows, "airline_id", airline, "airline_id", spread, sizes[0]),
            "fact.airline_id has no airline",
        ),
        _violations(
            orphans(rows, "route_id", route, "route_id", spread, sizes[1]),
            "fact.route_id has no route",
        ),
    ]
    return reduce(DataFrame.unionAll, parts)


def require_none(violations: DataFrame) -> None:
    for row in violations.take(1):
        raise ConstraintViolation(f"{row['rule']}: {row['row']}")


@dataclass
class Prepared:
    """A load that is computed and checked: its dimensions are written, but count only when the
    load is recorded; its fact rows are not stored yet."""

    load_id: int
    batches: list[Batch]
    rows: DataFrame


def run_load(
    spark: SparkSession,
    root: str,
    icao_fallback: bool = False,
    newer_only: bool = False,
    check: bool = True,
    batches: list[Batch] | None = None,
) -> int:
    """Load all staged batches that no load has consumed, or those of ``batches``; returns the
    number of the last load.

    Batches that arrive meanwhile wait for the next load. A load that fails before it stores
    anything leaves all tables; one that fails while storing leaves some days of the fact
    upserted and is not recorded: the next load takes the same batches and more, and replaces
    what it wrote. Run one load at a time. ``newer_only`` keeps stored facts that are newer than
    the incoming ones. ``check`` verifies keys and references of dimensions and incoming facts
    before anything is stored.
    """
    house = Warehouse(spark, root)
    with scratch_tables(spark):
        prepared = prepare_load(house, icao_fallback, newer_only, check, batches)
        if prepared is not None:
            store_load(house, prepared)
    return house.load_id()


def prepare_load(
    house: Warehouse,
    icao_fallback: bool = False,
    newer_only: bool = False,
    check: bool = True,
    batches: list[Batch] | None = None,
) -> Prepared | None:
    """All of ``run_load`` that readers do not see; None if no batch is pending."""
    pending = house.pending_batches()
    if batches is not None:
        pending = [b for b in pending if b in set(batches)]
    if not pending:
        return None
    last = house.load_id()
    load_id = last + 1
    staging = house.staging(pending)

    # staging is columnar and read with few columns each time, which is cheaper than caching it
    seen = materialize(entity_sightings(staging))
    kind = F.col("kind")

    def write_airlines() -> DataFrame:
        known = house.dimension("dim_airline", last)
        merged = merge_airlines(known, seen.where(kind == "airline").drop("kind"))
        return house.write_snapshot("dim_airline", merged, load_id)

    def write_airports() -> DataFrame:
        merged, set_aside = merge_airports(
            house.dimension("dim_airport", last), seen.where(kind == "airport").drop("kind"))
        new = set_aside.distinct().exceptAll(house.quarantine(last))
        house.write_snapshot("quarantine", new, load_id)
        return house.write_snapshot("dim_airport", merged, load_id)

    airline, airport = together(house.spark, write_airlines, write_airports)
    routes = merge_routes(
        house.dimension("dim_route", last), route_pairs(staging, airport, icao_fallback))
    route = house.write_snapshot("dim_route", routes, load_id)

    def write_rows() -> DataFrame:
        latest = latest_status(staging.select(*FACT_INPUTS, "batch_id"))
        rows = materialize(enrich(latest, airline, route, airport, icao_fallback))
        rows = materialize(_not_older(house, rows)) if newer_only else rows
        if check:
            require_none(fact_violations(rows, airline, route))
        return rows

    def check_dimensions() -> None:
        if check:
            require_none(dimension_violations(airline, airport, route))

    rows, _ = together(house.spark, write_rows, check_dimensions)
    return Prepared(load_id, pending, rows)


def store_load(house: Warehouse, prepared: Prepared) -> None:
    """The fact rows, whose dimensions are there by now; the record of the load last."""
    house.upsert_fact(prepared.rows, prepared.load_id)
    house.record_load(prepared.load_id, prepared.batches)


def _not_older(house: Warehouse, incoming: DataFrame) -> DataFrame:
    """Incoming rows but those older than the stored row of their key."""
    day = house.day_of(F.col("flight_key"))
    # bounded by the calendar and the number of key buckets
    days = [r[0] for r in incoming.select(day).distinct().collect()]
    stored = house.fact(days).select("flight_key", F.col("ingest_time").alias("stored_time"))
    compared = incoming.join(
        stored.join(incoming.select("flight_key"), "flight_key", "left_semi"), "flight_key",
        "left")
    fresh = F.col("stored_time").isNull() | (F.col("ingest_time") >= F.col("stored_time"))
    return compared.where(fresh).select(incoming.columns)
