"""Denormalised extracts of the warehouse."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.dims import route_names
from skyledger.operators.joins import lookup_join, measured_bytes
from skyledger.operators.keys import assign_ids
from skyledger.schemas import EXPORT_COLUMNS

_FACT_COLUMNS = [c for c in EXPORT_COLUMNS if not c.endswith("_name")]


def newest_first() -> list[Column]:
    """Latest departure first, unknown departures before all; the key decides ties."""
    return [F.desc_nulls_first("dep_scheduled"), F.asc("flight_key")]


def denormalize(
    fact: DataFrame, dim_airline: DataFrame, dim_route: DataFrame, dim_airport: DataFrame
) -> DataFrame:
    """The export frame, unsorted. The ids are unique, so the joins keep the row count."""
    rows = fact.select(*_FACT_COLUMNS, "airline_id", "route_id")
    airlines = dim_airline.select("airline_id", "airline_name")
    routes = route_names(dim_route, dim_airport)
    sizes = measured_bytes(airlines, routes)
    spread = ["flight_key"]
    named = lookup_join(rows, airlines, ["airline_id"], spread=spread, size=sizes[0])
    named = lookup_join(named, routes, ["route_id"], spread=spread, size=sizes[1])
    return named.select(EXPORT_COLUMNS)


def first_by_time(rows: DataFrame, time: str, limit: int, newest: bool) -> DataFrame:
    """Rows that include the first ``limit`` by a time, newest first with nulls before all, or
    oldest first: all rows up to the hour that completes the limit.

    Rows are counted per hour by a hash aggregate; one row per hour passes through one task. So
    a sort for the limit sees the rows it takes and those of one hour, not a limit from each
    partition of the table.
    """
    hour = F.date_trunc("hour", F.col(time)).alias("hour")
    counts = rows.groupBy(hour).agg(F.count(F.lit(1)).alias("n"))
    order = F.desc_nulls_first("hour") if newest else F.asc("hour")
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.select(
        "hour", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    ).where(F.col("before") < limit)
    last = needed.agg((F.min if newest else F.max)("hour")).scalar()
    if newest:
        return rows.where(F.col(time).isNull() | (F.col(time) >= last))
    return rows.where(F.date_trunc("hour", F.col(time)) <= last)


def full_extract(
    fact: DataFrame,
    dim_airline: DataFrame,
    dim_route: DataFrame,
    dim_airport: DataFrame,
    limit: int | None = None,
) -> DataFrame:
    """Export frame, newest departure first; ``limit`` keeps the first rows.

    With a limit the top rows are picked from the fact alone and only they meet the dimensions.
    """
    columns = [*_FACT_COLUMNS, "airline_id", "route_id"]
    rows = fact.select(columns)
    if limit is not None:
        rows = first_by_time(rows, "dep_scheduled", limit, newest=True)
        rows = rows.orderBy(*newest_first()).limit(limit)
    return denormalize(rows, dim_airline, dim_route, dim_airport).orderBy(*newest_first())


def stamp(value: datetime, data_type: T.DataType) -> Column:
    """Typed literal of a point in time; one without a zone is UTC."""
    aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    micros = (aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros)).cast(data_type)


def window_filter(
    fact: DataFrame, last: datetime | None, target: datetime, last_key: str | None = None
) -> DataFrame:
    """Rows with an ingest time in ``(last, target]``.

    ``last_key`` resumes inside ``last``: rows of that time with a greater key are included.
    A row stored later with an ingest time at or below ``last`` is not seen: see ``load_page``.
    """
    kind = fact.schema["ingest_time"].dataType
    ingest = F.col("ingest_time")
    rows = fact.where(ingest <= stamp(target, kind))
    if last is None:
        return rows
    after = ingest > stamp(last, kind)
    if last_key is not None:
        # the plain bound in front is what the file statistics can use
        same = (ingest == stamp(last, kind)) & (F.col("flight_key") > F.lit(last_key))
        return rows.where(ingest >= stamp(last, kind)).where(after | same)
    return rows.where(after)


def delta_page(
    fact: DataFrame,
    last: datetime | None,
    target: datetime,
    limit: int | None,
    last_key: str | None = None,
) -> DataFrame:
    """Next fact rows of the window in the order of ingest time and key."""
    rows = window_filter(fact, last, target, last_key)
    if limit is None:
        return rows
    rows = first_by_time(rows, "ingest_time", limit, newest=False)
    return rows.orderBy("ingest_time", "flight_key").limit(limit)


def load_page(
    fact: DataFrame,
    after: tuple[int, datetime | None, str | None] | None,
    target: int,
    limit: int | None,
) -> DataFrame:
    """Next fact rows up to the load ``target`` by load, ingest time and key, unsorted.

    With a limit the loads and hours before the one that completes it come whole; only the rows
    of that hour are numbered, by ``assign_ids``, which writes them to the shared folder.
    ``after`` is the load, time and key of the last row that is out; without a key all rows of
    its load are. A row stored late has the number of its load, whatever its ingest time: it
    comes out once. The plain bounds on ``load_id`` are what the file statistics can use.
    """
    load = F.col("load_id")
    rows = fact.where(load <= target)
    if after is not None:
        last, time, key = after
        if key is None:
            rows = rows.where(load > last)
        else:
            kind = fact.schema["ingest_time"].dataType
            place = F.struct(load, F.col("ingest_time"), F.col("flight_key"))
            rows = rows.where(load >= last).where(place > F.struct(
                F.lit(last).cast("long").alias("load_id"),
                stamp(time, kind).alias("ingest_time"), F.lit(key).alias("flight_key")))
    if limit is None:
        return rows
    # as first_by_time: loads and hours up to the one that completes the limit
    hour = F.date_trunc("hour", F.col("ingest_time")).alias("hour")
    counts = rows.groupBy("load_id", hour).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("load_id", "hour").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.select(
        F.struct("load_id", "hour").alias("at"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
    ).where(F.col("before") < limit)
    last = needed.agg(F.max(F.struct("at", "before")).alias("last")).select(
        "last.at", "last.before")
    at = F.struct("load_id", hour)
    whole = rows.where(at < last.select("at").scalar())
    # a page may be a third of the table: a limit would take all of it through one task
    cut = assign_ids(rows.where(at == last.select("at").scalar()), "_place",
                     ["load_id", "ingest_time", "flight_key"])
    room = F.lit(limit) - last.select("before").scalar()
    return whole.unionByName(cut.where(F.col("_place") <= room).drop("_place"))


def max_ingest(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("ingest_time").alias("max_ingest"))


def should_export(newest: Column, last: Column) -> Column:
    """Run on a first export of any rows, then only if something newer came in."""
    return newest.isNotNull() & (last.isNull() | (newest > last))
