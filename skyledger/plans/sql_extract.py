"""Extracts that are defined by SQL text with named parameters over the warehouse's tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from skyledger.sources.connect import write_extract
from skyledger.sources.store import DIMENSIONS, Warehouse

# The rows of the delta extract by ingest time. Bind the times with a zone.
DELTA = """
SELECT f.flight_key, f.dep_scheduled, f.dep_actual, f.dep_delay_min, f.arr_scheduled,
       f.arr_estimated, f.arr_actual, f.arr_delay_min, f.status, a.airline_name,
       dep.airport_name AS dep_airport_name, arr.airport_name AS arr_airport_name,
       f.ingest_time
FROM fact f
LEFT JOIN dim_airline a ON a.airline_id = f.airline_id
LEFT JOIN dim_route r ON r.route_id = f.route_id
LEFT JOIN dim_airport dep ON dep.airport_id = r.dep_airport_id
LEFT JOIN dim_airport arr ON arr.airport_id = r.arr_airport_id
WHERE f.ingest_time BETWEEN :last AND :target
  AND (f.ingest_time > :last OR f.flight_key > :last_key)
ORDER BY f.ingest_time, f.flight_key
LIMIT :limit
"""


@contextmanager
def registered(tables: Mapping[str, DataFrame]) -> Iterator[None]:
    """The tables under their names in SQL, inside the block. Names taken by other temporary
    views are theirs again afterwards."""
    spark = next(iter(tables.values())).sparkSession
    taken = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    before = {name: spark.table(name) for name in tables if name in taken}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, table in before.items():
            table.createOrReplaceTempView(name)


def sql_extract(text: str, tables: Mapping[str, DataFrame], **parameters: object) -> DataFrame:
    """The rows of ``text`` over the named tables. Values are bound, never put into the text."""
    spark = next(iter(tables.values())).sparkSession
    with registered(tables):
        # resolved here; the views are not needed any more when the rows are read
        return spark.sql(text, args=parameters)


def warehouse_tables(house: Warehouse) -> dict[str, DataFrame]:
    load_id = house.load_id()
    return {"fact": house.fact(), **{n: house.dimension(n, load_id) for n in DIMENSIONS}}


def export_sql(
    spark: SparkSession, root: str, path: str, text: str, fmt: str = "csv", **parameters: object
) -> DataFrame:
    """Replace the extract at ``path`` by the rows of ``text`` over ``fact`` and the dimensions."""
    frame = sql_extract(text, warehouse_tables(Warehouse(spark, root)), **parameters)
    write_extract(frame, path, fmt)
    return frame
