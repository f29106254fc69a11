"""Extract jobs: the whole warehouse, or what loads have changed since the last export."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.export import denormalize, full_extract, load_page, newest_first
from skyledger.session import scratch_tables
from skyledger.sources.connect import write_extract
from skyledger.sources.files import Folder
from skyledger.sources.store import Warehouse


def _dimensions(house: Warehouse, load_id: int) -> list[DataFrame]:
    return [house.dimension(n, load_id) for n in ("dim_airline", "dim_route", "dim_airport")]


def checked_limit(limit: int | None) -> int | None:
    if limit is not None and limit < 1:
        raise ValueError("a limit is at least 1; None takes all rows")
    return limit


def export_full(
    spark: SparkSession, root: str, path: str, limit: int | None = None, fmt: str = "csv"
) -> int:
    """Replace the extract below ``path`` by all rows, or by the newest ``limit`` ones; returns
    their number.

    The rows go to ``path/export_id=<n>``, which is recorded when it is complete; the one before
    is deleted after that. A run that fails leaves the old extract. An empty warehouse writes
    nothing.
    """
    checked_limit(limit)
    house = Warehouse(spark, root)
    load_id = house.load_id()
    fact = house.fact()
    if fact.isEmpty():
        return 0
    last = house.last_export("full")
    number = last["export_id"] + 1 if last else 1
    counted = Observation()
    frame = full_extract(fact, *_dimensions(house, load_id), limit)
    write_extract(frame.observe(counted, F.count(F.lit(1)).alias("rows")),
                  f"{path}/export_id={number}", fmt)
    rows = counted.get["rows"]
    house.record_export("full", {
        "path": path, "rows": rows, "load_id": load_id, "ingest_time": None, "flight_key": None,
        "export_id": number})
    files = Folder(spark, path)
    for old in files.names("export_id=*"):
        if int(old.split("=")[1]) < number:
            files.delete(old)
    return rows


def export_delta(
    spark: SparkSession, root: str, path: str, limit: int | None = None, fmt: str = "csv"
) -> int:
    """Write the rows that loads have changed since the last export, or the next ``limit`` of
    them, to ``path/export_id=<n>``; returns their number.

    Rows are taken in the order of load, ingest time and key, up to the last load at the start.
    So a row that is loaded late, with a time before others that are out, is exported with its
    load; each state of a row comes out once at most. The record moves on after the files are
    complete: past the last load when all is out, else to the last row, from which the next call
    goes on.
    """
    checked_limit(limit)
    house = Warehouse(spark, root)
    target, last = house.load_id(), house.last_export("delta")
    if target == 0 or (last and last["flight_key"] is None and last["load_id"] >= target):
        return 0
    after = last and (last["load_id"], last["ingest_time"], last["flight_key"])
    number = last["export_id"] + 1 if last else 1
    with scratch_tables(spark):
        page = load_page(house.fact(), after, target, limit).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            end = page.agg(
                F.count(F.lit(1)).alias("rows"),
                F.max(F.struct("load_id", "ingest_time", "flight_key")).alias("last"),
            ).first()
            if end["rows"]:
                frame = denormalize(page, *_dimensions(house, target)).orderBy(*newest_first())
                write_extract(frame, f"{path}/export_id={number}", fmt)
        finally:
            page.unpersist()
    if limit is not None and end["rows"] == limit:
        place = end["last"].asDict()
    else:
        place = {"load_id": target, "ingest_time": None, "flight_key": None}
    house.record_export("delta", {
        "path": path, "rows": end["rows"], **place, "export_id": number})
    return end["rows"]
