"""The operators and jobs over the given tables, one query each."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.catalog.adapters import (
    event_envelopes,
    event_pages,
    order_staging,
    portable,
    table,
)
from skyledger.functions import (
    clean_code,
    iso_utc,
    minutes_between,
    parse_date,
    parse_ingest_time,
    parse_schedule,
)
from skyledger.operators import dims, export
from skyledger.operators.decode import decode
from skyledger.operators.fact import enrich, latest_status
from skyledger.operators.fold import latest_non_null
from skyledger.operators.keys import assign_ids
from skyledger.operators.normalize import (
    encode_envelopes,
    explode_pages,
    normalize_records,
    parse_pages,
    split_keyed,
)
from skyledger.operators.quality import (
    duplicates,
    orphans,
    split_rejects,
    touched_rows,
    unreferenced,
    with_reject_reason,
)
from skyledger.operators.upsert import upsert_coalesce, upsert_overwrite
from skyledger.plans.export import export_delta as export_delta_job
from skyledger.plans.export import export_full as export_full_job
from skyledger.plans.load import prepare_load, run_load
from skyledger.plans.normalize import messages as messages_of
from skyledger.plans.normalize import normalize_pages
from skyledger.plans.sql_extract import DELTA, sql_extract
from skyledger.schemas import (
    DIM_AIRLINE,
    DIM_AIRPORT,
    DIM_ROUTE,
    EXPORT_COLUMNS,
    STAGED,
    STAGING,
)
from skyledger.session import (
    configure,
    materialize,
    runtime_filters,
    scratch_dir,
    scratch_tables,
    together,
)
from skyledger.sources.bucketed import BucketedTable
from skyledger.sources.connect import read_messages
from skyledger.sources.store import Warehouse, replace_partitions
from skyledger.streaming.ingest import loading_sink, staging_sink, start_ingest
from skyledger.streaming.metrics import BatchCounts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EXPORT_LIMIT = 1000
PAGE_LIMIT = 500
DELTA_LAST = datetime(1997, 1, 1)
DELTA_LAST_KEY = "C5"
DELTA_TARGET = datetime(1999, 1, 1)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(function(configure(spark), sf_dir))

    QUERIES[function.__name__] = run
    return function


# decode and normalise --------------------------------------------------------------------


@query
def envelope_roundtrip(spark, sf_dir):
    messages = encode_envelopes(event_envelopes(spark, sf_dir))
    good, _ = split_rejects(decode(messages))
    return good.select(STAGED.fieldNames())


@query
def staging_project(spark, sf_dir):
    pages = parse_pages(event_pages(spark, sf_dir))
    outcomes = normalize_pages(pages, F.lit("2024-02-01 00:00:00.5").cast("timestamp"))
    good, _ = split_rejects(decode(messages_of(outcomes)))
    return good.select(STAGING.fieldNames())


@query
def page_rejects(spark, sf_dir):
    """Pages of errors are cut off, delays of signups are text: every outcome, as decoded."""
    page = F.col("value").cast("string")
    broken = F.when(page.contains('"flight_status":"error"'),
                    F.substr(page, F.lit(1), F.length(page) - 3)).when(
        page.contains('"flight_status":"signup"'),
        F.regexp_replace(page, r'"delay":(-?\d+)', '"delay":"$1 min"'),
    ).otherwise(page)
    outcomes = materialize(normalize_pages(
        parse_pages(event_pages(spark, sf_dir).select(broken.alias("value")))))
    decoded = decode(messages_of(outcomes)).select(
        F.lit("keyed").alias("outcome"), "flight_key", "partial_parse", "dep_delay_min")
    lost = outcomes.where(F.col("outcome") != "keyed").select(
        "outcome", F.col("key").cast("string").alias("flight_key"),
        F.coalesce("partial_parse", F.lit(False)).alias("partial_parse"),
        F.lit(None).cast("double").alias("dep_delay_min"))
    return decoded.unionByName(lost)


@query
def default_ingest(spark, sf_dir):
    """Messages of views lack the ingest time; the default stands in."""
    envelopes = event_envelopes(spark, sf_dir)
    stamped = F.when(F.col("status") != "view", F.col("ingest_time"))
    messages = encode_envelopes(envelopes.withColumn("ingest_time", stamped))
    arrived = F.lit("2024-02-01").cast("timestamp")
    good, _ = split_rejects(decode(messages, default_ingest=arrived))
    return good.select("flight_key", "flight_number", "ingest_time")


@query
def ts_parse(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    micros = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    seconds = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX")
    east = F.concat(
        F.date_format(F.col("ts") + F.expr("INTERVAL 9 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit("+09:00"),
    )
    return e.select(
        "event_id",
        parse_schedule(micros).alias("schedule_micros"),
        parse_schedule(seconds).alias("schedule_seconds"),
        parse_ingest_time(micros).alias("ingest_micros"),
        parse_ingest_time(seconds).alias("ingest_seconds"),
        parse_ingest_time(F.col("event_type")).alias("ingest_other"),
        iso_utc(east).alias("iso_east"),
        iso_utc(micros).alias("iso_micros"),
        iso_utc(F.lit("")).alias("iso_empty"),
    )


@query
def date_parse(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        parse_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("from_date"),
        parse_date(F.col("o_orderpriority")).alias("from_other"),
    )


@query
def eta_delta(spark, sf_dir):
    return order_staging(spark, sf_dir).select(
        "flight_number",
        minutes_between(F.col("arr_estimated"), F.col("arr_scheduled")).alias("arr_eta_delta_min"),
    )


@query
def code_clean(spark, sf_dir):
    codes = ["airline_iata", "airline_icao", "airline_name", "dep_airport_iata",
             "arr_airport_iata"]
    return order_staging(spark, sf_dir).select(
        "flight_number", *[clean_code(F.col(c)).alias(c) for c in codes]
    )


@query
def page_explode(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    record = F.struct(
        F.col("role").alias("flight_status"),
        F.struct(F.col("conv_id").cast("string").alias("number")).alias("flight"),
        F.struct(F.col("text").alias("airport"), F.col("turn").alias("delay")).alias("departure"),
    )
    pages = turns.select(F.to_json(F.struct(F.array(record).alias("data"))).alias("value"))
    return explode_pages(parse_pages(pages), "assistant").select(
        F.col("flight_status").alias("role"),
        F.col("flight.number").alias("conv_id"),
        F.col("departure.delay").alias("turn"),
        F.col("departure.airport").alias("text"),
    )


@query
def page_normalize(spark, sf_dir):
    records = explode_pages(parse_pages(event_pages(spark, sf_dir)), None)
    stamp = F.lit("2024-02-01 00:00:00.5").cast("timestamp")
    return normalize_records(records, stamp).select(
        "flight_key", "flight_date", "status",
        F.col("airline.name").alias("airline_name"),
        F.col("flight.number").alias("flight_number"),
        F.col("departure.iata").alias("dep_iata"),
        F.col("departure.gate").alias("dep_gate"),
        F.col("departure.schedule").alias("dep_schedule"),
        F.col("departure.estimated").alias("dep_estimated"),
        F.col("departure.actual").alias("dep_actual"),
        F.col("departure.delay_min").alias("dep_delay_min"),
        F.col("arrival.schedule").alias("arr_schedule"),
        "ingest_time", "source",
    )


@query
def flight_key(spark, sf_dir):
    records = explode_pages(parse_pages(event_pages(spark, sf_dir)))
    keyed, unkeyed = split_keyed(normalize_records(records))
    return (
        keyed.withColumn("outcome", F.lit("keyed"))
        .unionByName(unkeyed.withColumn("outcome", F.lit("flight_key")))
        .select("flight_key", F.col("departure.schedule").alias("departs"), "outcome")
    )


# quality ---------------------------------------------------------------------------------


@query
def dq_split(spark, sf_dir):
    rows = order_staging(spark, sf_dir)
    late = F.col("status") == "P"
    urgent = F.col("dep_terminal") == "1-URGENT"
    rows = rows.withColumns(
        {
            "flight_key": F.when(~(late & urgent), F.col("flight_key")),
            "ingest_time": F.when(~(late & ~urgent), F.col("ingest_time")),
            "arr_delay_min": F.datediff("dep_actual", "dep_estimated").cast("double"),
        }
    )
    good, rejected = split_rejects(with_reject_reason(rows))
    return good.withColumn("reject_reason", F.lit("none")).unionByName(rejected).select(
        "flight_number", "reject_reason"
    )


@query
def dq_duplicates(spark, sf_dir):
    return duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_orphans(spark, sf_dir):
    """Orders of low priority refer to customers that are not there."""
    customers = table(spark, sf_dir, "customer")
    low = F.col("o_orderpriority") == "5-LOW"
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(low, -F.col("o_custkey")).otherwise(F.col("o_custkey")))
    return orphans(orders, "o_custkey", customers, "c_custkey", ["o_orderkey"]).select(
        "o_orderkey", "o_custkey"
    )


def _as_at_scale(spark: SparkSession) -> SparkSession:
    """A session of its own where no side is small enough to broadcast, and filters are used."""
    own = configure(spark.newSession())
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return runtime_filters(own, scan_bytes="1k")


@query
def dq_touched_lines(spark, sf_dir):
    """Line items of the orders of one month, by a Bloom filter of their keys in the scan."""
    spark = _as_at_scale(spark)
    day = F.col("o_orderdate")
    month = table(spark, sf_dir, "orders").where(
        (day >= F.lit("1997-03-01").cast("date")) & (day < F.lit("1997-04-01").cast("date")))
    lines = table(spark, sf_dir, "lineitem")
    return touched_rows(lines, month, "l_orderkey", "o_orderkey").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


@query
def dq_lost_lines(spark, sf_dir):
    """Line items of a month whose order is not there: the orders of one priority are left out."""
    spark = _as_at_scale(spark)
    day = F.col("l_shipdate")
    lines = table(spark, sf_dir, "lineitem").where(
        (day >= F.lit("1997-03-01").cast("date")) & (day < F.lit("1997-04-01").cast("date")))
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") != "5-LOW")
    return unreferenced(lines, "l_orderkey", orders, "o_orderkey").select(
        "l_orderkey", "l_linenumber")


# folding and keys ------------------------------------------------------------------------


@query
def latest_per_flight(spark, sf_dir):
    """Messages decoded, then the latest status per flight."""
    messages = encode_envelopes(event_envelopes(spark, sf_dir))
    good, _ = split_rejects(decode(messages))
    return latest_status(good).select(
        "flight_key", "status", "ingest_time", "flight_number", "airline_name", "dep_delay_min"
    )


@query
def latest_per_key(spark, sf_dir):
    return latest_status(order_staging(spark, sf_dir))


def _clean_airlines(rows: DataFrame) -> DataFrame:
    return rows.select(
        clean_code(F.col("airline_iata")).alias("iata"),
        clean_code(F.col("airline_icao")).alias("icao"),
        clean_code(F.col("airline_name")).alias("airline_name"),
        "ingest_time", "batch_id",
    )


@query
def dim_fold(spark, sf_dir):
    rows = _clean_airlines(order_staging(spark, sf_dir))
    return latest_non_null(rows, "iata", ["icao", "airline_name"], "ingest_time")


@query
def dim_candidates(spark, sf_dir):
    return dims.airline_candidates(order_staging(spark, sf_dir))


@query
def surrogate_keys(spark, sf_dir):
    flights = order_staging(spark, sf_dir).select("flight_key").distinct()
    return assign_ids(flights, "flight_id", ["flight_key"], start=1000)


# dimensions ------------------------------------------------------------------------------


@query
def dim_upsert_coalesce(spark, sf_dir):
    rows = _clean_airlines(order_staging(spark, sf_dir))
    attributes = ["icao", "airline_name"]
    first = latest_non_null(rows.where("batch_id = 1"), "iata", attributes, "ingest_time")
    second = latest_non_null(rows.where("batch_id = 2"), "iata", attributes, "ingest_time")
    target = assign_ids(first, "airline_id", ["iata"])
    return upsert_coalesce(target, second, ["iata"], attributes)


@query
def airport_union(spark, sf_dir):
    return dims.airport_candidates(order_staging(spark, sf_dir), "iata")


@query
def airport_icao_anti(spark, sf_dir):
    rows = order_staging(spark, sf_dir)
    known = dims.airport_candidates(rows.where("batch_id = 1"), "iata")
    return dims.unknown_airports(dims.airport_candidates(rows, "icao"), known)


def _seen(staging: DataFrame, batch: int, kind: str) -> DataFrame:
    rows = staging.where(F.col("batch_id") == batch)
    return materialize(dims.entity_sightings(rows).where(F.col("kind") == kind).drop("kind"))


def _no_rows(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


@query
def dim_airline_merge(spark, sf_dir):
    staging = materialize(order_staging(spark, sf_dir))
    dim = _no_rows(spark, DIM_AIRLINE)
    for batch in (1, 2):
        dim = materialize(dims.merge_airlines(dim, _seen(staging, batch, "airline")))
    return dim


def _first_airports(spark: SparkSession, staging: DataFrame) -> DataFrame:
    dim, _ = dims.merge_airports(_no_rows(spark, DIM_AIRPORT), _seen(staging, 1, "airport"))
    return materialize(dim)


@query
def airport_upsert_iata(spark, sf_dir):
    staging = materialize(order_staging(spark, sf_dir))
    dim = _first_airports(spark, staging)
    seen = _seen(staging, 2, "airport").withColumnRenamed("name", "airport_name")
    accepted, _ = dims.resolve_airports(dim, seen)
    return dims.merge_airports_by_iata(dim, accepted)


@query
def airport_upsert_icao(spark, sf_dir):
    staging = materialize(order_staging(spark, sf_dir))
    dim = _first_airports(spark, staging)
    return dims.merge_airports(dim, _seen(staging, 2, "airport"))[0]


@query
def airport_quarantine(spark, sf_dir):
    """Airports set aside by two loads, after old snapshots are gone."""
    house = _loaded(spark, sf_dir, (1, 2))
    house.drop_old_snapshots(keep=1)
    return house.quarantine()


def _airports(rows: DataFrame) -> DataFrame:
    """Airports with an IATA code, by the order of the code."""
    found = dims.airport_candidates(rows, "iata")
    one = found.groupBy("iata").agg(
        F.max("icao").alias("icao"), F.max("airport_name").alias("airport_name")
    )
    return assign_ids(one, "airport_id", ["iata"])


def _airlines(rows: DataFrame) -> DataFrame:
    one = latest_non_null(_clean_airlines(rows), "iata", ["icao", "airline_name"], "ingest_time")
    return assign_ids(one, "airline_id", ["iata"])


@query
def route_pairs(spark, sf_dir):
    staging = materialize(order_staging(spark, sf_dir))
    return dims.route_pairs(staging, _airports(staging))


@query
def route_insert_ignore(spark, sf_dir):
    staging = materialize(order_staging(spark, sf_dir))
    airports = materialize(_airports(staging))
    routes = _no_rows(spark, DIM_ROUTE)
    for batch in (1, 2):
        pairs = dims.route_pairs(staging.where(F.col("batch_id") == batch), airports)
        routes = dims.merge_routes(routes, pairs)
    return routes


# fact ------------------------------------------------------------------------------------


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Staging and dimensions of one load, with plain airport matching."""
    staging = materialize(order_staging(spark, sf_dir))
    airports, airlines = together(
        spark, lambda: materialize(_airports(staging)), lambda: materialize(_airlines(staging))
    )
    pairs = dims.route_pairs(staging, airports)
    routes = materialize(dims.merge_routes(_no_rows(spark, DIM_ROUTE), pairs))
    return staging, airlines, routes, airports


@query
def fact_enrich(spark, sf_dir):
    staging, airlines, routes, airports = _star(spark, sf_dir)
    numbered = staging.withColumn("flight_key", F.col("flight_number"))
    return enrich(numbered, airlines, routes, airports).select(
        "flight_key", "airline_id", "route_id"
    )


@query
def fact_enrich_icao(spark, sf_dir):
    """As ``fact_enrich``, with routes for airports known by ICAO code only."""
    staging = materialize(order_staging(spark, sf_dir))
    codes = dims.airport_candidates(staging, "icao").groupBy("icao").agg(
        F.max("iata").alias("iata"), F.max("airport_name").alias("airport_name")
    )
    airports = materialize(assign_ids(codes, "airport_id", ["icao"]))
    pairs = dims.route_pairs(staging, airports, icao_fallback=True)
    routes = materialize(dims.merge_routes(_no_rows(spark, DIM_ROUTE), pairs))
    numbered = staging.withColumn("flight_key", F.col("flight_number"))
    airlines = materialize(_airlines(staging))
    return enrich(numbered, airlines, routes, airports, icao_fallback=True).select(
        "flight_key", "airline_id", "route_id"
    )


_FACT_LIKE = ["flight_key", "flight_date", "status", "ingest_time", "flight_number", "dep_actual",
              "dep_delay_min", "arr_actual"]


@query
def fact_upsert(spark, sf_dir):
    rows = order_staging(spark, sf_dir).select(*_FACT_LIKE, "batch_id")
    target = latest_status(rows.where("batch_id = 1")).drop("batch_id")
    source = latest_status(rows.where("batch_id = 2")).drop("batch_id")
    return upsert_overwrite(target, source, ["flight_key"])


@query
def fact_upsert_newer_only(spark, sf_dir):
    """The loads in reverse: rows of the first load are older than what is stored."""
    rows = order_staging(spark, sf_dir).select(*_FACT_LIKE, "batch_id")
    target = latest_status(rows.where("batch_id = 2")).drop("batch_id")
    source = latest_status(rows.where("batch_id = 1")).drop("batch_id")
    return upsert_overwrite(target, source, ["flight_key"], newer_only="ingest_time")


@query
def bucketed_upsert(spark, sf_dir):
    """As ``fact_upsert``, into a table bucketed by flight key; then its keys are checked."""
    rows = order_staging(spark, sf_dir).select(*_FACT_LIKE, "batch_id")
    fact = BucketedTable(spark, f"fact_{uuid.uuid4().hex}", scratch_dir(spark, "bucketed"),
                         "flight_key", buckets=8)
    fact.write(latest_status(rows.where("batch_id = 1")).drop("batch_id"), 1)
    fact.upsert(1, latest_status(rows.where("batch_id = 2")).drop("batch_id"))
    fact.drop(1)
    return fact.read(2).join(fact.repeated(2), "flight_key", "left_anti")


# export ----------------------------------------------------------------------------------


@query
def max_ingest(spark, sf_dir):
    return export.max_ingest(order_staging(spark, sf_dir))


@query
def export_gate(spark, sf_dir):
    newest = F.col("max_ingest")
    none = F.lit(None).cast("timestamp")
    early = F.lit("1996-01-01").cast("timestamp")
    return export.max_ingest(order_staging(spark, sf_dir)).select(
        export.should_export(newest, none).alias("first_run"),
        export.should_export(newest, early).alias("newer"),
        export.should_export(newest, newest).alias("same"),
        export.should_export(none, early).alias("empty_fact"),
    )


def _fact(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[DataFrame]]:
    staging, airlines, routes, airports = _star(spark, sf_dir)
    fact = enrich(latest_status(staging), airlines, routes, airports)
    return materialize(fact), [airlines, routes, airports]


@query
def export_full(spark, sf_dir):
    fact, tables = _fact(spark, sf_dir)
    return export.full_extract(fact, *tables, limit=EXPORT_LIMIT)


@query
def export_full_unlimited(spark, sf_dir):
    fact, tables = _fact(spark, sf_dir)
    return export.full_extract(fact, *tables)


@query
def export_delta(spark, sf_dir):
    fact, tables = _fact(spark, sf_dir)
    page = export.delta_page(fact, DELTA_LAST, DELTA_TARGET, PAGE_LIMIT, DELTA_LAST_KEY)
    return export.denormalize(page, *tables)


@query
def export_delta_sql(spark, sf_dir):
    """As ``export_delta``, with the extract given as SQL text and bound values."""
    fact, (airlines, routes, airports) = _fact(spark, sf_dir)
    tables = {"fact": fact, "dim_airline": airlines, "dim_route": routes, "dim_airport": airports}
    utc = timezone.utc
    return sql_extract(
        DELTA, tables, last=DELTA_LAST.replace(tzinfo=utc), last_key=DELTA_LAST_KEY,
        target=DELTA_TARGET.replace(tzinfo=utc), limit=PAGE_LIMIT)


# jobs ------------------------------------------------------------------------------------


def _stage(house: Warehouse, rows: DataFrame) -> None:
    """Each batch of the rows as a partition of staging, all by one write."""
    arrived = rows.select(*STAGED.fieldNames(), "batch_id")
    replace_partitions(arrived.withColumn("stream", F.lit("orders")), house.staging_path,
                       "stream", "batch_id")


def _load(house: Warehouse, batch: int) -> None:
    run_load(house.spark, house.root, batches=[("orders", batch)])


def _staging_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_staging(spark, sf_dir).withColumns(
        {"arr_eta_delta_min": F.lit(None).cast("double"), "partial_parse": F.lit(False)})


def _loaded(spark: SparkSession, sf_dir: str, batches: tuple) -> Warehouse:
    """A warehouse with all batches staged and one load for each of ``batches``."""
    house = Warehouse(spark, scratch_dir(spark, "warehouse"))
    _stage(house, _staging_rows(spark, sf_dir))
    for batch in batches:
        _load(house, batch)
    return house


def _frame(house: Warehouse) -> DataFrame:
    load_id = house.load_id()
    tables = [house.dimension(n, load_id) for n in ("dim_airline", "dim_route", "dim_airport")]
    return export.denormalize(house.fact(), *tables)


@query
def warehouse_load(spark, sf_dir):
    """Two loads through the store, then the export frame of the published tables."""
    house = _loaded(spark, sf_dir, (1, 2))
    return _frame(house)


@query
def load_failure(spark, sf_dir):
    """A second load that stops before it stores leaves the first state; a retry goes on."""
    house = _loaded(spark, sf_dir, (1,))
    with scratch_tables(spark):
        prepare_load(house)
    failed = materialize(_frame(house).withColumn("state", F.lit("failed")))
    run_load(spark, house.root)
    return failed.unionByName(_frame(house).withColumn("state", F.lit("retried")))


_EXPORT_SCHEMA = ", ".join(
    f"{name} {kind}" for name, kind in zip(
        EXPORT_COLUMNS,
        ["string", "timestamp", "timestamp", "double", "timestamp", "timestamp", "timestamp",
         "double", "string", "string", "string", "string", "timestamp"], strict=True)
)


@query
def job_export_full(spark, sf_dir):
    """The full extract of the default call after each of two loads, read back from its files."""
    house = _loaded(spark, sf_dir, (1,))
    out = f"{house.root}/extract"
    export_full_job(spark, house.root, out)
    run_load(spark, house.root)
    count = export_full_job(spark, house.root, out)
    last = house.last_export("full")
    if count != last["rows"] or count != house.fact().count():
        raise AssertionError(f"{count} rows returned, {last} recorded")
    return spark.read.schema(_EXPORT_SCHEMA).option("header", True).csv(
        f"{out}/export_id={last['export_id']}")


@query
def job_export_delta(spark, sf_dir):
    """Pages until nothing is left, after each of two loads: all pages, read back."""
    house = _loaded(spark, sf_dir, ())
    pages = []
    for batch in (1, 2):
        _load(house, batch)
        limit = house.fact().count() // 3 + 1
        out = f"{house.root}/delta{batch}"
        while export_delta_job(spark, house.root, out, limit, "parquet"):
            pass
        read = spark.read.schema(_EXPORT_SCHEMA).parquet(f"{out}/export_id=*")
        pages.append(read.withColumn("after_load", F.lit(batch)))
    return pages[0].unionByName(pages[1])


@query
def job_export_late(spark, sf_dir):
    """Rows of a time before those that are out come with a later load: the changes of each."""
    house = Warehouse(spark, scratch_dir(spark, "warehouse"))
    late = F.col("dep_terminal") == "1-URGENT"
    arrival = F.when((F.col("batch_id") == 1) & ~late, 1).otherwise(2).cast("long")
    _stage(house, _staging_rows(spark, sf_dir).withColumn("batch_id", arrival))
    pages = []
    for batch in (1, 2):
        _load(house, batch)
        out = f"{house.root}/delta{batch}"
        export_delta_job(spark, house.root, out, fmt="parquet")
        read = spark.read.schema(_EXPORT_SCHEMA).parquet(f"{out}/export_id=*")
        pages.append(read.withColumn("after_load", F.lit(batch)))
    return pages[0].unionByName(pages[1]).select(
        "after_load", "flight_key", "status", "ingest_time")


@query
def job_export_empty(spark, sf_dir):
    """Rows that exports write before anything is loaded, after a load, and with nothing new."""
    house = Warehouse(spark, scratch_dir(spark, "warehouse"))
    counts = []

    def export(step: str) -> None:
        for kind, job in (("full", export_full_job), ("delta", export_delta_job)):
            out = f"{house.root}/{kind}"
            counts.append((step, kind, job(spark, house.root, out),
                           bool(house.folder.names(f"{kind}/export_id=*"))))

    export("empty")
    _stage(house, _staging_rows(spark, sf_dir).where("batch_id = 1"))
    run_load(spark, house.root)
    export("loaded")
    export("again")
    return spark.createDataFrame(counts, "step string, kind string, rows long, written boolean")


def _ingest(house: Warehouse, topic: str, checkpoint: str) -> None:
    """Read all messages of a folder as a stream into staging."""
    start_ingest(
        read_messages(house.spark, {}, fmt="parquet", path=topic),
        staging_sink(house.staging_path, house.rejects_path),
        checkpoint=checkpoint,
        trigger={"availableNow": True},
    ).awaitTermination()


@query
def stream_restart(spark, sf_dir):
    """Events by one stream and a load, then with another status under a fresh checkpoint."""
    folder = scratch_dir(spark, "restart")
    house = Warehouse(spark, f"{folder}/warehouse")
    envelopes = event_envelopes(spark, sf_dir)
    again = envelopes.withColumn("status", F.concat(F.lit("again "), "status"))
    for turn, rows in enumerate((envelopes, again)):
        encode_envelopes(rows).select("value").write.parquet(f"{folder}/messages{turn}")
        _ingest(house, f"{folder}/messages{turn}", f"{folder}/progress{turn}")
        run_load(spark, house.root)
        house.purge_staging()
    return house.fact().select("flight_key", "status", "ingest_time")


@query
def stream_ingest(spark, sf_dir):
    """Messages read as a stream into staging and rejects; the outcome of every message.

    Messages of signups lose their key, messages of errors are no JSON.
    """
    folder = scratch_dir(spark, "ingest")
    envelopes = event_envelopes(spark, sf_dir)
    envelopes = envelopes.withColumn(
        "flight_key", F.when(F.col("status") != "signup", F.col("flight_key"))
    )
    body = F.col("value").cast("string")
    kind = F.get_json_object(body, "$.status")
    sent = F.when(kind == "error", F.concat(F.lit("{"), body)).otherwise(body)
    messages = encode_envelopes(envelopes).select(sent.cast("binary").alias("value"))
    messages.write.parquet(f"{folder}/messages")
    house = Warehouse(spark, f"{folder}/warehouse")
    _ingest(house, f"{folder}/messages", f"{folder}/progress")
    good = house.staged().select(
        "flight_key", "flight_number", "ingest_time", F.lit("none").alias("reason")
    )
    rejected = house.rejects()
    missing = F.lit(None).cast("string")
    return good.unionByName(
        rejected.select(
            missing.alias("flight_key"),
            F.when(F.col("reason") == "flight_key", F.get_json_object("raw", "$.flight.number"))
            .alias("flight_number"),
            F.lit(None).cast("timestamp").alias("ingest_time"),
            "reason",
        )
    )


# Messages shrink to a tenth in a file: with row groups of this size a task that decodes reads few.
_MESSAGE_FILES = {"parquet.block.size": str(8 << 20)}


def _send_by_day(spark: SparkSession, sf_dir: str, folder: str) -> Callable[[int], str]:
    """Events as three arrivals of messages, by the day of the month over 3: the function lets one
    arrive, in as many files as its rows need, and returns the folder of all that are there.

    Messages of signups lose their key, messages of errors are no JSON, the values of clicks are
    text.
    """
    envelopes = event_envelopes(spark, sf_dir)
    envelopes = envelopes.withColumn(
        "flight_key", F.when(F.col("status") != "signup", F.col("flight_key")))
    body = F.col("value").cast("string")
    kind = F.get_json_object(body, "$.status")
    sent = F.when(kind == "error", F.concat(F.lit("{"), body)).when(
        kind == "click", F.regexp_replace(body, r'"delay_min":(-?[\d.]+)', '"delay_min":"$1 min"')
    ).otherwise(body)
    day = F.get_json_object(body, "$.ingest_time").substr(9, 2).cast("int")
    messages = encode_envelopes(envelopes).select(
        sent.cast("binary").alias("value"), (day % 3).alias("part"))
    messages.write.options(**_MESSAGE_FILES).partitionBy("part").parquet(f"{folder}/sent")
    encoded = spark.read.schema("value binary, part int").parquet(f"{folder}/sent")

    def arrive(part: int) -> str:
        encoded.where(F.col("part") == part).select("value").write.options(
            **_MESSAGE_FILES).mode("append").parquet(f"{folder}/messages")
        return f"{folder}/messages"

    return arrive


@query
def stream_counts(spark, sf_dir):
    """What a listener counts of each micro-batch."""
    folder = scratch_dir(spark, "counts")
    house = Warehouse(spark, f"{folder}/warehouse")
    arrive = _send_by_day(spark, sf_dir, folder)
    counts = BatchCounts()
    spark.streams.addListener(counts)
    try:
        for part in range(3):
            running = start_ingest(
                read_messages(spark, {}, fmt="parquet", path=arrive(part)),
                staging_sink(house.staging_path, house.rejects_path), f"{folder}/progress",
                trigger={"availableNow": True})
            running.awaitTermination()
            counts.wait_for(running)
    finally:
        spark.streams.removeListener(counts)
    return counts.frame(spark).drop("stream")


class _Lost(Exception):
    """A driver that is lost after it has loaded a batch."""


@query
def stream_load(spark, sf_dir):
    """Three micro-batches, staged and loaded as they arrive; the driver is lost after the second
    is loaded and before Spark notes it, so the restart replays it."""
    folder = scratch_dir(spark, "load")
    house = Warehouse(spark, f"{folder}/warehouse")
    arrive = _send_by_day(spark, sf_dir, folder)
    sink = loading_sink(house, newer_only=True)
    lost = []

    def losing(rows: DataFrame, stream: str, number: int) -> None:
        sink(rows, stream, number)
        if number == 1 and not lost:
            lost.append(number)
            raise _Lost

    for part in range(3):
        # a restart goes on with the batch that Spark has not noted, then with what has arrived
        running = start_ingest(
            read_messages(spark, {}, fmt="parquet", path=arrive(part)),
            losing, f"{folder}/progress", trigger={"availableNow": True})
        try:
            running.awaitTermination()
        except StreamingQueryException:
            if part != 1 or not lost:
                raise
    loads = F.lit(house.load_id()).cast("long").alias("loads")
    staged = house.staged().count()
    return house.fact().select(
        "flight_key", "status", "ingest_time", loads, F.lit(staged).alias("staged"))
