"""The given tables in the shapes of the feed.

Every adapter reads its tables whole. ``*_SQL`` states the same rows for the SQL checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.schemas import STAGING
from skyledger.session import configure

# Orders before this day arrive with the first load, the others with the second.
SECOND_LOAD = "1996-07-01"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssxxx"


# The columns of the given tables.
TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone and dates as text, the types both engines share."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# envelopes from events -------------------------------------------------------------------


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per event, as struct columns. Signups lack an airline; errors lack a name."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    number = F.get_json_object("props", "$.k")
    text = F.lit(None).cast("string")
    departed = F.date_format(F.date_trunc("second", ts), ISO_SECONDS)
    landed = F.date_format(
        F.date_trunc("second", ts) + F.make_interval(mins=F.col("value").cast("int")), ISO_SECONDS
    )
    return e.select(
        F.concat_ws("_", kind, F.col("user_id").cast("string")).alias("flight_key"),
        F.date_format(ts, "yyyy-MM-dd").alias("flight_date"),
        kind.alias("status"),
        F.struct(
            F.when(kind != "signup", F.concat(F.lit("K"), number)).alias("iata"),
            F.concat(F.lit("KK"), number).alias("icao"),
            F.when(kind != "error", F.concat(F.lit("Line "), number)).alias("name"),
        ).alias("airline"),
        F.struct(
            F.col("event_id").cast("string").alias("number"),
            F.concat(F.lit("F"), F.col("user_id").cast("string")).alias("iata"),
            text.alias("icao"),
        ).alias("flight"),
        F.struct(
            F.concat(F.lit("Airport "), kind).alias("airport"),
            F.upper(F.substring(kind, 1, 3)).alias("iata"),
            text.alias("icao"), text.alias("gate"), text.alias("terminal"),
            departed.alias("schedule"),
            F.date_format(ts, ISO_MICROS).alias("estimated"),
            text.alias("actual"),
            F.col("value").cast("int").alias("delay_min"),
        ).alias("departure"),
        F.struct(
            text.alias("airport"), text.alias("iata"), text.alias("icao"), text.alias("gate"),
            F.col("user_id").cast("string").alias("terminal"),
            departed.alias("schedule"),
            landed.alias("estimated"),
            text.alias("actual"),
            F.lit(None).cast("int").alias("delay_min"),
        ).alias("arrival"),
        F.date_format(ts, ISO_MICROS).alias("ingest_time"),
        F.lit("events").alias("source"),
    )


# API records from events -----------------------------------------------------------------


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page text per event with two records: the event, and a live twin with the scheduled
    time at another offset and the identifiers that the event type leaves."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    empty = F.lit("")
    text = F.lit(None).cast("string")
    tokyo = F.concat(
        F.date_format(F.date_trunc("second", ts) + F.expr("INTERVAL 9 HOURS"),
                      "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit("+09:00"),
    )

    def record(status: Column, scheduled: Column) -> Column:
        return F.struct(
            F.date_format(ts, "yyyy-MM-dd").alias("flight_date"),
            status.alias("flight_status"),
            F.struct(
                F.concat(F.lit("Airport "), kind).alias("airport"),
                F.upper(F.substring(kind, 1, 3)).alias("iata"),
                text.alias("icao"), text.alias("terminal"), user.alias("gate"),
                scheduled.alias("scheduled"),
                F.date_format(ts, ISO_MICROS).alias("estimated"),
                empty.alias("actual"),
                F.col("value").cast("int").alias("delay"),
            ).alias("departure"),
            F.struct(
                F.when(kind == "signup", F.lit("ANY")).otherwise(F.concat(F.lit("L"), user))
                .alias("name"),
                text.alias("iata"), text.alias("icao"),
            ).alias("airline"),
            F.struct(
                F.when(kind == "error", text).otherwise(F.col("event_id").cast("string"))
                .alias("number"),
                F.when(kind == "view", F.concat(F.lit("V"), user)).otherwise(empty).alias("iata"),
                F.when(kind == "click", F.concat(F.lit("CK"), user)).alias("icao"),
            ).alias("flight"),
        )

    page = F.struct(
        F.array(record(kind, tokyo), record(F.lit("active"), tokyo)).alias("data")
    )
    return e.select(
        F.to_json(page, {"ignoreNullFields": "false"}).cast("binary").alias("value")
    )


# staging from orders ---------------------------------------------------------------------


def order_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One staging row per order: customers are airlines, suppliers are airports, the years of a
    customer are flights. ``batch_id`` is the load a row arrives with."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.min("l_suppkey").alias("dep_supp"), F.max("l_suppkey").alias("arr_supp"),
            F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
        )
    )
    nation = table(spark, sf_dir, "nation")
    ports = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "s_suppkey", "s_name", "n_regionkey",
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("port"),
            # the suppliers of region 2 share a code per nation
            F.when(F.col("n_regionkey") == 2, F.concat(F.lit("Q"), F.col("s_nationkey")))
            .otherwise(F.concat(F.lit("Z"), F.col("s_suppkey"))).alias("port_icao"),
        )
    )
    customer = table(spark, sf_dir, "customer")
    dep = ports.select(*[F.col(c).alias(f"dep_{c}") for c in ports.columns])
    arr = ports.select(*[F.col(c).alias(f"arr_{c}") for c in ports.columns])
    o = (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(dep, F.col("dep_supp") == F.col("dep_s_suppkey"), "left")
        .join(arr, F.col("arr_supp") == F.col("arr_s_suppkey"), "left")
    )
    day = F.col("o_orderdate")
    status = F.col("o_orderstatus")
    prio = F.col("o_orderpriority")
    cust = F.col("o_custkey").cast("string")
    year = F.date_trunc("year", day)
    text = F.lit(None).cast("string")
    no_iata = prio.isin("4-NOT SPECIFIED", "5-LOW")
    code = F.concat(F.lit("C"), cust)
    own_icao = F.concat(F.lit("I"), cust)

    def named(name: Column) -> Column:
        return F.concat(name, F.lit(" "), status)

    stamp = lambda c: c.cast("timestamp")
    columns = {
        "flight_key": F.concat(
            code, F.lit("_"), F.date_format(year, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")
        ),
        "flight_date": F.to_date(day),
        "status": status,
        "ingest_time": stamp(day),
        "flight_number": F.col("o_orderkey").cast("string"),
        "flight_iata": code,
        "flight_icao": text,
        "airline_iata": F.when(no_iata, text)
        .when(status == "O", F.concat(F.lit("  "), code, F.lit(" ")))
        .otherwise(code),
        "airline_icao": F.when(prio == "4-NOT SPECIFIED", F.lit(" "))
        .when((prio == "5-LOW") & (status != "F"),
              F.concat(F.lit("X"), F.col("c_nationkey").cast("string")))
        .when(status == "P", text)
        .otherwise(own_icao),
        "airline_name": F.when(prio == "4-NOT SPECIFIED",
                               F.concat(F.lit("Charter "), F.col("c_mktsegment")))
        .when(status == "P", F.lit(" "))
        .otherwise(named(F.col("c_name"))),
        "dep_airport": named(F.col("dep_s_name")),
        "dep_airport_iata": F.when(F.col("dep_n_regionkey") >= 3, text)
        .when(status == "O", F.concat(F.lit(" "), F.col("dep_port")))
        .otherwise(F.col("dep_port")),
        "dep_airport_icao": F.when(
            (status == "P") & (F.col("dep_n_regionkey") < 3), text
        ).otherwise(F.col("dep_port_icao")),
        "dep_terminal": prio,
        "dep_gate": text,
        "dep_scheduled": stamp(year),
        "dep_estimated": stamp(day),
        "dep_actual": stamp(F.col("first_ship")),
        "dep_delay_min": F.col("o_totalprice"),
        "arr_airport": F.when(status != "P", F.col("arr_s_name")),
        "arr_airport_iata": F.when(F.col("arr_n_regionkey") == 4, text)
        .otherwise(F.col("arr_port")),
        "arr_airport_icao": F.col("arr_port_icao"),
        "arr_terminal": text,
        "arr_gate": text,
        "arr_scheduled": stamp(day + F.expr("INTERVAL 60 DAYS")),
        "arr_estimated": stamp(F.col("last_ship")),
        "arr_actual": F.when(status == "F", stamp(F.col("last_ship"))),
        "arr_delay_min": F.abs(F.datediff("last_ship", day)).cast("double"),
    }
    batch = F.when(day < F.lit(SECOND_LOAD).cast("timestamp_ntz"), 1).otherwise(2)
    rows = o.select(
        *[columns[name].alias(name) for name in STAGING.fieldNames()],
        batch.cast("long").alias("batch_id"),
    )
    return rows


# The same rows as order_staging, as the common table expression ``s``.
STAGING_SQL = f"""
lines AS (
  SELECT l_orderkey, min(l_suppkey) AS dep_supp, max(l_suppkey) AS arr_supp,
         min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey
),
ports AS (
  SELECT s_suppkey, s_name, n_regionkey, 'S' || s_suppkey AS port,
         CASE WHEN n_regionkey = 2 THEN 'Q' || s_nationkey ELSE 'Z' || s_suppkey END AS port_icao
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
s AS (
  SELECT
    'C' || o_custkey || '_' || strftime(date_trunc('year', o_orderdate), '%Y-%m-%dT%H:%M:%S')
      || '+00:00' AS flight_key,
    CAST(o_orderdate AS DATE) AS flight_date,
    o_orderstatus AS status,
    o_orderdate AS ingest_time,
    CAST(o_orderkey AS VARCHAR) AS flight_number,
    'C' || o_custkey AS flight_iata,
    CAST(NULL AS VARCHAR) AS flight_icao,
    CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN NULL
         WHEN o_orderstatus = 'O' THEN '  C' || o_custkey || ' '
         ELSE 'C' || o_custkey END AS airline_iata,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' '
         WHEN o_orderpriority = '5-LOW' AND o_orderstatus <> 'F' THEN 'X' || c_nationkey
         WHEN o_orderstatus = 'P' THEN NULL
         ELSE 'I' || o_custkey END AS airline_icao,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Charter ' || c_mktsegment
         WHEN o_orderstatus = 'P' THEN ' '
         ELSE c_name || ' ' || o_orderstatus END AS airline_name,
    d.s_name || ' ' || o_orderstatus AS dep_airport,
    CASE WHEN d.n_regionkey >= 3 THEN NULL
         WHEN o_orderstatus = 'O' THEN ' ' || d.port ELSE d.port END AS dep_airport_iata,
    CASE WHEN o_orderstatus = 'P' AND d.n_regionkey < 3 THEN NULL
         ELSE d.port_icao END AS dep_airport_icao,
    o_orderpriority AS dep_terminal,
    CAST(NULL AS VARCHAR) AS dep_gate,
    CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS dep_scheduled,
    o_orderdate AS dep_estimated,
    first_ship AS dep_actual,
    o_totalprice AS dep_delay_min,
    CASE WHEN o_orderstatus <> 'P' THEN a.s_name END AS arr_airport,
    CASE WHEN a.n_regionkey = 4 THEN NULL ELSE a.port END AS arr_airport_iata,
    a.port_icao AS arr_airport_icao,
    CAST(NULL AS VARCHAR) AS arr_terminal,
    CAST(NULL AS VARCHAR) AS arr_gate,
    o_orderdate + INTERVAL 60 DAY AS arr_scheduled,
    last_ship AS arr_estimated,
    CASE WHEN o_orderstatus = 'F' THEN last_ship END AS arr_actual,
    CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(last_ship AS DATE))) AS DOUBLE)
      AS arr_delay_min,
    CAST(CASE WHEN o_orderdate < TIMESTAMP '{SECOND_LOAD}' THEN 1 ELSE 2 END AS BIGINT)
      AS batch_id
  FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN lines ON o_orderkey = l_orderkey
  LEFT JOIN ports d ON dep_supp = d.s_suppkey
  LEFT JOIN ports a ON arr_supp = a.s_suppkey
),
c AS (
  SELECT * REPLACE (
    nullif(trim(airline_iata, ' '), '') AS airline_iata,
    nullif(trim(airline_icao, ' '), '') AS airline_icao,
    nullif(trim(airline_name, ' '), '') AS airline_name,
    nullif(trim(dep_airport, ' '), '') AS dep_airport,
    nullif(trim(dep_airport_iata, ' '), '') AS dep_airport_iata,
    nullif(trim(dep_airport_icao, ' '), '') AS dep_airport_icao,
    nullif(trim(arr_airport, ' '), '') AS arr_airport,
    nullif(trim(arr_airport_iata, ' '), '') AS arr_airport_iata,
    nullif(trim(arr_airport_icao, ' '), '') AS arr_airport_icao)
  FROM s
),
ports_seen AS (
  SELECT dep_airport_iata AS iata, dep_airport_icao AS icao, dep_airport AS name,
         ingest_time, batch_id FROM c
  UNION ALL
  SELECT arr_airport_iata, arr_airport_icao, arr_airport, ingest_time, batch_id FROM c
)"""
