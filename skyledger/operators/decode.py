"""Message bytes to typed staging rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import minutes_between, parse_date, parse_ingest_time, parse_schedule
from skyledger.operators.quality import reject_reason
from skyledger.schemas import ENVELOPE, PARTIAL, STAGED

_CORRUPT = "_corrupt"
_PARSE_SCHEMA = T.StructType(
    [
        *ENVELOPE.fields,
        T.StructField(PARTIAL, T.BooleanType()),
        T.StructField(_CORRUPT, T.StringType()),
    ]
)


def parse_envelopes(df: DataFrame, column: str = "value") -> DataFrame:
    """Envelope columns, the text as ``raw``, and ``_corrupt`` where any part did not fit.

    A field of the wrong type is null while the rest of the envelope is kept.
    """
    text = df.select(F.col(column).cast("string").alias("raw"))
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.from_json("raw", _PARSE_SCHEMA, options)
    # as a generator the parse runs once per message: filters on its fields would otherwise be
    # pushed below it together with copies of it
    return text.select("raw", F.explode(F.array(parsed)).alias("r")).select("raw", "r.*")


def _stop_columns(side: str, prefix: str) -> list[Column]:
    at = lambda name: F.col(f"{side}.{name}")
    return [
        at("airport").alias(f"{prefix}_airport"),
        at("iata").alias(f"{prefix}_airport_iata"),
        at("icao").alias(f"{prefix}_airport_icao"),
        at("terminal").alias(f"{prefix}_terminal"),
        at("gate").alias(f"{prefix}_gate"),
        parse_schedule(at("schedule")).alias(f"{prefix}_scheduled"),
        parse_schedule(at("estimated")).alias(f"{prefix}_estimated"),
        parse_schedule(at("actual")).alias(f"{prefix}_actual"),
        at("delay_min").cast("double").alias(f"{prefix}_delay_min"),
    ]


def type_envelopes(parsed: DataFrame) -> DataFrame:
    """Flatten and type parsed envelopes: the staging columns, ``raw`` and ``_corrupt``."""
    key = F.nullif(F.trim("flight_key"), F.lit(""))
    flat = parsed.select(
        "raw",
        _CORRUPT,
        F.col(PARTIAL).alias("_marked"),
        F.when(key.isNotNull(), F.col("flight_key")).alias("flight_key"),
        parse_date(F.col("flight_date")).alias("flight_date"),
        F.col("status"),
        parse_ingest_time(F.col("ingest_time")).alias("ingest_time"),
        F.col("flight.number").alias("flight_number"),
        F.col("flight.iata").alias("flight_iata"),
        F.col("flight.icao").alias("flight_icao"),
        F.col("airline.iata").alias("airline_iata"),
        F.col("airline.icao").alias("airline_icao"),
        F.col("airline.name").alias("airline_name"),
        *_stop_columns("departure", "dep"),
        *_stop_columns("arrival", "arr"),
    )
    return flat.select(
        *[c for c in flat.columns if c != "_marked"],
        minutes_between(F.col("arr_estimated"), F.col("arr_scheduled")).alias("arr_eta_delta_min"),
        (F.col(_CORRUPT).isNotNull() | F.coalesce("_marked", F.lit(False))).alias(PARTIAL),
    )


def decode(df: DataFrame, column: str = "value", default_ingest: Column | None = None) -> DataFrame:
    """Messages to staging rows with ``raw`` and ``reject_reason`` (null for a good row).

    ``default_ingest`` stands in for an ingest time that is missing or does not parse.
    """
    rows = type_envelopes(parse_envelopes(df, column))
    if default_ingest is not None:
        rows = rows.withColumn("ingest_time", F.coalesce("ingest_time", default_ingest))
    unreadable = F.col("flight_key").isNull() & (
        F.col(_CORRUPT).isNotNull() | F.col("raw").isNull() | (F.trim("raw") == "")
    )
    reason = F.when(unreadable, F.lit("malformed")).otherwise(reject_reason())
    return rows.select(*STAGED.fieldNames(), "raw", reason.alias("reject_reason"))
