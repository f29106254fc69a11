"""Row shapes of every hop, from the API page to the export frame."""

from __future__ import annotations

from pyspark.sql import types as T

# The formats of the feed and, below, the names in its pages, messages and tables.
SCHEDULE_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"
SCHEDULE_SHAPE = r"(?i)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})$"
KEY_TIME_FORMAT_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
LIVE_STATUS = "active"
FEED_SOURCE = "aviationstack"
JDBC_BATCH_ROWS = 5_000


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _struct(*parts: T.StructField | list[T.StructField]) -> T.StructType:
    fields: list[T.StructField] = []
    for part in parts:
        fields.extend(part if isinstance(part, list) else [part])
    return T.StructType(fields)


_AIRLINE = _struct(_text("iata", "icao", "name"))
_FLIGHT = _struct(_text("number", "iata", "icao"))

_PAGE_STOP = _struct(
    _text("airport", "iata", "icao", "terminal", "gate", "scheduled", "estimated", "actual"),
    T.StructField("delay", T.IntegerType()),
)
PAGE_RECORD = _struct(
    _text("flight_date", "flight_status"),
    T.StructField("departure", _PAGE_STOP),
    T.StructField("arrival", _PAGE_STOP),
    T.StructField("airline", _AIRLINE),
    T.StructField("flight", _FLIGHT),
)
# A page is read with its records as text; each record is parsed by itself.
PAGE = _struct(T.StructField("data", T.ArrayType(T.StringType())))

_ENVELOPE_STOP = _struct(
    _text("airport", "iata", "icao", "gate", "terminal", "schedule", "estimated", "actual"),
    T.StructField("delay_min", T.IntegerType()),
)
ENVELOPE = _struct(
    _text("flight_key", "flight_date", "status"),
    T.StructField("airline", _AIRLINE),
    T.StructField("flight", _FLIGHT),
    T.StructField("departure", _ENVELOPE_STOP),
    T.StructField("arrival", _ENVELOPE_STOP),
    _text("ingest_time", "source"),
)


def _stop_columns(side: str) -> list[T.StructField]:
    stamp, number = T.TimestampType(), T.DoubleType()
    return [
        *_text(f"{side}_airport", f"{side}_airport_iata", f"{side}_airport_icao"),
        *_text(f"{side}_terminal", f"{side}_gate"),
        T.StructField(f"{side}_scheduled", stamp),
        T.StructField(f"{side}_estimated", stamp),
        T.StructField(f"{side}_actual", stamp),
        T.StructField(f"{side}_delay_min", number),
    ]


STAGING = _struct(
    _text("flight_key"),
    T.StructField("flight_date", T.DateType()),
    _text("status"),
    T.StructField("ingest_time", T.TimestampType()),
    _text("flight_number", "flight_iata", "flight_icao"),
    _text("airline_iata", "airline_icao", "airline_name"),
    _stop_columns("dep"),
    _stop_columns("arr"),
)
STAGING_EXTRA = _struct(
    T.StructField("arr_eta_delta_min", T.DoubleType()),
    T.StructField("partial_parse", T.BooleanType()),
)
STAGED = T.StructType([*STAGING.fields, *STAGING_EXTRA.fields])

REJECTS = _struct(_text("reason", "raw"))
# Optional field of a message: true where a value of the record did not fit its type.
PARTIAL = "partial_parse"

DIM_AIRLINE = _struct(
    T.StructField("airline_id", T.LongType()), _text("iata", "icao", "airline_name")
)
DIM_AIRPORT = _struct(
    T.StructField("airport_id", T.LongType()), _text("iata", "icao", "airport_name")
)
DIM_ROUTE = _struct(
    T.StructField("route_id", T.LongType()),
    T.StructField("dep_airport_id", T.LongType()),
    T.StructField("arr_airport_id", T.LongType()),
)
QUARANTINE = _struct(_text("iata", "icao", "airport_name", "reason"))

TIMELINE = [
    "dep_scheduled", "dep_estimated", "dep_actual", "dep_delay_min",
    "arr_scheduled", "arr_estimated", "arr_actual", "arr_delay_min",
]
FACT = _struct(
    _text("flight_key"),
    T.StructField("flight_date", T.DateType()),
    _text("status"),
    T.StructField("ingest_time", T.TimestampType()),
    T.StructField("airline_id", T.LongType()),
    T.StructField("route_id", T.LongType()),
    [STAGING[name] for name in TIMELINE],
)

EXPORT_COLUMNS = [
    "flight_key", "dep_scheduled", "dep_actual", "dep_delay_min",
    "arr_scheduled", "arr_estimated", "arr_actual", "arr_delay_min",
    "status", "airline_name", "dep_airport_name", "arr_airport_name", "ingest_time",
]
