"""API page to envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import flight_key, iso_utc
from skyledger.schemas import (
    ENVELOPE,
    FEED_SOURCE,
    KEY_TIME_FORMAT_MICROS,
    LIVE_STATUS,
    PAGE,
    PAGE_RECORD,
    PARTIAL,
)


_CORRUPT = "_corrupt"
_PARSED_PAGE = T.StructType([*PAGE.fields, T.StructField(_CORRUPT, T.StringType())])
_PARSED_RECORD = T.StructType([*PAGE_RECORD.fields, T.StructField(_CORRUPT, T.StringType())])


def parse_pages(df: DataFrame, column: str = "value") -> DataFrame:
    """JSON page text or bytes to the texts of its records: ``data``, and the page as ``raw``.

    ``data`` is null where the text is no JSON object with a list of records.
    """
    text = df.select(F.col(column).cast("string").alias("raw"))
    page = F.from_json("raw", _PARSED_PAGE, {"columnNameOfCorruptRecord": _CORRUPT})
    # as a generator the parse runs once per page: filters would otherwise repeat it
    parsed = text.select("raw", F.explode(F.array(page)).alias("page"))
    whole = F.col(f"page.{_CORRUPT}").isNull()
    return parsed.select("raw", F.when(whole, F.col("page.data")).alias("data"))


def explode_pages(
    pages: DataFrame, status: str | None = LIVE_STATUS, rejects: bool = False
) -> DataFrame:
    """One row per flight record; ``status`` keeps the records of that flight status only.

    ``reject`` and ``raw`` say why a page or a record cannot be read and what it was; such rows
    are there only with ``rejects``. ``partial_parse`` marks a record with a value that did not
    fit its type and is null.
    """
    text = pages.select(
        F.when(F.col("data").isNull(), F.lit("malformed_page")).alias("page_reject"),
        F.when(F.col("data").isNull(), F.col("raw")).alias("page_raw"),
        F.explode_outer("data").alias("text"),
    )
    # an empty list or a null in it is no record and no fault
    text = text.where(F.col("text").isNotNull() | F.col("page_reject").isNotNull())
    record = F.from_json("text", _PARSED_RECORD, {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = text.select(
        "page_reject", "page_raw", "text", F.explode(F.array(record)).alias("record"))
    fields = [F.col(f"record.{name}").alias(name) for name in PAGE_RECORD.fieldNames()]
    corrupt = F.col(f"record.{_CORRUPT}").isNotNull()
    nothing = F.coalesce(*[F.col(f"record.{n}").cast("string") for n in PAGE_RECORD.fieldNames()])
    reject = F.coalesce(
        "page_reject", F.when(corrupt & nothing.isNull(), F.lit("malformed_record")))
    rows = parsed.select(
        *fields, corrupt.alias(PARTIAL), reject.alias("reject"),
        F.when(reject.isNotNull(), F.coalesce("page_raw", "text")).alias("raw"),
    )
    wanted = F.lit(True) if status is None else F.col("flight_status") == status
    if not rejects:
        return rows.where(F.col("reject").isNull() & wanted).drop("reject", "raw")
    return rows.where(F.col("reject").isNotNull() | wanted)


_SIDES = ("departure", "arrival")


def _stop(side: str) -> Column:
    at = lambda name: F.col(f"{side}.{name}")
    return F.struct(
        at("airport").alias("airport"),
        at("iata").alias("iata"),
        at("icao").alias("icao"),
        at("gate").alias("gate"),
        at("terminal").alias("terminal"),
        F.col(f"{side}_schedule").alias("schedule"),
        iso_utc(at("estimated")).alias("estimated"),
        iso_utc(at("actual")).alias("actual"),
        at("delay").alias("delay_min"),
    ).alias(side)


def normalize_records(
    records: DataFrame, ingest_time: Column | None = None, source: str = FEED_SOURCE
) -> DataFrame:
    """Reshape flight records to envelopes.

    A record without an identifier or a departure time gets a null ``flight_key``.
    ``ingest_time`` is a timestamp, the time of the query where none is given.
    """
    stamp = F.current_timestamp() if ingest_time is None else ingest_time
    timed = records.withColumns(
        {f"{side}_schedule": iso_utc(F.col(f"{side}.scheduled")) for side in _SIDES}
    )
    identifiers = [F.col(f"flight.{name}") for name in ("iata", "icao", "number")]
    envelope = timed.select(
        flight_key(*identifiers, F.col("departure_schedule")).alias("flight_key"),
        F.col("flight_date"),
        F.col("flight_status").alias("status"),
        F.struct(
            F.col("airline.iata").alias("iata"),
            F.col("airline.icao").alias("icao"),
            F.col("airline.name").alias("name"),
        ).alias("airline"),
        F.struct(
            F.col("flight.number").alias("number"),
            F.col("flight.iata").alias("iata"),
            F.col("flight.icao").alias("icao"),
        ).alias("flight"),
        *[_stop(side) for side in _SIDES],
        F.date_format(stamp, KEY_TIME_FORMAT_MICROS).alias("ingest_time"),
        F.lit(source).alias("source"),
        *[F.col(name) for name in (PARTIAL, "reject", "raw") if name in records.columns],
    )
    return envelope


def split_keyed(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Envelopes with a key, and those without."""
    keyed = F.col("flight_key").isNotNull()
    return envelopes.where(keyed), envelopes.where(~keyed)


def encode_envelopes(envelopes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Message ``key`` and JSON ``value`` bytes; null fields stay in the text.

    ``keep`` names columns that stay. Where ``partial_parse`` is true the text says so in a field
    of that name.

    The key keeps the updates of one flight in order on a topic with several partitions.
    """
    fields = [F.col(name) for name in ENVELOPE.fieldNames()]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    if PARTIAL in envelopes.columns:
        marked = F.to_json(F.struct(*fields, F.lit(True).alias(PARTIAL)),
                           {"ignoreNullFields": "false"})
        body = F.when(F.col(PARTIAL), marked).otherwise(body)
    return envelopes.select(
        F.col("flight_key").cast("binary").alias("key"), body.cast("binary").alias("value"),
        *(keep or []),
    )
