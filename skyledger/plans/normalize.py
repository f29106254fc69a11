"""Landed API pages to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.normalize import encode_envelopes, explode_pages, normalize_records
from skyledger.schemas import LIVE_STATUS, PARTIAL


def normalize_pages(
    pages: DataFrame, ingest_time: Column | None = None, status: str | None = LIVE_STATUS
) -> DataFrame:
    """What becomes of every live record and every unreadable page, in one frame.

    ``outcome`` is ``keyed`` for a message (``key``, ``value``), else the reason why there is
    none: ``flight_key``, ``malformed_record`` or ``malformed_page``, with the text as ``raw``.
    ``partial_parse`` marks records with a value that did not fit; their messages say so too.
    Pages are parsed once: persist or write the frame before splitting it by outcome.
    """
    envelopes = normalize_records(explode_pages(pages, status, rejects=True), ingest_time)
    outcome = F.coalesce(
        "reject", F.when(F.col("flight_key").isNull(), F.lit("flight_key")), F.lit("keyed"))
    judged = envelopes.withColumn("outcome", outcome)
    message = encode_envelopes(judged, keep=["outcome", PARTIAL, "raw"])
    keyed = F.col("outcome") == "keyed"
    return message.select(
        "outcome", F.when(keyed, F.col("key")).alias("key"),
        F.when(keyed, F.col("value")).alias("value"), PARTIAL,
        F.when(~keyed, F.coalesce("raw", F.col("value").cast("string"))).alias("raw"),
    )


def messages(normalized: DataFrame) -> DataFrame:
    """The messages among the outcomes."""
    return normalized.where(F.col("outcome") == "keyed").select("key", "value")
