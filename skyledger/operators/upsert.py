"""Upserts as functions of the old table and the incoming rows.

The incoming rows hold each key once (see ``fold``). Rows with a null key part match nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_overwrite(
    target: DataFrame, source: DataFrame, keys: list[str], newer_only: str | None = None
) -> DataFrame:
    """Incoming rows replace stored rows of the same key as a whole, nulls included.

    ``newer_only`` names a time column: an incoming row older than the stored one is left out.
    A source small by its statistics is broadcast by Spark, so the target is not shuffled.
    """
    source = source.select(target.columns)
    if newer_only is not None:
        stored = target.select(*keys, F.col(newer_only).alias("_stored"))
        # semi-joined first: the stored side shrinks to the keys that are incoming
        stored = stored.join(source.select(*keys), keys, "left_semi")
        compared = source.join(stored, keys, "left")
        fresh = F.col("_stored").isNull() | (F.col(newer_only) >= F.col("_stored"))
        source = compared.where(fresh).select(target.columns)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(target.columns).unionByName(source)


def upsert_coalesce(
    target: DataFrame, source: DataFrame, keys: list[str], attributes: list[str]
) -> DataFrame:
    """Incoming attributes replace stored ones unless they are null.

    Columns the source does not have (the surrogate key) stay, and are null for a new row.
    """
    incoming = source.select(*keys, *[F.col(a).alias(f"_new_{a}") for a in attributes])
    merged = target.join(incoming, keys, "full")
    return merged.select(
        *[
            F.coalesce(f"_new_{c}", c).alias(c) if c in attributes else F.col(c)
            for c in target.columns
        ]
    )


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key the target does not have; stored rows are never changed."""
    return source.join(target.select(*keys), keys, "left_anti").select(source.columns)
