"""Table constraints as data-quality operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.joins import lookup_join


def non_negative(name: str) -> Column:
    """True for null and for values from zero up."""
    return F.col(name).isNull() | (F.col(name) >= 0)


def reject_reason() -> Column:
    """Why a staging row cannot be stored; null where it can."""
    return (
        F.when(F.col("flight_key").isNull(), "flight_key")
        .when(F.col("ingest_time").isNull(), "ingest_time")
        .when(~non_negative("dep_delay_min") | ~non_negative("arr_delay_min"), "negative_delay")
    )


def with_reject_reason(staging: DataFrame) -> DataFrame:
    return staging.withColumn("reject_reason", reject_reason())


def split_rejects(rows: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Good rows without the reason column, and rejected rows with it."""
    good = rows.where(F.col(reason).isNull()).drop(reason)
    return good, rows.where(F.col(reason).isNotNull())


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their ``copies``; a null part exempts a row."""
    present = df.select(*keys).dropna(how="any")
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(
    child: DataFrame,
    foreign_key: str,
    parent: DataFrame,
    key: str,
    spread: list[str] | None = None,
    size: int | None = None,
) -> DataFrame:
    """Child rows whose foreign key is set but has no parent row.

    ``spread`` and ``size`` are those of ``lookup_join``, for the parent's keys.
    """
    ids = parent.select(F.col(key).alias(foreign_key)).where(F.col(foreign_key).isNotNull())
    referring = child.where(F.col(foreign_key).isNotNull())
    return lookup_join(referring, ids, [foreign_key], how="left_anti", spread=spread, size=size)


def touched_rows(
    stored: DataFrame, incoming: DataFrame, key: str, incoming_key: str | None = None
) -> DataFrame:
    """Stored rows whose key is among the incoming ones, each once: what an upsert replaces, and
    what a uniqueness check has to look at.

    Incoming keys too many to broadcast are shuffled with the stored rows. Where ``incoming`` is
    filtered and the scan of ``stored`` large, Spark then builds a Bloom filter of the keys and
    applies it to that scan (``session.runtime_filters``), so only rows that can match move.
    """
    keys = incoming.select(F.col(incoming_key or key).alias(key))
    return stored.join(keys, key, "left_semi")


def unreferenced(
    child: DataFrame, foreign_key: str, parent: DataFrame, key: str
) -> DataFrame:
    """Child rows whose parent is missing, for a parent too large for ``orphans``' lookup.

    The child's keys filter the scan of the parent in the same way: an outer join allows that,
    an anti join does not.
    """
    ids = parent.select(F.col(key).alias(foreign_key)).distinct().withColumn("_known", F.lit(True))
    referring = child.where(F.col(foreign_key).isNotNull())
    return referring.join(ids, foreign_key, "left").where("_known IS NULL").select(child.columns)
