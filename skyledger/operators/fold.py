"""Many sightings of a key to one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole row that is greatest by ``order``, per key; ties go to the greatest row.

    One aggregate of a struct: each task keeps one row per key before the shuffle, so a key with
    very many rows costs one row per task. Nulls of the winning row stay.

    The plan sorts the rows of a task before either step. The alternative, a hash aggregate of
    many rows per key, more with few, and it shuffles every row of a key instead of one a task.
    """
    ranked = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    winner = F.max(F.struct(*[F.col(c) for c in ranked])).alias("_winner")
    rows = df.groupBy(*keys).agg(winner)
    picked = [F.col(c) if c in keys else F.col("_winner")[c].alias(c) for c in df.columns]
    return rows.select(*picked)


def sightings(df: DataFrame, attributes: list[str], seen: str) -> DataFrame:
    """Distinct attribute tuples with the time each was last seen, as ``seen``."""
    return df.groupBy(*attributes).agg(F.max(seen).alias("seen"))


def latest_non_null(df: DataFrame, key: str, attributes: list[str], seen: str) -> DataFrame:
    """Per key, the latest value of each attribute that is not null; ties go to the greatest.

    Repeats of a tuple are combined by a hash aggregate first, so the ordered aggregate sees
    each distinct tuple once.
    """
    tuples = sightings(df.where(F.col(key).isNotNull()), [key, *attributes], seen)
    latest = [
        F.max(F.when(F.col(a).isNotNull(), F.struct("seen", a)))[a].alias(a) for a in attributes
    ]
    return tuples.groupBy(key).agg(*latest)
