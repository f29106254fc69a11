"""Joins of a large table with a lookup table."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
MOST_SALTS = 1024
# Rows with a null key match nothing: they may go to any number of tasks.
NULL_SALTS = 1 << 20


def _row_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row's size: 16 bytes per field and the length of each text."""
    parts = [F.lit(16 * len(df.columns)).cast("long")]
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)).cast("long"))
    return reduce(lambda a, b: a + b, parts)


def measured_bytes(*frames: DataFrame) -> list[int]:
    """Size of each frame, by one distributed aggregate over all."""
    sizes = [
        df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"), F.lit(i).alias("frame"))
        for i, df in enumerate(frames)
    ]
    found = reduce(DataFrame.unionAll, sizes).collect()
    return [row["bytes"] for row in sorted(found, key=lambda row: row["frame"])]


def salts_for(rows: DataFrame, on: list[str]) -> int:
    """Salts that divide the most frequent key to about an even task's share.

    Counts keys by one aggregate with a partial step, so a hot key costs a row per task.
    """
    count = rows.dropna(subset=on).groupBy(*on).count()
    most, total = count.agg(F.max("count"), F.sum("count")).first()
    if not total:
        return 1
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MOST_SALTS, math.ceil(most / total * tasks)))


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    spread: list[str] | None = None,
    size: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
    salts: int | None = None,
) -> DataFrame:
    """Equi-join of ``rows`` with a lookup on the columns ``on``, which both sides have.

    The lookup is broadcast only if its measured size is within ``max_bytes``. A larger one is
    joined by a shuffle on the key and a salt: the salt comes from the ``spread`` columns of
    ``rows`` (all columns where none are named) and the lookup is repeated once per salt, so a
    key that holds a large part of the rows is divided over ``salts`` tasks, by its measured
    share where no number is given. Rows with a null key meet no lookup row and are spread over
    all tasks. Each row meets every lookup row of its key exactly once either way.

    The lookup is read once more for its size unless ``size`` brings it: pass a stored table.
    """
    if size is None:
        [size] = measured_bytes(lookup)
    if size <= max_bytes:
        return rows.join(F.broadcast(lookup), on, how)
    salts = salts or salts_for(rows, on)
    place = F.xxhash64(*(spread or rows.columns))
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    salt = F.when(no_key, F.pmod(place, F.lit(NULL_SALTS))).otherwise(F.pmod(place, F.lit(salts)))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    joined = rows.withColumn("_salt", salt.cast("int")).join(
        lookup.withColumn("_salt", every_salt), [*on, "_salt"], how
    )
    return joined.drop("_salt")
