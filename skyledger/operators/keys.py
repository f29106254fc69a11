"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import materialize


def highest_id(df: DataFrame, column: str) -> Column:
    """Greatest id, 0 for no rows, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("top")).scalar()


def assign_ids(
    rows: DataFrame, column: str, order: list[str], start: Column | int = 0
) -> DataFrame:
    """Number ``rows`` densely from ``start + 1`` in the order of the columns ``order``.

    ``order`` must identify a row. The rows are range partitioned and sorted inside their
    partitions; position and partition are fixed by one write to the shared folder, so that a
    lost executor cannot renumber them. Only the row counts per partition pass through one task.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    # the generated value holds the partition above bit 33 and the position below
    placed = materialize(
        rows.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_place", F.monotonically_increasing_id())
    ).select(
        *rows.columns,
        F.shiftright("_place", 33).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)).alias("_position"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    number = F.lit(start) + F.col("_offset") + F.col("_position") + F.lit(1)
    # one row per partition of the rows, which bounds the broadcast
    return placed.join(F.broadcast(offsets), "_part").select(
        number.cast("long").alias(column), *rows.columns
    )
