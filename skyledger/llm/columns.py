"""Column expressions and helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


# Rows that travel to Python at a time: texts are long, so a worker holds a few MB of them.
BATCH_ROWS = 1000


def ready(spark: SparkSession) -> SparkSession:
    """Settings that the operators on texts rely on for bounded memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Runs of anything but blanks, in order; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), "")


def count_chars(text: Column, chars: str) -> Column:
    """How often any of ``chars`` is in the text."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def replace(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with result columns at the end; an input column of the same name gives way."""
    kept = [F.col(f"`{name}`") for name in df.columns if name not in columns]
    return df.select(*kept, *[column.alias(name) for name, column in columns.items()])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)
