"""Sources and sinks: message topics, landed pages, databases and extract files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.normalize import parse_pages
from skyledger.schemas import JDBC_BATCH_ROWS

MESSAGE = T.StructType([T.StructField("value", T.BinaryType())])


def kafka_options(servers: str, topic: str, starting: str = "earliest", **more: str) -> dict:
    """Options of a topic source. ``starting`` counts only while there is no checkpoint."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        **more,
    }


def read_messages(
    spark: SparkSession,
    options: Mapping[str, str],
    fmt: str = "kafka",
    path: str | None = None,
    schema: T.StructType = MESSAGE,
) -> DataFrame:
    """Stream with a binary ``value`` column. File formats take a ``path`` and the schema."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def kafka_writer(
    messages: DataFrame, servers: str, topic: str, **more: str
) -> DataFrameWriter:
    """Writer of ``key`` and ``value`` bytes to a topic; call ``save`` on it."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", **more}
    return messages.write.format("kafka").options(**options)


def read_pages(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed API pages, one per line or one per file, as ``parse_pages`` gives them.

    A line or file that is no page stays as a row to be rejected: so does every line of a page
    that was printed over several lines and is read without ``whole_files``. Blank lines go.
    """
    text = spark.read.text(path, wholetext=whole_files)
    return parse_pages(text.where(F.trim("value") != ""))


def jdbc_writer(
    df: DataFrame,
    url: str,
    table: str,
    batch_rows: int = JDBC_BATCH_ROWS,
    isolation: str = "READ_COMMITTED",
    **properties: str,
) -> DataFrameWriter:
    """Appending database writer; call ``save`` on it. Credentials come as properties."""
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "isolationLevel": isolation,
        **properties,
    }
    return df.write.format("jdbc").options(**options).mode("append")


def jdbc_reader(
    spark: SparkSession, url: str, table: str, **properties: str
) -> DataFrameReader:
    """Reader of a database table; call ``load`` on it. Split a large one by passing
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **properties)


def write_extract(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Replace the extract at ``path``; CSV gets a header line."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
