"""Warehouse tables: Parquet folders, partitioned by what loads and readers select."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.fact import KEY_BUCKETS, key_day
from skyledger.schemas import (
    DIM_AIRLINE,
    DIM_AIRPORT,
    DIM_ROUTE,
    FACT,
    QUARANTINE,
    REJECTS,
    STAGED,
)
from skyledger.sources.files import Folder

DIMENSIONS = {"dim_airline": DIM_AIRLINE, "dim_airport": DIM_AIRPORT, "dim_route": DIM_ROUTE}
BATCH = T.StructType(
    [T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())]
)
LOAD = T.StructField("load_id", T.LongType())
DAY = T.StructField("key_day", T.StringType())
EXPORTED = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("rows", T.LongType()),
        # the last change that is out; without a key all changes of its load are
        LOAD,
        T.StructField("ingest_time", T.TimestampType()),
        T.StructField("flight_key", T.StringType()),
        T.StructField("export_id", T.LongType()),
    ]
)
# A stream's id and the number of a batch in it.
Batch = tuple[str, int]


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Write ``df``; partitions that it has rows of are replaced, the others stay."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns).parquet(path)
    )


class Warehouse:
    """All tables of a warehouse below one folder.

    - ``staging`` and ``rejects``, partitioned by stream and batch;
    - ``loads``, the batches that each load has consumed, partitioned by ``load_id``: a load
      counts from when its partition is there;
    - the dimensions and ``quarantine``, a partition per load: the last load's is the current;
    - ``fact``, partitioned by ``key_day``, a function of the key alone: an upsert replaces the
      days that it touches. A row has the ``load_id`` that changed it last.
    - ``exports_full`` and ``exports_delta``, what was written by each export.
    """

    def __init__(self, spark: SparkSession, root: str, key_buckets: int = KEY_BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        self.key_buckets = key_buckets
        self.folder = Folder(spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, *parts: T.StructType | T.StructField) -> DataFrame:
        """A table as stored, empty if nothing was written yet."""
        fields = [f for p in parts for f in (p.fields if isinstance(p, T.StructType) else [p])]
        schema = T.StructType(fields)
        if not self.folder.has(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(name))

    # staging ---------------------------------------------------------------------------------

    @property
    def staging_path(self) -> str:
        return self.path("staging")

    @property
    def rejects_path(self) -> str:
        return self.path("rejects")

    def staged(self) -> DataFrame:
        return self.table("staging", STAGED, BATCH)

    def rejects(self) -> DataFrame:
        return self.table("rejects", REJECTS, BATCH)

    def loads(self) -> DataFrame:
        return self.table("loads", BATCH, LOAD)

    def _batches(self, rows: DataFrame) -> list[Batch]:
        """Bounded by the batches that were staged since the last purge."""
        return [tuple(r) for r in rows.select("stream", "batch_id").distinct().sort(
            "stream", "batch_id").collect()]

    def staged_batches(self) -> list[Batch]:
        return self._batches(self.staged())

    def pending_batches(self) -> list[Batch]:
        """Staged batches that no load has consumed."""
        staged = self.staged().select("stream", "batch_id").distinct()
        return self._batches(staged.join(self.loads(), ["stream", "batch_id"], "left_anti"))

    def staging(self, batches: list[Batch]) -> DataFrame:
        """Rows of the batches; other partitions are not read."""

        def of(stream: str) -> Column:
            numbers = [n for s, n in batches if s == stream]
            return (F.col("stream") == stream) & F.col("batch_id").isin(numbers)

        wanted = reduce(Column.__or__, map(of, sorted({s for s, _ in batches})), F.lit(False))
        return self.staged().where(wanted)

    def purge_staging(self) -> list[Batch]:
        """Drop the staging partitions of batches that a load has consumed."""
        staged = self.staged().select("stream", "batch_id").distinct()
        gone = self._batches(staged.join(self.loads(), ["stream", "batch_id"], "left_semi"))
        for stream, number in gone:
            self.folder.delete(f"staging/stream={stream}/batch_id={number}")
        return gone

    # tables ----------------------------------------------------------------------------------

    def load_id(self) -> int:
        """Number of the last load, 0 before the first."""
        return self.loads().agg(F.max("load_id")).first()[0] or 0

    def dimension(self, name: str, load_id: int | None = None) -> DataFrame:
        load_id = self.load_id() if load_id is None else load_id
        rows = self.table(name, DIMENSIONS[name], LOAD)
        return rows.where(F.col("load_id") == load_id).drop("load_id")

    def quarantine(self, load_id: int | None = None) -> DataFrame:
        """Distinct airports that any load has set aside."""
        load_id = self.load_id() if load_id is None else load_id
        rows = self.table("quarantine", QUARANTINE, LOAD)
        return rows.where(F.col("load_id") <= load_id).drop("load_id").distinct()

    def write_snapshot(self, name: str, rows: DataFrame, load_id: int) -> DataFrame:
        """Store the rows of one load and return them as stored, so ids are read and not computed
        again. A load that is tried again replaces what it wrote before."""
        path = self.path(f"{name}/load_id={load_id}")
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def fact(self, days: list[str] | None = None) -> DataFrame:
        """Fact rows with ``load_id`` and ``key_day``, of all days or of ``days``."""
        rows = self.table("fact", FACT, LOAD, DAY)
        return rows if days is None else rows.where(F.col("key_day").isin(days))

    def day_of(self, key: Column) -> Column:
        return key_day(key, self.key_buckets)

    def upsert_fact(self, rows: DataFrame, load_id: int) -> None:
        """Replace the days of ``rows``: stored rows whose key is not among them stay.

        The rows are written beside the old ones and moved when all are there. Rebalancing
        splits a day that holds much over several files and joins small days.
        """
        incoming = rows.select(
            *FACT.fieldNames(), F.lit(load_id).cast("long").alias("load_id"),
            self.day_of(F.col("flight_key")).alias("key_day"))
        # bounded by the calendar and the number of key buckets
        days = [r[0] for r in incoming.select("key_day").distinct().collect()]
        kept = self.fact(days).join(
            incoming.select("key_day", "flight_key"), ["key_day", "flight_key"], "left_anti")
        placed = incoming.unionByName(kept).hint("rebalance", "key_day")
        replace_partitions(
            placed.sortWithinPartitions("key_day", "load_id", "ingest_time"), self.path("fact"),
            "key_day")

    def record_load(self, load_id: int, batches: list[Batch]) -> None:
        """The last step of a load: from here on its tables are the current ones."""
        rows = self.spark.createDataFrame(batches, BATCH).coalesce(1)
        replace_partitions(
            rows.withColumn("load_id", F.lit(load_id).cast("long")), self.path("loads"), "load_id")

    # exports ---------------------------------------------------------------------------------

    def last_export(self, kind: str) -> dict | None:
        """What the last export of the kind ``full`` or ``delta`` wrote."""
        rows = self.table(f"exports_{kind}", EXPORTED)
        last = rows.orderBy(F.desc("export_id")).first()
        return last.asDict() if last else None

    def record_export(self, kind: str, export: dict) -> None:
        rows = self.spark.createDataFrame([export], EXPORTED).coalesce(1)
        replace_partitions(rows, self.path(f"exports_{kind}"), "export_id")

    # retention -------------------------------------------------------------------------------

    def drop_old_snapshots(self, keep: int = 10) -> None:
        """Delete the dimensions' partitions of loads but the last ``keep``."""
        if keep < 1:
            raise ValueError("keep at least one state")
        last = self.load_id()
        for name in DIMENSIONS:
            for part in self.folder.names(f"{name}/load_id=*"):
                if int(part.split("=")[1]) <= last - keep:
                    self.folder.delete(f"{name}/{part}")
