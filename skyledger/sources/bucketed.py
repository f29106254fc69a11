"""A table bucketed by its key: upserts and key checks do not shuffle what is stored.

For a fact whose loads touch most of its days, where replacing days means replacing all: the
stored rows lie in buckets by key, sorted, so they meet incoming rows where they are and the
result is written in the same buckets. Only incoming rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.files import Folder


class BucketedTable:
    """Versions of a table below a folder; the catalog has the current one.

    Buckets are known to the catalog alone. ``attach`` declares a stored version to a session
    with another catalog.
    """

    def __init__(self, spark: SparkSession, name: str, root: str, key: str, buckets: int):
        self.spark, self.name, self.root = spark, name, root.rstrip("/")
        self.key, self.buckets = key, buckets

    def _path(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def _table(self, version: int) -> str:
        return f"{self.name}_v{version}"

    def write(self, rows: DataFrame, version: int) -> DataFrame:
        """Store ``rows`` as a version; replaces what an attempt before has left of it."""
        self.drop(version)
        (
            rows.write.format("parquet").mode("overwrite")
            .bucketBy(self.buckets, self.key).sortBy(self.key)
            .option("path", self._path(version)).saveAsTable(self._table(version))
        )
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        return self.spark.table(self._table(version))

    def attach(self, version: int, columns: str) -> DataFrame:
        """Declare a stored version with the columns ``name type, ...``."""
        self.spark.sql(f"""CREATE TABLE IF NOT EXISTS {self._table(version)} ({columns})
            USING parquet CLUSTERED BY ({self.key}) SORTED BY ({self.key})
            INTO {self.buckets} BUCKETS LOCATION '{self._path(version)}'""")
        return self.read(version)

    def drop(self, version: int) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(version)}")
        Folder(self.spark, self._path(version)).delete("")

    def upserted(self, version: int, incoming: DataFrame) -> DataFrame:
        """Stored rows, those of an incoming key replaced as a whole, and new ones.

        ``incoming`` has each key once. One full join by key: the stored side is read bucket by
        bucket, and the result lies in the same buckets.
        """
        stored = self.read(version)
        columns = stored.columns
        old = stored.select(self.key, F.struct(*columns).alias("old"))
        new = incoming.select(self.key, F.struct(*columns).alias("new"))
        both = old.join(new.hint("merge"), self.key, "full")
        return both.select(F.coalesce("new", "old").alias("row")).select("row.*")

    def upsert(self, version: int, incoming: DataFrame) -> DataFrame:
        """Store the upserted rows as the next version."""
        return self.write(self.upserted(version, incoming), version + 1)

    def repeated(self, version: int) -> DataFrame:
        """Keys that are stored more than once, by an aggregate inside the buckets."""
        return self.read(version).groupBy(self.key).agg(
            F.count(F.lit(1)).alias("copies")).where("copies > 1")
