"""Row counts per micro-batch, observed while the batch runs."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

INGEST = "ingest"
COUNTS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        *[T.StructField(n, T.LongType())
          for n in ("batch_id", "total", "good", "rejected", "partial")],
    ]
)


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def observed(rows: DataFrame) -> DataFrame:
    """Decoded rows that count themselves: no further pass over the batch."""
    good = F.col("reject_reason").isNull()
    return rows.observe(
        INGEST,
        F.count(F.lit(1)).alias("total"),
        _count(good).alias("good"),
        _count(~good).alias("rejected"),
        _count(good & F.coalesce("partial_parse", F.lit(False))).alias("partial"),
    )


class BatchCounts(StreamingQueryListener):
    """Keeps the counts of the streams' micro-batches; a replayed batch counts once.

    Add it with ``spark.streams.addListener``. It sees the batches that run from then on, one
    entry of five numbers each.
    """

    def __init__(self) -> None:
        self._counts: dict[tuple[str, int], tuple[int, ...]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(INGEST)
        if found is not None and found["total"]:
            key = (str(progress.id), progress.batchId)
            self._counts[key] = tuple(found[n] for n in COUNTS.fieldNames()[2:])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the events of a query that has ended are here: they come after its batches."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError("the end of the stream was not reported")

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(stream, number, *counts)
                for (stream, number), counts in sorted(self._counts.items())]
        return spark.createDataFrame(rows, COUNTS)
