"""Continuous ingest: message stream to staging, and on to the warehouse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators.decode import decode
from skyledger.operators.quality import split_rejects
from skyledger.plans.load import run_load
from skyledger.schemas import STAGED
from skyledger.session import materialize, scratch_tables
from skyledger.sources.store import Warehouse, replace_partitions
from skyledger.streaming.metrics import observed

# Takes the rows, the stream's id and the batch number of a micro-batch.
BatchSink = Callable[[DataFrame, str, int], None]


def staging_sink(staging: str, rejects: str) -> BatchSink:
    """Writes good and rejected rows of a batch as partitions of its stream and number.

    A replayed batch replaces what its first run wrote. A stream under a fresh checkpoint and a
    second stream write beside what is there: batch numbers begin at 0 in every checkpoint, so
    only with the stream they name a batch.
    """

    def write(rows: DataFrame, stream: str, batch_id: int) -> None:
        of_batch = {"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("long")}
        # two writes from one batch: without this it would be read and decoded twice. The text of
        # a good row is not looked at, so the table is far smaller than the batch
        text = F.when(F.col("reject_reason").isNotNull(), F.col("raw")).alias("raw")
        with scratch_tables(rows.sparkSession):
            decoded = materialize(rows.select(*STAGED.fieldNames(), "reject_reason", text))
            good, rejected = split_rejects(decoded)
            rejected = rejected.select(F.col("reject_reason").alias("reason"), "raw")
            for part, path in ((rejected, rejects), (good.select(STAGED.fieldNames()), staging)):
                replace_partitions(part.withColumns(of_batch), path, *of_batch)

    return write


def loading_sink(house: Warehouse, **options: bool) -> BatchSink:
    """Stages a batch and loads it in the same step; ``options`` are those of ``run_load``.

    The batch is known by its stream and number: one that is replayed after its load is staged
    again, with the same rows, but not loaded again.
    """
    stage = staging_sink(house.staging_path, house.rejects_path)

    def write(rows: DataFrame, stream: str, batch_id: int) -> None:
        stage(rows, stream, batch_id)
        run_load(house.spark, house.root, batches=[(stream, batch_id)], **options)

    return write


def start_ingest(
    messages: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    default_ingest: Column | None = None,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start the query that decodes ``messages`` and hands each micro-batch to ``sink``; a
    ``BatchCounts`` listener gets the counts of its rows.

    ``checkpoint`` must outlive the driver; Spark also keeps there the id of the stream, which a
    restart goes on with and a fresh checkpoint gets anew. ``trigger`` holds the arguments of the stream's
    trigger, such as ``{"availableNow": True}``; the default runs batches back to back.
    """
    rows = observed(decode(messages, default_ingest=default_ingest))

    def hand_over(batch: DataFrame, number: int) -> None:
        context = batch.sparkSession.sparkContext
        sink(batch, context.getLocalProperty("sql.streaming.queryId"), number)

    writer = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(hand_over)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()
