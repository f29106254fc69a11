"""Streaming ingest and the connectors' contracts."""

import json

import pytest
from conftest import tuples

from skyledger.operators.decode import decode
from skyledger.plans.load import run_load
from skyledger.schemas import STAGED
from skyledger.sources.connect import (
    jdbc_writer,
    kafka_options,
    kafka_writer,
    read_messages,
)
from skyledger.sources.store import Warehouse
from skyledger.streaming.ingest import loading_sink, staging_sink, start_ingest


def message(key, **changes):
    body = {"flight_key": key, "flight_date": "2025-08-21", "status": "active",
            "ingest_time": "2025-08-21T00:05:00.123456+00:00", **changes}
    return (bytearray(json.dumps(body).encode()),)


@pytest.fixture
def place(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))

    def ingest(progress="progress", topic="topic"):
        source = read_messages(spark, {"maxFilesPerTrigger": "1"}, fmt="parquet",
                               path=str(tmp_path / topic))
        query = start_ingest(
            source,
            staging_sink(house.staging_path, house.rejects_path),
            str(tmp_path / progress),
            trigger={"availableNow": True},
            name=progress,
        )
        query.awaitTermination()

    def send(*values, topic="topic"):
        spark.createDataFrame(list(values), "value binary").coalesce(1).write.mode(
            "append").parquet(str(tmp_path / topic))

    return house, ingest, send


def test_stream_to_staging_and_rejects(spark, place):
    house, ingest, send = place
    send(message("A_1"), (bytearray(b"{bad"),), message(None))
    ingest()
    [(stream, number)] = house.staged_batches()
    assert number == 0
    assert tuples(house.staging([(stream, 0)]), "flight_key", "stream", "batch_id") == [
        ("A_1", stream, 0)]
    rejects = house.rejects()
    assert tuples(rejects, "reason") == [("flight_key",), ("malformed",)]
    assert ("{bad",) in tuples(rejects, "raw")

    # a restart goes on behind the checkpoint
    send(message("B_1"))
    send(message("C_1"))
    ingest()
    assert house.staged_batches() == [(stream, n) for n in (0, 1, 2)]
    staged = house.staged()
    assert [k for (k,) in tuples(staged, "flight_key")] == ["A_1", "B_1", "C_1"]
    assert run_load(spark, house.root) == 1
    assert tuples(house.loads()) == [(stream, n, 1) for n in (0, 1, 2)]
    assert house.fact().count() == 3


def test_a_replayed_batch_is_stored_once(spark, place):
    house, _, _ = place
    rows = decode(spark.createDataFrame([message("A_1"), (None,)], "value binary"))
    write = staging_sink(house.staging_path, house.rejects_path)
    write(rows, "s", 3)
    write(rows, "s", 3)
    assert house.staging([("s", 3)]).count() == 1
    assert house.rejects().count() == 1


def test_a_fresh_checkpoint_loses_and_doubles_nothing(spark, place):
    house, ingest, send = place
    send(message("A_1"))
    ingest()
    run_load(spark, house.root)
    send(message("A_2"), topic="later")
    ingest("fresh", "later")
    run_load(spark, house.root)
    assert tuples(house.fact(), "flight_key") == [("A_1",), ("A_2",)]
    send(message("A_3"), topic="later")
    ingest("fresh", "later")
    gone = house.purge_staging()
    assert len(gone) == 2 and len({stream for stream, _ in gone}) == 2
    [waiting] = house.staged_batches()
    assert waiting[1] == 1 and waiting not in gone
    run_load(spark, house.root)
    assert tuples(house.fact(), "flight_key") == [("A_1",), ("A_2",), ("A_3",)]


def test_two_streams_into_one_warehouse(spark, place):
    house, ingest, send = place
    send(message("A_1"), (bytearray(b"{bad"),))
    send(message("A_2"), (bytearray(b"{worse"),), topic="other")
    ingest()
    ingest("second", "other")
    assert len(house.staged_batches()) == 2
    assert tuples(house.staged(), "flight_key") == [("A_1",), ("A_2",)]
    assert house.rejects().count() == 2
    run_load(spark, house.root)
    run_load(spark, house.root)
    assert house.fact().count() == 2 and house.pending_batches() == []


def test_each_batch_is_loaded_as_it_arrives(spark, place, tmp_path):
    house, _, send = place
    for status in ("first", "second"):
        send(message("A_1", status=status), message(f"B_{status}"))
    source = read_messages(spark, {"maxFilesPerTrigger": "1"}, fmt="parquet",
                           path=str(tmp_path / "topic"))
    start_ingest(source, loading_sink(house), str(tmp_path / "p"),
                 trigger={"availableNow": True}).awaitTermination()
    assert house.load_id() == 2 and house.pending_batches() == []
    assert [k for (k,) in tuples(house.fact(), "flight_key")] == ["A_1", "B_first", "B_second"]


def test_a_batch_that_is_replayed_after_its_load_is_not_loaded_again(spark, place):
    house, _, _ = place
    rows = decode(spark.createDataFrame([message("A_1")], "value binary"))
    write = loading_sink(house)
    for number in (0, 1, 1, 0):
        write(rows, "s", number)
    assert house.load_id() == 2 and house.staged().count() == 2
    assert tuples(house.fact(), "flight_key", "load_id") == [("A_1", 2)]


def test_staging_rows_need_no_shuffle(spark):
    rows = decode(spark.createDataFrame([message("A_1")], "value binary"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert rows.columns[: len(STAGED)] == STAGED.fieldNames()


class FakeWriter:
    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self


class FakeFrame:
    def __init__(self):
        self.write = FakeWriter()


def test_connector_options():
    assert kafka_options("h:1", "t", maxOffsetsPerTrigger="9") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "9"}
    frame = FakeFrame()
    kafka_writer(frame, "h:1", "t")
    assert frame.write.calls["format"] == "kafka"
    assert frame.write.calls["options"]["topic"] == "t"
    frame = FakeFrame()
    jdbc_writer(frame, "jdbc:x", "t", user="u", password="p")
    assert frame.write.calls == {
        "format": "jdbc", "mode": "append",
        "options": {"url": "jdbc:x", "dbtable": "t", "batchsize": "5000",
                    "isolationLevel": "READ_COMMITTED", "user": "u", "password": "p"}}


def test_an_arrival_has_files_for_every_task_and_is_one_batch(spark, place, tmp_path):
    from skyledger.catalog.queries import _send_by_day

    spark.sql("""SELECT id AS event_id, timestamp_ntz'2024-01-03 00:00:00' AS ts, id AS user_id,
        'view' AS event_type, 1.0D AS value, '{"k": 1}' AS props FROM range(0, 8, 1, 2)
    """).write.parquet(str(tmp_path / "events.parquet"))
    topic = _send_by_day(spark, str(tmp_path), str(tmp_path / "sent"))(0)
    assert len(spark.read.parquet(topic).inputFiles()) == 2
    house = place[0]
    start_ingest(
        read_messages(spark, {}, fmt="parquet", path=topic),
        staging_sink(house.staging_path, house.rejects_path), str(tmp_path / "all"),
        trigger={"availableNow": True}).awaitTermination()
    assert len(house.staged_batches()) == 1 and house.staged().count() == 8
    assert len(house.staged().inputFiles()) == 2
