"""Plans and edges of bucketed tables, runtime filters, SQL extracts and batch counts."""

import os

import pytest
from compare import ROOT
from conftest import at, tuples
from pyspark.sql import functions as F

from skyledger.catalog import queries as catalogue
from skyledger.operators.quality import touched_rows, unreferenced
from skyledger.plans.sql_extract import DELTA, export_sql, registered, sql_extract
from skyledger.session import runtime_filters
from skyledger.sources.bucketed import BucketedTable
from skyledger.sources.connect import read_messages
from skyledger.sources.store import Warehouse
from skyledger.streaming.ingest import staging_sink, start_ingest
from skyledger.streaming.metrics import BatchCounts

LARGE = f"{ROOT}/sf0.1"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# bucketed tables -------------------------------------------------------------------------


@pytest.fixture
def bucketed(spark, tmp_path):
    made = BucketedTable(spark, "fact_test", str(tmp_path / "fact"), "k", buckets=4)
    yield made
    for version in range(4):
        made.drop(version)


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v string, n long")


def test_stored_rows_are_not_shuffled(spark, bucketed):
    bucketed.write(rows_of(spark, *[(f"k{i}", "old", i) for i in range(100)]), 0)
    incoming = rows_of(spark, ("k1", "new", None), ("x", "new", 1))
    plan = plan_of(bucketed.upserted(0, incoming))
    stored, arriving = plan.split("SortMergeJoin")[1].split("Scan ExistingRDD")[0], plan
    assert "Bucketed: true" in stored and "SelectedBucketsCount: 4 out of 4" in stored
    # the one exchange is that of the incoming rows
    assert arriving.count("Exchange hashpartitioning") == 1
    assert "Exchange" not in plan_of(bucketed.repeated(0)).split("== Initial")[0]


def test_the_result_lies_in_the_same_buckets(spark, bucketed):
    bucketed.write(rows_of(spark, *[(f"k{i}", "old", i) for i in range(100)]), 0)
    after = bucketed.upsert(0, rows_of(spark, ("k1", "new", None), ("x", None, 1)))
    assert after.count() == 101
    assert tuples(after.where("k IN ('k1', 'k2', 'x')")) == [
        ("k1", "new", None), ("k2", "old", 2), ("x", None, 1)]
    # a bucket is one file: no task wrote beside another
    assert len(after.inputFiles()) <= 4
    bucketed.drop(0)
    assert bucketed.repeated(1).isEmpty()


def test_an_attempt_is_replaced_and_a_version_attached(spark, bucketed):
    bucketed.write(rows_of(spark, ("a", "lost", 1), ("b", "lost", 1)), 2)
    bucketed.write(rows_of(spark, ("a", "kept", 1), ("a", "twice", 1)), 2)
    assert tuples(bucketed.read(2), "v") == [("kept",), ("twice",)]
    assert tuples(bucketed.repeated(2)) == [("a", 2)]
    other = BucketedTable(spark, "fact_again", bucketed.root, "k", 4)
    assert tuples(other.attach(2, "k string, v string, n long"), "v") == [("kept",), ("twice",)]
    assert "Bucketed: true" in plan_of(other.repeated(2))
    spark.sql("DROP TABLE fact_again_v2")


def test_empty_sides(spark, bucketed):
    bucketed.write(rows_of(spark), 0)
    after = bucketed.upsert(0, rows_of(spark, ("a", None, None)))
    assert tuples(after) == [("a", None, None)]
    assert tuples(bucketed.upsert(1, rows_of(spark))) == [("a", None, None)]


# runtime filters -------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="no tables")
@pytest.mark.parametrize("name", ["dq_touched_lines", "dq_lost_lines"])
def test_keys_filter_the_scan_before_the_shuffle(spark, name):
    plan = catalogue.QUERIES[name](spark, LARGE)._jdf.queryExecution().executedPlan().toString()
    assert "might_contain" in plan and "bloom_filter_agg" in plan
    # the filter is below the exchange of the side it is applied to
    assert plan.index("Exchange hashpartitioning") < plan.index("might_contain")


def test_checks_keep_nulls_and_repeats(spark, table):
    runtime_filters(spark.newSession(), scan_bytes="1")
    stored = table("k long, v string", (1, "a"), (1, "b"), (2, "c"), (None, "d"))
    incoming = table("i long", (1,), (1,), (None,), (9,))
    assert tuples(touched_rows(stored, incoming.where("i < 100"), "k", "i")) == [
        (1, "a"), (1, "b")]
    assert tuples(unreferenced(stored, "k", incoming, "i")) == [(2, "c")]
    nothing = table("i long")
    assert tuples(unreferenced(stored, "k", nothing, "i"), "v") == [("a",), ("b",), ("c",)]
    assert touched_rows(stored, nothing, "k", "i").isEmpty()


# SQL extracts ----------------------------------------------------------------------------


def test_values_are_bound_and_never_text(spark, table):
    rows = table("k string, n long", ("a", 1), ("b' OR '1'='1", 2))
    found = sql_extract("SELECT n FROM t WHERE k = :k", {"t": rows}, k="b' OR '1'='1")
    assert tuples(found) == [(2,)]
    assert tuples(sql_extract("SELECT n FROM t WHERE k = :k", {"t": rows}, k="x' OR 1=1")) == []


def test_names_are_given_back(spark, table):
    mine, theirs = table("n long", (1,)), table("n long", (2,))
    theirs.createOrReplaceTempView("taken")
    with registered({"taken": mine, "fresh": mine}):
        assert tuples(spark.table("taken")) == tuples(spark.table("fresh")) == [(1,)]
    assert tuples(spark.table("taken")) == [(2,)]
    assert not spark.catalog.tableExists("fresh")
    spark.catalog.dropTempView("taken")


def test_an_extract_of_the_warehouse(spark, tmp_path, staged):
    from test_jobs import SAMPLE, put

    from skyledger.plans.load import run_load

    house = Warehouse(spark, str(tmp_path / "house"))
    put(house, staged(SAMPLE, {**SAMPLE, "flight_key": "Z", "ingest_time": at("2025-03-04 12:00")}), 0)
    run_load(spark, house.root)
    out = str(tmp_path / "out")
    export_sql(spark, house.root, out, DELTA, last=at("2025-03-04 10:00"), last_key="Y",
               target=at("2025-03-04 13:00"), limit=5)
    read = spark.read.option("header", True).csv(out)
    assert tuples(read, "flight_key", "airline_name", "dep_airport_name") == [
        ("Z", "Quill Air", "Oslo Gardermoen")]


# counts ----------------------------------------------------------------------------------


def test_counts_of_batches(spark, tmp_path):
    from test_stream import message

    topic, counts = str(tmp_path / "topic"), BatchCounts()
    house = Warehouse(spark, str(tmp_path / "house"))
    broken = (bytearray(b"{no"),)
    for values in ([message("A"), broken], [message("B", partial_parse=True)], [broken]):
        spark.createDataFrame(values, "value binary").coalesce(1).write.mode("append").parquet(topic)
    spark.streams.addListener(counts)
    try:
        for _ in range(2):  # the second run finds nothing new
            running = start_ingest(
                read_messages(spark, {"maxFilesPerTrigger": "1"}, fmt="parquet", path=topic),
                staging_sink(house.staging_path, house.rejects_path), str(tmp_path / "p"),
                trigger={"availableNow": True})
            running.awaitTermination()
            counts.wait_for(running)
    finally:
        spark.streams.removeListener(counts)
    found = counts.frame(spark)
    assert tuples(found.drop("stream")) == [(0, 2, 1, 1, 0), (1, 1, 1, 0, 1), (2, 1, 0, 1, 0)]
    assert found.select("stream").distinct().count() == 1
    totals = house.staged().groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    assert tuples(totals) == [(0, 1), (1, 1)]
    with pytest.raises(TimeoutError):
        BatchCounts().wait_for(running, 0.01)
