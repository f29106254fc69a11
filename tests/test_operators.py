"""Folding, keys, upserts, joins and constraints."""

import os
import random

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from skyledger.operators.fact import key_day, latest_status
from skyledger.operators.fold import latest_non_null, latest_per_key
from skyledger.operators.joins import lookup_join, measured_bytes, salts_for
from skyledger.operators.keys import assign_ids, highest_id
from skyledger.operators.quality import duplicates, orphans, split_rejects, with_reject_reason
from skyledger.operators.upsert import insert_missing, upsert_coalesce, upsert_overwrite
from skyledger.session import drop_scratch, materialize


def test_latest_row_wins(staged):
    df = staged(
        {"flight_key": "A", "status": "active", "ingest_time": at("2025-08-21 10:00")},
        {"flight_key": "A", "status": "landed", "ingest_time": at("2025-08-21 10:05")},
        {"flight_key": "B", "status": "active", "dep_gate": None},
    )
    assert tuples(latest_status(df), "flight_key", "status") == [("A", "landed"), ("B", "active")]


def test_nulls_of_the_winner_stay(table):
    df = table("k string, t int, v string", ("A", 1, "old"), ("A", 2, None))
    assert tuples(latest_per_key(df, ["k"], ["t"])) == [("A", 2, None)]


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [("A", 1, b, v, g) for b in (1, 2) for v in ("x", "y", None) for g in (None, "1")]
    winners = set()
    for seed in range(5):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, t int, batch int, v string, g string")
        winners.add(tuple(latest_per_key(df.repartition(4), ["k"], ["t", "batch"]).first()))
    assert winners == {("A", 1, 2, "y", "1")}


def test_latest_non_null_value_per_attribute(table):
    df = table(
        "iata string, icao string, name string, t int",
        ("NH", None, "ANA", 1), ("NH", "ANA", "All Nippon", 2), ("NH", None, None, 3),
        (None, "XXX", "lost", 9), ("JL", None, None, 1),
    )
    got = tuples(latest_non_null(df, "iata", ["icao", "name"], "t"))
    assert got == [("JL", None, None), ("NH", "ANA", "All Nippon")]


@pytest.mark.parametrize("partitions", [1, 7])
def test_ids_are_dense_and_in_key_order(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        keys = [f"K{i * 7919 % 500:03d}" for i in range(500)]
        df = spark.createDataFrame([(k,) for k in keys], "k string")
        got = tuples(assign_ids(df, "id", ["k"], start=10), "k", "id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == [(k, i + 11) for i, k in enumerate(sorted(keys))]


def test_ids_put_missing_codes_last_and_take_a_start_from_a_table(table):
    df = table("a string, b string", (None, "Z"), ("X", None), (None, "Y"))
    old = table("id long", (4,), (2,))
    got = tuples(assign_ids(df, "id", ["a", "b"], highest_id(old, "id")), "id", "a", "b")
    assert got == [(5, "X", None), (6, None, "Y"), (7, None, "Z")]
    none = table("id long")
    assert tuples(assign_ids(df, "id", ["a", "b"], highest_id(none, "id")), "id") == [
        (1,), (2,), (3,)]


def test_ids_of_no_rows(table):
    assert assign_ids(table("a string"), "id", ["a"]).count() == 0


def test_overwrite_replaces_the_row_and_keeps_the_rest(table):
    schema = "k string, t int, v string"
    target = table(schema, ("A", 5, "a"), ("B", 5, "b"))
    source = table(schema, ("A", 4, None), ("C", 1, "c"))
    assert tuples(upsert_overwrite(target, source, ["k"])) == [
        ("A", 4, None), ("B", 5, "b"), ("C", 1, "c")]
    assert tuples(upsert_overwrite(target, source, ["k"], newer_only="t")) == [
        ("A", 5, "a"), ("B", 5, "b"), ("C", 1, "c")]


def test_coalesce_keeps_old_values_and_ids(table):
    target = table("id long, k string, v string", (1, "A", "a"), (2, None, "n"))
    source = table("k string, v string", ("A", None), ("B", "b"), (None, "m"))
    got = tuples(upsert_coalesce(target, source, ["k"], ["v"]))
    assert got == [(1, "A", "a"), (2, None, "n"), (None, "B", "b"), (None, None, "m")]


def test_insert_missing_keeps_null_keys(table):
    target = table("k string", ("A",), (None,))
    source = table("k string, v int", ("A", 1), ("B", 2), (None, 3))
    assert tuples(insert_missing(target, source, ["k"])) == [("B", 2), (None, 3)]


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_salted_lookup_equals_broadcast_lookup(spark, how):
    # a third of the rows on one key, many null keys, a key without a lookup row
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 50}")
            for i in range(3000)]
    big = spark.createDataFrame(rows, "id int, k string")
    lookup = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(30)],
                                   "k string, v int")
    small = lookup_join(big, lookup, ["k"], how)
    salted = lookup_join(big, lookup, ["k"], how, spread=["id"], max_bytes=0)
    assert tuples(small.select(sorted(small.columns))) == tuples(
        salted.select(sorted(salted.columns)))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_divided_by_the_salt(spark):
    big = spark.range(8000).select("id", F.lit("hot").alias("k"))
    lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(big, lookup, ["k"], spread=["id"], max_bytes=0)
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 8000
    assert sum(r["count"] for r in per_task) == 8000


def test_salts_follow_the_share_of_the_hottest_key(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") < 300, "hot").when(F.col("id") < 600, F.lit(None))
        .otherwise(F.col("id").cast("string")).alias("k"))
    # half of the rows with a key, of four tasks
    assert salts_for(rows, ["k"]) == 2
    assert salts_for(rows.where("k is null"), ["k"]) == 1


def test_null_keys_are_spread_without_copies_of_the_lookup(spark):
    big = spark.range(8000).select("id", F.lit(None).cast("string").alias("k"))
    lookup = spark.createDataFrame([("a", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(big, lookup, ["k"], spread=["id"], max_bytes=0, salts=1)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per_task) == 8000 and len(per_task) == 4 and max(per_task) < 3000


def test_scratch_tables_can_be_dropped(spark):
    stored = materialize(spark.range(3))
    [folder] = {f.rsplit("/", 1)[0] for f in stored.inputFiles()}
    path = folder.removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(path)
    drop_scratch()
    assert not os.path.isdir(path)


def test_measured_size_bounds_the_texts(spark):
    df = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "a string, b int")
    empty = df.where("b > 5")
    sizes = measured_bytes(df, empty)
    assert sizes[0] >= 1000 and sizes[1] == 0


def test_constraints(staged, table):
    df = table("a int, b int", (1, 1), (1, 1), (1, 2), (None, 1), (None, 1))
    assert tuples(duplicates(df, ["a", "b"])) == [(1, 1, 2)]
    child = table("id int, fk int", (1, 1), (2, 9), (3, None))
    assert tuples(orphans(child, "fk", table("pk int", (1,), (2,)), "pk"), "id") == [(2,)]
    rows = staged(
        {"flight_key": "A", "dep_delay_min": 0.0}, {"flight_key": None},
        {"flight_key": "B", "ingest_time": None}, {"flight_key": "C", "arr_delay_min": -1.0},
    )
    good, bad = split_rejects(with_reject_reason(rows))
    assert tuples(good, "flight_key") == [("A",)]
    assert tuples(bad, "reject_reason") == [("flight_key",), ("ingest_time",), ("negative_delay",)]


def test_storage_day_depends_on_the_key_alone(spark):
    df = spark.createDataFrame(
        [("QX512_2025-03-04T13:40:00+00:00",), ("a_b_2024-02-29T00:00:00+00:00",),
         ("free text",), ("x_2025-02-30T00:00:00+00:00",),
         ("x_9025-02-03T00:00:00+00:00",)], "k string")
    got = [r[0] for r in df.select(key_day(F.col("k"), 8)).collect()]
    assert got[:2] == ["2025-03-04", "2024-02-29"]
    assert all(g.startswith("key-") for g in got[2:])
