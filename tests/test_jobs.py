"""Load and export jobs over a warehouse folder."""

import random
from datetime import date

import pytest
from conftest import at, tuples

from skyledger.plans import load as load_plan
from pyspark.sql import functions as F

from skyledger.plans.export import export_delta, export_full
from skyledger.plans.load import ConstraintViolation, run_load
from skyledger.sources.store import Warehouse, replace_partitions

KEY = "QX512_2025-03-04T13:40:00+00:00"
SAMPLE = {
    "flight_key": KEY, "flight_date": date(2025, 3, 4), "status": "active",
    "airline_iata": "QX", "airline_icao": "QXA", "airline_name": "Quill Air",
    "dep_airport": "Oslo Gardermoen", "dep_airport_iata": "OSL", "dep_airport_icao": "ENGM",
    "dep_scheduled": at("2025-03-04 13:40"), "dep_delay_min": 27.0,
    "arr_airport": "Lisbon Portela", "arr_airport_iata": "LIS",
    "arr_airport_icao": "LPPT", "arr_scheduled": at("2025-03-04 18:05"),
}


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"))


def put(house, rows, batch):
    named = rows.withColumns({"stream": F.lit("s"), "batch_id": F.lit(batch)})
    replace_partitions(named.coalesce(1), house.staging_path, "stream", "batch_id")


@pytest.fixture
def stage(house, staged):
    return lambda batch, *rows: put(house, staged(*rows), batch)


def facts(house, *columns):
    return tuples(house.fact(), *(columns or ("flight_key", "status")))


def test_sample_record(spark, house, stage, tmp_path):
    stage(0, SAMPLE)
    assert run_load(spark, house.root) == 1
    assert tuples(house.loads()) == [("s", 0, 1)]
    assert tuples(house.dimension("dim_airline")) == [(1, "QX", "QXA", "Quill Air")]
    assert tuples(house.dimension("dim_airport"), "airport_id", "iata") == [(1, "LIS"), (2, "OSL")]
    assert tuples(house.dimension("dim_route")) == [(1, 2, 1)]
    assert facts(house, "flight_key", "airline_id", "route_id") == [(KEY, 1, 1)]
    assert export_full(spark, house.root, str(tmp_path / "full")) == 1
    row = spark.read.option("header", True).csv(str(tmp_path / "full" / "export_id=1")).first()
    assert row["dep_airport_name"] == "Oslo Gardermoen"
    assert row["arr_airport_name"] == "Lisbon Portela"
    assert row["airline_name"] == "Quill Air"


def test_repeats_of_a_key_in_one_load_and_padded_codes(spark, house, stage):
    later = {**SAMPLE, "status": "landed", "ingest_time": at("2025-03-04 10:05"),
             "airline_iata": " QX ", "dep_airport_iata": " OSL"}
    stage(0, later, SAMPLE)
    run_load(spark, house.root)
    assert facts(house, "status", "airline_id", "route_id") == [("landed", 1, 1)]


def test_ids_stay_and_new_rows_follow(spark, house, stage):
    stage(0, SAMPLE)
    run_load(spark, house.root)
    stage(1, {**SAMPLE, "flight_key": "AA1_2025-03-05T00:00:00+00:00", "airline_iata": "AA",
              "airline_icao": None, "airline_name": None, "arr_airport_iata": "AMS",
              "arr_airport_icao": "EHAM", "arr_airport": None})
    run_load(spark, house.root)
    assert tuples(house.dimension("dim_airline"), "airline_id", "iata") == [(1, "QX"), (2, "AA")]
    assert tuples(house.dimension("dim_airport"), "airport_id", "iata") == [
        (1, "LIS"), (2, "OSL"), (3, "AMS")]
    assert tuples(house.dimension("dim_route")) == [(1, 2, 1), (2, 2, 3)]
    assert facts(house, "airline_id", "route_id") == [(1, 1), (2, 2)]


def test_no_new_batches_change_nothing(spark, house, stage):
    stage(0, SAMPLE)
    assert run_load(spark, house.root) == run_load(spark, house.root) == 1
    assert tuples(house.fact(), "load_id") == [(1,)]


def test_fact_is_overwritten_with_nulls_and_by_older_rows(spark, house, stage):
    stage(0, {**SAMPLE, "dep_actual": at("2025-03-04 14:07")})
    run_load(spark, house.root)
    old = {**SAMPLE, "status": "old", "ingest_time": at("2025-03-04 09:00")}
    stage(1, old)
    run_load(spark, house.root, newer_only=True)
    assert facts(house, "status") == [("active",)]
    stage(2, old)
    run_load(spark, house.root)
    assert facts(house, "status", "dep_actual") == [("old", None)]


def test_a_flight_that_moves_to_another_date_stays_one_row(spark, house, stage):
    stage(0, SAMPLE, {**SAMPLE, "flight_key": "no time in this key"})
    run_load(spark, house.root)
    moved = {"flight_date": date(2025, 3, 5), "status": "moved"}
    stage(1, {**SAMPLE, **moved}, {**SAMPLE, **moved, "flight_key": "no time in this key"})
    run_load(spark, house.root)
    assert facts(house, "flight_key", "status", "flight_date") == [
        (KEY, "moved", date(2025, 3, 5)), ("no time in this key", "moved", date(2025, 3, 5))]


def day_files(house, day):
    return sorted(f for f in house.fact().inputFiles() if f"key_day={day}" in f)


def test_a_load_replaces_only_the_days_it_touches(spark, house, stage):
    other = {**SAMPLE, "flight_key": "X1_2025-03-05T00:00:00+00:00"}
    beside = {**SAMPLE, "flight_key": "X2_2025-03-05T00:00:00+00:00"}
    stage(0, SAMPLE, other, beside)
    run_load(spark, house.root)
    before = {day: day_files(house, day) for day in ("2025-03-04", "2025-03-05")}
    stage(1, {**other, "status": "landed"})
    run_load(spark, house.root)
    assert day_files(house, "2025-03-04") == before["2025-03-04"]
    assert not set(day_files(house, "2025-03-05")) & set(before["2025-03-05"])
    assert facts(house, "flight_key", "status", "load_id") == [
        (KEY, "active", 1), (other["flight_key"], "landed", 2), (beside["flight_key"], "active", 1)]


def test_days_are_pruned(spark, house, stage):
    stage(0, *[{**SAMPLE, "flight_key": f"F_2025-03-0{d}T00:00:00+00:00"} for d in range(1, 6)])
    run_load(spark, house.root)
    plan = house.fact(["2025-03-02"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_day" in plan
    read = house.fact(["2025-03-02"]).select(F.input_file_name()).distinct()
    assert read.count() == 1


def test_quarantine_is_kept_over_loads(spark, house, stage):
    stage(0, SAMPLE)
    run_load(spark, house.root)
    clash = {"dep_airport_iata": "BGO", "dep_airport_icao": "ENGM", "dep_airport": "Bergen"}
    stage(1, {**SAMPLE, **clash})
    run_load(spark, house.root)
    expected = [("BGO", "ENGM", "Bergen", "icao_conflict")]
    assert tuples(house.quarantine()) == expected
    for batch in (2, 3):
        stage(batch, SAMPLE)
        run_load(spark, house.root)
    stage(4, {**SAMPLE, **clash}, {**SAMPLE, **clash, "dep_airport_iata": "TRD"})
    run_load(spark, house.root)
    house.drop_old_snapshots(keep=1)
    assert tuples(house.quarantine()) == [*expected, ("TRD", "ENGM", "Bergen", "icao_conflict")]


def test_routes_by_icao_are_opt_in(spark, house, stage):
    row = {**SAMPLE, "dep_airport_iata": None, "arr_airport_iata": " "}
    stage(0, row)
    run_load(spark, house.root)
    assert facts(house, "route_id") == [(None,)]
    stage(1, row)
    run_load(spark, house.root, icao_fallback=True)
    assert facts(house, "route_id") == [(1,)]


def test_a_batch_that_is_being_written_is_not_seen(spark, house, stage, tmp_path):
    """Spark moves a partition to its place when all its files are there."""
    stage(0, SAMPLE)
    draft = tmp_path / "house" / "staging" / ".spark-staging-x" / "stream=s" / "batch_id=1"
    draft.mkdir(parents=True)
    (draft / "part-0.parquet").write_bytes(b"half")
    assert house.staged_batches() == [("s", 0)]
    run_load(spark, house.root)
    assert facts(house) == [(KEY, "active")]


@pytest.mark.parametrize("step", ["write_snapshot", "upsert_fact", "record_load"])
def test_a_load_that_fails_is_made_up_for(spark, house, stage, monkeypatch, step):
    stage(0, SAMPLE)
    run_load(spark, house.root)
    stage(1, {**SAMPLE, "status": "landed", "airline_iata": "NW", "airline_name": "New"})
    real = getattr(Warehouse, step)

    def fail(self, *args):
        real(self, *args)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, step, fail)
        with pytest.raises(OSError):
            run_load(spark, house.root)
    if step == "record_load":
        assert house.load_id() == 2 and house.pending_batches() == []
    else:
        # a dimension is read as of the last recorded load
        assert house.load_id() == 1 and house.pending_batches() == [("s", 1)]
        assert tuples(house.dimension("dim_airline"), "iata") == [("QX",)]
    if step == "write_snapshot":
        assert facts(house) == [(KEY, "active")]
    stage(2, {**SAMPLE, "flight_key": "late", "airline_iata": "ZZ"})
    run_load(spark, house.root)
    names = house.fact().join(house.dimension("dim_airline"), "airline_id")
    assert tuples(names, "flight_key", "status", "iata") == [
        (KEY, "landed", "NW"), ("late", "active", "ZZ")]
    assert house.fact().count() == 2 and house.pending_batches() == []


def test_broken_rules_stop_the_load(spark, house, stage, monkeypatch):
    stage(0, SAMPLE)
    real = load_plan.merge_routes
    monkeypatch.setattr(
        load_plan, "merge_routes", lambda dim, pairs: real(dim, pairs).unionAll(real(dim, pairs))
    )
    with pytest.raises(ConstraintViolation):
        run_load(spark, house.root)
    assert house.load_id() == 0 and house.fact().isEmpty()


def test_any_split_into_loads_gives_the_same_fact(spark, tmp_path, staged):
    dice = random.Random(7)
    rows = []
    for i in range(40):
        rows.append({
            **SAMPLE, "flight_key": f"F{dice.randrange(6)}_2025-08-2{dice.randrange(3)}T00:00:00",
            "ingest_time": at(f"2025-03-04 10:{i:02d}"), "status": str(i),
            "airline_iata": dice.choice(["QX", "JL", None]),
            "airline_name": dice.choice(["a", "b", None]),
            "dep_airport_iata": dice.choice(["OSL", "NRT"]), "dep_airport_icao": None,
        })
    results = []
    for cuts in ([40], [5, 13, 40]):
        house = Warehouse(spark, str(tmp_path / f"cut{len(cuts)}"))
        start = 0
        for batch, end in enumerate(cuts):
            put(house, staged(*rows[start:end]), batch)
            run_load(spark, house.root)
            start = end
        assert export_full(spark, house.root, f"{house.root}/out", fmt="parquet") > 0
        results.append(tuples(spark.read.parquet(f"{house.root}/out/export_id=1")))
    assert results[0] == results[1]


def test_consumed_staging_and_old_snapshots_can_be_dropped(spark, house, stage, tmp_path):
    stage(0, SAMPLE, {**SAMPLE, "flight_key": "X1_2025-03-05T00:00:00+00:00"})
    run_load(spark, house.root)
    for batch in (1, 2):
        stage(batch, {**SAMPLE, "status": f"s{batch}"})
        run_load(spark, house.root)
    stage(3, SAMPLE)
    assert house.purge_staging() == [("s", n) for n in (0, 1, 2)]
    assert house.staged_batches() == [("s", 3)]
    before = facts(house)
    house.drop_old_snapshots(keep=1)
    assert facts(house) == before
    with pytest.raises(ValueError):
        house.drop_old_snapshots(keep=0)
    assert len(list((tmp_path / "house").glob("dim_airport/load_id=*"))) == 1
    assert tuples(house.dimension("dim_airline"), "iata") == [("QX",)]
    assert run_load(spark, house.root) == 4


# export ----------------------------------------------------------------------------------


def flights(*minutes):
    return [
        {**SAMPLE, "flight_key": f"F{i}_2025-03-04T00:00:00+00:00",
         "ingest_time": at(f"2025-03-04 10:{m:02d}")}
        for i, m in enumerate(minutes)
    ]


def test_full_extract_is_ordered_and_limited(spark, house, stage, tmp_path):
    stage(
        0,
        {**SAMPLE, "flight_key": "a", "dep_scheduled": at("2025-03-04 10:00")},
        {**SAMPLE, "flight_key": "b", "dep_scheduled": at("2025-03-04 11:00")},
        {**SAMPLE, "flight_key": "c", "dep_scheduled": None},
    )
    run_load(spark, house.root)
    out = str(tmp_path / "full")
    for limit, expected in ((None, ["c", "b", "a"]), (2, ["c", "b"])):
        assert export_full(spark, house.root, out, limit) == len(expected)
        lines = [l for f in sorted((tmp_path / "full").glob("export_id=*/part-*.csv"))
                 for l in f.read_text().splitlines() if not l.startswith("flight_key,")]
        assert [line.split(",")[0] for line in lines] == expected
        assert len(list((tmp_path / "full").glob("export_id=*"))) == 1


def test_a_limit_is_asked_for_and_positive(spark, house, stage, tmp_path):
    stage(0, *flights(*range(30)))
    run_load(spark, house.root)
    assert export_full(spark, house.root, str(tmp_path / "full")) == 30
    assert export_delta(spark, house.root, str(tmp_path / "delta")) == 30
    for job in (export_full, export_delta):
        for limit in (0, -1):
            with pytest.raises(ValueError):
                job(spark, house.root, str(tmp_path / "none"), limit)
    assert not (tmp_path / "none").exists()


def test_a_full_extract_that_fails_leaves_the_old_one(spark, house, stage, tmp_path, monkeypatch):
    stage(0, SAMPLE)
    run_load(spark, house.root)
    out = str(tmp_path / "full")
    export_full(spark, house.root, out)
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "record_export", lambda self, kind, export: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            export_full(spark, house.root, out)
    last = house.last_export("full")
    assert (last["export_id"], last["rows"]) == (1, 1)
    assert spark.read.option("header", True).csv(f"{out}/export_id=1").count() == 1
    assert export_full(spark, house.root, out) == 1
    assert house.folder.has("exports_full/export_id=2")


def test_limits_do_not_sort_the_whole_fact(spark, house, stage):
    from skyledger.operators.export import delta_page, full_extract, load_page

    stage(0, *flights(*range(9)))
    run_load(spark, house.root)
    dims = [house.dimension(n) for n in ("dim_airline", "dim_route", "dim_airport")]
    for rows in (full_extract(house.fact(), *dims, limit=3),
                 delta_page(house.fact(), None, at("2025-03-05 00:00"), 3),
                 load_page(house.fact(), None, 1, 3)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("GlobalLimit"):] if "GlobalLimit" in plan else plan
        assert "scalar-subquery" in below


def test_a_page_of_a_delta_takes_no_limit_through_one_task(spark, house, stage):
    from skyledger.operators.export import load_page

    stage(0, *flights(0, 1, 1, 1, 2, 2, 5))
    run_load(spark, house.root)
    order = ["load_id", "ingest_time", "flight_key"]
    for limit in (1, 3, 4, 9):
        page = load_page(house.fact(), None, 1, limit)
        assert "GlobalLimit" not in page._jdf.queryExecution().optimizedPlan().toString()
        assert tuples(page, *order) == tuples(house.fact().orderBy(*order).limit(limit), *order)


def test_empty_warehouse_writes_nothing(spark, house, tmp_path):
    assert export_full(spark, house.root, str(tmp_path / "full")) == 0
    assert export_delta(spark, house.root, str(tmp_path / "delta")) == 0
    assert not (tmp_path / "full").exists() and not (tmp_path / "delta").exists()


def delta_keys(spark, path, number):
    return [r[0] for r in tuples(
        spark.read.option("header", True).csv(f"{path}/export_id={number}"), "flight_key")]


@pytest.mark.parametrize("limit", [1, 2, 5, None])
def test_pages_of_any_size_give_each_row_once(spark, house, stage, tmp_path, limit):
    stage(0, *flights(0, 1, 1, 1, 2))
    run_load(spark, house.root)
    out, seen, number = str(tmp_path / "delta"), [], 0
    while count := export_delta(spark, house.root, out, limit):
        number += 1
        keys = delta_keys(spark, out, number)
        assert len(keys) == count and (limit is None or count <= limit)
        seen += keys
    assert sorted(seen) == sorted({f"F{i}_2025-03-04T00:00:00+00:00" for i in range(5)})
    assert len(seen) == 5


def test_delta_moves_on_with_the_warehouse(spark, house, stage, tmp_path):
    out = str(tmp_path / "delta")
    stage(0, *flights(0))
    run_load(spark, house.root)
    assert export_delta(spark, house.root, out) == 1
    assert export_delta(spark, house.root, out) == 0
    stage(1, {**flights(1)[0], "flight_key": "G1_2025-03-04T00:00:00+00:00"})
    run_load(spark, house.root)
    assert export_delta(spark, house.root, out) == 1
    assert delta_keys(spark, out, 2) == ["G1_2025-03-04T00:00:00+00:00"]
    stage(2, {**flights(2)[0], "flight_key": "G2_2025-08-25T00:00:00+00:00"})
    run_load(spark, house.root)
    assert export_delta(spark, house.root, out) == 1
    assert delta_keys(spark, out, 3) == ["G2_2025-08-25T00:00:00+00:00"]
    # loaded late with times at and before those that are out
    stage(3, {**flights(2)[0], "flight_key": "G3_2025-08-25T00:00:00+00:00"},
          {**flights(0)[0], "flight_key": "G4_2025-08-25T00:00:00+00:00"})
    run_load(spark, house.root)
    assert export_delta(spark, house.root, out) == 2
    assert delta_keys(spark, out, 4) == [
        "G3_2025-08-25T00:00:00+00:00", "G4_2025-08-25T00:00:00+00:00"]
    assert export_delta(spark, house.root, out) == 0
    assert export_full(spark, house.root, str(tmp_path / "full")) == 5


def test_pages_go_on_while_loads_come_in(spark, house, stage, tmp_path):
    out, seen, number = str(tmp_path / "delta"), [], 0
    stage(0, *flights(3, 2, 1, 0))
    run_load(spark, house.root)
    for batch in range(1, 4):
        number += 1
        assert export_delta(spark, house.root, out, 2) == 2
        seen += delta_keys(spark, out, number)
        stage(batch, {**flights(0)[0], "flight_key": f"L{batch}_2025-03-04T00:00:00+00:00"})
        run_load(spark, house.root)
    while export_delta(spark, house.root, out, 2):
        number += 1
        seen += delta_keys(spark, out, number)
    assert sorted(seen) == sorted(r[0] for r in facts(house, "flight_key"))
    assert len(seen) == 7


def test_a_delta_that_fails_is_written_again(spark, house, stage, tmp_path, monkeypatch):
    out = str(tmp_path / "delta")
    stage(0, *flights(0, 1))
    run_load(spark, house.root)
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "record_export", lambda self, kind, export: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            export_delta(spark, house.root, out)
    assert export_delta(spark, house.root, out) == 2
    assert len(delta_keys(spark, out, 1)) == 2


def test_all_batches_are_staged_by_one_write_and_loaded_one_by_one(
        spark, house, staged, monkeypatch):
    from skyledger.catalog import queries

    writes = []
    plain = queries.replace_partitions
    monkeypatch.setattr(queries, "replace_partitions",
                        lambda *a: writes.append(a[1]) or plain(*a))
    rows = staged(*flights(0, 1)).withColumn(
        "batch_id", F.when(F.col("flight_key").startswith("F0"), 1).otherwise(2).cast("long"))
    queries._stage(house, rows)
    assert writes == [house.staging_path]
    assert house.staged_batches() == [("orders", 1), ("orders", 2)]
    queries._load(house, 1)
    assert house.pending_batches() == [("orders", 2)]
    assert house.fact().count() == 1
