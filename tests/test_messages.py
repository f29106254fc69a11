"""Pages to envelopes to staging rows."""

import json

from conftest import at, tuples
from pyspark.sql import functions as F

from skyledger.operators.decode import decode
from skyledger.operators.normalize import (
    encode_envelopes,
    explode_pages,
    normalize_records,
    parse_pages,
)
from skyledger.operators.quality import split_rejects
from skyledger.plans.normalize import messages as messages_of
from skyledger.plans.normalize import normalize_pages
from skyledger.schemas import ENVELOPE, STAGED
from skyledger.sources.connect import read_pages

SAMPLE = {
    "flight_date": "2025-03-04",
    "flight_status": "active",
    "departure": {
        "airport": "Oslo Gardermoen", "timezone": "Europe/Oslo", "iata": "OSL", "icao": "ENGM",
        "terminal": "N", "gate": "D4", "delay": 27,
        "scheduled": "2025-03-04T13:40:00+00:00", "estimated": "2025-03-04T13:40:00+00:00",
        "actual": "2025-03-04T14:07:00+00:00",
    },
    "arrival": {
        "airport": "Lisbon Portela", "iata": "LIS", "icao": "LPPT",
        "terminal": "1", "gate": None, "baggage": "6", "delay": None,
        "scheduled": "2025-03-04T18:05:00+00:00", "estimated": "2025-03-04T17:50:00+00:00",
        "actual": None,
    },
    "airline": {"name": "Quill Air", "iata": "QX", "icao": "QXA"},
    "flight": {"number": "512", "iata": "QX512", "icao": "QXA512", "codeshared": None},
    "aircraft": None,
    "live": None,
}


def pages(spark, *records):
    return parse_pages(
        spark.createDataFrame([(json.dumps({"data": list(records)}),)], "value string")
    )


def messages(spark, *values):
    rows = [(None if v is None else bytearray(v.encode()),) for v in values]
    return spark.createDataFrame(rows, "value binary")


def envelope(**changes):
    base = {"flight_key": "QX512_2025-03-04T13:40:00+00:00", "flight_date": "2025-03-04",
            "status": "active", "ingest_time": "2025-03-04T13:40:00.123456+00:00"}
    return json.dumps({**base, **changes})


def test_sample_record_end_to_end(spark):
    stamp = F.lit("2025-03-04 01:00:00.5").cast("timestamp")
    outcomes = normalize_pages(pages(spark, SAMPLE), stamp)
    assert tuples(outcomes, "outcome", "raw") == [("keyed", None)]
    out = messages_of(outcomes)
    message = out.first()
    assert bytes(message["key"]) == b"QX512_2025-03-04T13:40:00+00:00"
    sent = json.loads(bytes(message["value"]))
    assert list(sent) == ENVELOPE.fieldNames()
    assert sent["arrival"]["gate"] is None and "gate" in sent["arrival"]
    assert sent["departure"]["iata"] == "OSL"
    assert sent["departure"]["delay_min"] == 27
    assert sent["ingest_time"] == "2025-03-04T01:00:00.500000+00:00"
    assert sent["source"] == "aviationstack"

    row = decode(out).first()
    assert row["reject_reason"] is None and row["partial_parse"] is False
    assert row["dep_delay_min"] == 27.0 and row["arr_delay_min"] is None
    assert row["arr_actual"] is None and row["arr_gate"] is None
    assert row["arr_eta_delta_min"] == -15.0
    assert row["airline_icao"] == "QXA"
    assert (row["dep_airport_iata"], row["arr_airport_iata"]) == ("OSL", "LIS")


def test_only_live_records_of_a_page(spark):
    df = pages(spark, SAMPLE, {**SAMPLE, "flight_status": "landed"})
    assert explode_pages(df).count() == 1
    assert explode_pages(df, "landed").count() == 1
    assert explode_pages(df, None).count() == 2


def test_missing_parts_give_null_fields_and_no_key(spark):
    bad_time = {**SAMPLE, "departure": {**SAMPLE["departure"], "scheduled": "soon"}}
    bare = {"flight_status": "active", "flight": {"iata": "X1"}}
    df = pages(spark, SAMPLE, bad_time, bare, {**SAMPLE, "flight": None})
    rows = tuples(normalize_records(explode_pages(df)), "flight_key", "departure.iata")
    good = "QX512_2025-03-04T13:40:00+00:00"
    assert rows == [(good, "OSL"), (None, "OSL"), (None, "OSL"), (None, None)]
    outcomes = normalize_pages(df)
    assert tuples(outcomes, "outcome") == [("flight_key",)] * 3 + [("keyed",)]
    lost = outcomes.where("outcome = 'flight_key'")
    assert all("flight_key" in r["raw"] for r in lost.collect())


def test_key_time_is_utc(spark):
    record = {**SAMPLE, "departure": {"scheduled": "2025-03-04T22:40:00+09:00"}}
    row = normalize_records(explode_pages(pages(spark, record))).first()
    assert row["flight_key"] == "QX512_2025-03-04T13:40:00+00:00"


def test_landed_pages_are_read_from_files(spark, tmp_path):
    odd = {**SAMPLE, "departure": {**SAMPLE["departure"], "delay": 27.5}}
    whole = json.dumps({"data": [SAMPLE]})
    lines = [json.dumps({"data": [SAMPLE, odd, 7, None]}), json.dumps({"data": []}), "{broken",
             whole[:-9], "[]", "{}", " "]
    (tmp_path / "pages.json").write_text("\n".join(lines))
    landed = read_pages(spark, str(tmp_path / "pages.json"))
    records = explode_pages(landed)
    assert tuples(records, "flight.iata", "departure.delay", "partial_parse") == [
        ("QX512", 27, False), ("QX512", None, True)]
    outcomes = normalize_pages(landed)
    assert tuples(outcomes, "outcome", "partial_parse") == [
        ("keyed", False), ("keyed", True), ("malformed_page", False), ("malformed_page", False),
        ("malformed_page", False), ("malformed_page", False), ("malformed_record", True)]
    raws = {r["raw"] for r in outcomes.where("outcome like 'malformed%'").collect()}
    assert raws == {"{broken", whole[:-9], "[]", "{}", "7"}
    # the mark reaches staging
    staged = decode(messages_of(outcomes))
    assert tuples(staged, "dep_delay_min", "partial_parse") == [(27.0, False), (None, True)]


def test_a_page_over_several_lines_is_read_whole_or_rejected(spark, tmp_path):
    (tmp_path / "whole.json").write_text(json.dumps({"data": [SAMPLE]}, indent=2))
    whole = read_pages(spark, str(tmp_path / "whole.json"), whole_files=True)
    assert tuples(normalize_pages(whole), "outcome") == [("keyed",)]
    lines = read_pages(spark, str(tmp_path / "whole.json"))
    assert set(tuples(normalize_pages(lines), "outcome")) == {("malformed_page",)}


def test_malformed_messages_are_rejected_and_others_kept(spark):
    df = decode(messages(spark, "{bad", "[]", "", None, '"text"', envelope()))
    good, rejected = split_rejects(df)
    assert good.count() == 1
    assert tuples(rejected, "reject_reason") == [("malformed",)] * 5


def test_reject_reasons(spark):
    df = decode(
        messages(
            spark,
            envelope(flight_key=None),
            envelope(flight_key=" "),
            envelope(ingest_time="junk"),
            envelope(ingest_time=None),
            envelope(departure={"delay_min": -5}),
            envelope(arrival={"delay_min": -1}),
            envelope(arrival={"delay_min": 0}),
            "{}",
        )
    )
    assert tuples(df, "reject_reason") == [
        ("flight_key",), ("flight_key",), ("flight_key",), ("ingest_time",), ("ingest_time",),
        ("negative_delay",), ("negative_delay",), (None,),
    ]


def test_a_misfit_field_is_null_and_marked(spark):
    df = decode(
        messages(
            spark,
            envelope(departure={"delay_min": 27}),
            envelope(departure={"delay_min": 27.5}),
            envelope(departure={"delay_min": "27"}),
        )
    )
    assert tuples(df, "dep_delay_min", "partial_parse", "reject_reason") == [
        (27.0, False, None), (None, True, None), (None, True, None),
    ]


def test_a_fraction_in_a_schedule_time_is_null(spark):
    df = decode(messages(spark, envelope(departure={"estimated": "2025-03-04T13:40:00.5+00:00"})))
    assert tuples(df, "dep_estimated", "reject_reason") == [(None, None)]


def test_unknown_fields_are_ignored(spark):
    assert tuples(decode(messages(spark, envelope(live={"a": 1}))), "partial_parse") == [(False,)]


def test_default_ingest_time_is_opt_in(spark):
    stamp = F.lit(at("2025-03-04 12:00"))
    rows = messages(spark, envelope(ingest_time=None))
    assert decode(rows, default_ingest=stamp).first()["reject_reason"] is None
    assert decode(rows).first()["reject_reason"] == "ingest_time"


def test_round_trip_keeps_the_staging_columns(spark):
    out = encode_envelopes(normalize_records(explode_pages(pages(spark, SAMPLE))))
    assert decode(out).columns == [*STAGED.fieldNames(), "raw", "reject_reason"]


def test_the_parse_runs_once_per_message(spark):
    good, _ = split_rejects(decode(messages(spark, envelope())))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
