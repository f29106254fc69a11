"""Dimension merges, load by load."""

import pytest
from conftest import at, tuples

from skyledger.operators import dims
from skyledger.schemas import DIM_AIRLINE, DIM_AIRPORT, DIM_ROUTE


@pytest.fixture
def airlines(staged, table):
    def run(dim_rows, *sighted):
        rows = [
            {"flight_key": str(i), "airline_iata": s[0], "airline_icao": s[1],
             "airline_name": s[2], "ingest_time": at(f"2025-08-21 10:{i:02d}")}
            for i, s in enumerate(sighted)
        ]
        seen = dims.entity_sightings(staged(*rows)).where("kind = 'airline'").drop("kind")
        return tuples(dims.merge_airlines(table(DIM_AIRLINE, *dim_rows), seen))

    return run


@pytest.fixture
def airports(staged, table):
    def run(dim_rows, *sighted):
        rows = [
            {"flight_key": str(i), "dep_airport_iata": s[0], "dep_airport_icao": s[1],
             "dep_airport": s[2], "ingest_time": at(f"2025-08-21 10:{i:02d}")}
            for i, s in enumerate(sighted)
        ]
        seen = dims.entity_sightings(staged(*rows)).where("kind = 'airport'").drop("kind")
        merged, aside = dims.merge_airports(table(DIM_AIRPORT, *dim_rows), seen)
        return tuples(merged), tuples(aside, "iata", "icao")

    return run


def test_latest_name_that_is_not_null(airlines):
    got = airlines([], ("NH", "ANA", "ANA"), ("NH", None, "All Nippon"), ("NH", None, None))
    assert got == [(1, "NH", "ANA", "All Nippon")]


def test_old_values_stay_where_new_are_null(airlines):
    got = airlines([(7, "NH", "ANA", "ANA")], (" NH ", " ", ""), ("JL", None, "JAL"))
    assert got == [(7, "NH", "ANA", "ANA"), (8, "JL", None, "JAL")]


def test_airline_without_iata_is_stored_once(airlines):
    first = airlines([], (None, "XYZ", "Xyz"), ("", "XYZ", None))
    assert first == [(1, None, "XYZ", "Xyz")]
    assert airlines(first, (None, "XYZ", "Xyz")) == first
    assert airlines(first, (None, "XYZ", "New")) == [(1, None, "XYZ", "New")]


def test_airline_without_iata_matches_icao_of_a_known_one(airlines):
    known = [(1, "NH", "ANA", "ANA")]
    assert airlines(known, (None, "ANA", "other")) == known
    assert airlines([], ("NH", "ANA", "ANA"), (None, "ANA", "other")) == known


def test_airline_with_a_name_only(airlines):
    known = [(1, "NH", "ANA", "ANA")]
    assert airlines(known, (None, None, "ANA")) == known
    grown = airlines(known, (None, None, "Charter"), (None, None, "Charter"))
    assert grown == [(1, "NH", "ANA", "ANA"), (2, None, None, "Charter")]
    assert airlines(grown, (None, None, "Charter")) == grown


def test_candidates_need_one_value(staged):
    df = staged(
        {"flight_key": "1", "airline_iata": " ", "airline_name": ""},
        {"flight_key": "2", "airline_name": " X "}, {"flight_key": "3", "airline_name": "X"},
    )
    assert tuples(dims.airline_candidates(df)) == [(None, None, "X")]


def test_airport_ids_follow_the_codes(airports):
    merged, aside = airports([], ("HND", "RJTT", "Haneda"), (None, "AAAA", "a"), ("BKK", None, "b"))
    assert merged == [(1, "BKK", None, "b"), (2, "HND", "RJTT", "Haneda"), (3, None, "AAAA", "a")]
    assert aside == []


def test_airport_known_by_icao_takes_its_iata(airports):
    first, _ = airports([], (None, "RJTT", "Haneda"))
    assert first == [(1, None, "RJTT", "Haneda")]
    second, aside = airports(first, ("HND", "RJTT", None))
    assert second == [(1, "HND", "RJTT", "Haneda")] and aside == []


def test_airport_with_the_icao_of_another_is_set_aside(airports):
    known = [(1, "HND", "RJTT", "Haneda")]
    merged, aside = airports(known, ("NRT", "RJTT", "Narita"))
    assert merged == known and aside == [("NRT", "RJTT")]


def test_one_new_airport_gets_a_shared_icao(airports):
    merged, aside = airports([], ("NRT", "RJTT", "Narita"), ("HND", "RJTT", "Haneda"))
    assert merged == [(1, "HND", "RJTT", "Haneda")] and aside == [("NRT", "RJTT")]


def test_a_stored_airport_comes_before_a_new_one(airports):
    merged, aside = airports([(5, "NRT", None, "n")], ("NRT", "RJTT", None), ("HND", "RJTT", "h"))
    assert merged == [(5, "NRT", "RJTT", "n")] and aside == [("HND", "RJTT")]


def test_two_stored_rows_of_one_airport_are_not_joined(airports):
    known = [(1, "HND", None, "a"), (2, None, "RJTT", "b")]
    merged, aside = airports(known, ("HND", "RJTT", "c"))
    assert merged == known and aside == [("HND", "RJTT")]


def test_icao_pass_fills_the_name_of_the_airport(airports):
    merged, _ = airports([], ("HND", "RJTT", None), (None, "RJTT", "Haneda"))
    assert merged == [(1, "HND", "RJTT", "Haneda")]


def test_anti_join_keeps_candidates_without_iata(table):
    schema = "iata string, icao string, airport_name string"
    candidates = table(schema, (None, "AAAA", "a"), ("HND", "RJTT", "h"), ("BKK", "VTBS", "b"))
    known = table("iata string", ("HND",))
    assert tuples(dims.unknown_airports(candidates, known), "icao") == [("AAAA",), ("VTBS",)]


def test_routes_are_added_once(staged, table):
    ports = table(DIM_AIRPORT, (1, "BKK", "VTBS", "b"), (2, "HND", "RJTT", "h"),
                  (3, None, "AAAA", "a"))
    df = staged(
        {"flight_key": "1", "dep_airport_iata": " HND", "arr_airport_iata": "BKK"},
        {"flight_key": "2", "dep_airport_iata": "HND", "arr_airport_iata": "BKK "},
        {"flight_key": "3", "dep_airport_iata": "HND", "arr_airport_iata": "???"},
        {"flight_key": "4", "dep_airport_iata": "HND", "arr_airport_iata": None,
         "arr_airport_icao": "AAAA"},
    )
    pairs = dims.route_pairs(df, ports)
    assert tuples(pairs) == [(2, 1)]
    routes = dims.merge_routes(table(DIM_ROUTE, (9, 1, 2)), pairs)
    assert tuples(routes) == [(10, 2, 1), (9, 1, 2)]
    assert tuples(dims.merge_routes(routes, pairs)) == tuples(routes)
    assert tuples(dims.route_pairs(df, ports, icao_fallback=True)) == [(2, 1), (2, 3)]
