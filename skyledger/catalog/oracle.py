"""Independent ANSI SQL for the queries, written for DuckDB."""

from __future__ import annotations

from skyledger.catalog.adapters import STAGING_SQL
from skyledger.catalog.queries import (
    DELTA_LAST,
    DELTA_LAST_KEY,
    DELTA_TARGET,
    EXPORT_LIMIT,
    PAGE_LIMIT,
)
from skyledger.schemas import EXPORT_COLUMNS, STAGING

_ISO = "%Y-%m-%dT%H:%M:%S"


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([STAGING_SQL, *ctes]) + "\n" + body


def _fold(source: str, key: str, attributes: list[str]) -> str:
    """Latest non-null value per attribute, one window per attribute."""
    joins = " ".join(
        f"""LEFT JOIN (SELECT {key}, {a} FROM {source} WHERE {a} IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ingest_time DESC, {a} DESC) = 1
        ) w_{a} USING ({key})"""
        for a in attributes
    )
    columns = ", ".join(f"w_{a}.{a} AS {a}" for a in attributes)
    return f"""SELECT k.{key} AS {key}, {columns}
        FROM (SELECT DISTINCT {key} FROM {source} WHERE {key} IS NOT NULL) k {joins}"""


_AIRLINES_SEEN = """airlines_seen AS (
  SELECT airline_iata AS iata, airline_icao AS icao, airline_name AS name, ingest_time, batch_id
  FROM c WHERE coalesce(airline_iata, airline_icao, airline_name) IS NOT NULL
)"""


def _airline_load(n: int) -> str:
    prev = f"al{n - 1}"
    return f"""
a_all{n} AS (SELECT * FROM airlines_seen WHERE batch_id = {n}),
a_iata{n} AS ({_fold(f"a_all{n}", "iata", ["icao", "name"])}),
a_pool{n} AS (
  SELECT p.id, coalesce(p.iata, f.iata) AS iata, coalesce(f.icao, p.icao) AS icao,
         coalesce(f.name, p.name) AS name
  FROM {prev} p FULL JOIN a_iata{n} f ON p.iata = f.iata
),
a_noiata{n} AS (SELECT * FROM a_all{n} WHERE iata IS NULL),
a_icao{n} AS (
  SELECT * FROM ({_fold(f"a_noiata{n}", "icao", ["name"])}) x
  WHERE NOT EXISTS (SELECT 1 FROM a_pool{n} p WHERE p.iata IS NOT NULL AND p.icao = x.icao)
),
a_pool2{n} AS (
  SELECT * FROM a_pool{n} WHERE NOT (iata IS NULL AND icao IS NOT NULL)
  UNION ALL
  SELECT p.id, NULL, coalesce(p.icao, x.icao), coalesce(x.name, p.name)
  FROM (SELECT * FROM a_pool{n} WHERE iata IS NULL AND icao IS NOT NULL) p
  FULL JOIN a_icao{n} x ON p.icao = x.icao
),
a_pool3{n} AS (
  SELECT * FROM a_pool2{n}
  UNION ALL
  SELECT DISTINCT CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), name
  FROM a_noiata{n} x
  WHERE icao IS NULL AND NOT EXISTS (SELECT 1 FROM a_pool2{n} p WHERE p.name = x.name)
),
al{n} AS (
  SELECT * FROM a_pool3{n} WHERE id IS NOT NULL
  UNION ALL
  SELECT (SELECT coalesce(max(id), 0) FROM {prev}) + row_number() OVER (
           ORDER BY iata NULLS LAST, icao NULLS LAST, name NULLS LAST), iata, icao, name
  FROM a_pool3{n} WHERE id IS NULL
)"""


def _empty(name: str) -> str:
    return f"""{name} AS (
  SELECT CAST(NULL AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS iata, CAST(NULL AS VARCHAR) AS icao,
         CAST(NULL AS VARCHAR) AS name WHERE false
)"""


def _airport_load(n: int) -> str:
    prev = f"ap{n - 1}"
    return f"""
p_all{n} AS (SELECT * FROM ports_seen WHERE batch_id = {n}),
p_found{n} AS ({_fold(f"p_all{n}", "iata", ["icao", "name"])}),
p_linked{n} AS (
  SELECT f.*, own.id AS own_id, holder.id AS holder_id, holder.iata AS holder_iata
  FROM p_found{n} f LEFT JOIN {prev} own ON own.iata = f.iata
  LEFT JOIN {prev} holder ON holder.icao = f.icao
),
p_judged{n} AS (
  SELECT iata, icao, name,
    CASE WHEN own_id IS NULL AND holder_iata IS NULL THEN holder_id ELSE own_id END AS id,
    holder_id IS NOT NULL AND holder_id IS DISTINCT FROM own_id
      AND NOT (own_id IS NULL AND holder_iata IS NULL) AS clash
  FROM p_linked{n}
),
p_ranked{n} AS (
  SELECT *, CASE WHEN icao IS NULL THEN 1 ELSE row_number() OVER (
      PARTITION BY icao, clash ORDER BY id NULLS LAST, iata) END AS turn
  FROM p_judged{n}
),
p_ok{n} AS (SELECT * FROM p_ranked{n} WHERE NOT clash AND turn = 1),
p_set_aside{n} AS (SELECT * FROM p_ranked{n} WHERE clash OR turn > 1),
p_iata{n} AS (
  SELECT p.id, coalesce(o.iata, p.iata) AS iata, coalesce(o.icao, p.icao) AS icao,
         coalesce(o.name, p.name) AS name
  FROM {prev} p LEFT JOIN p_ok{n} o ON o.id = p.id
  UNION ALL
  SELECT id, iata, icao, name FROM p_ok{n} WHERE id IS NULL
),
p_noiata{n} AS (SELECT * FROM p_all{n} WHERE iata IS NULL),
p_icao{n} AS ({_fold(f"p_noiata{n}", "icao", ["name"])}),
p_pool{n} AS (
  SELECT p.id, p.iata, coalesce(p.icao, x.icao) AS icao, coalesce(x.name, p.name) AS name
  FROM p_iata{n} p FULL JOIN p_icao{n} x ON p.icao = x.icao
),
ap{n} AS (
  SELECT * FROM p_pool{n} WHERE id IS NOT NULL
  UNION ALL
  SELECT (SELECT coalesce(max(id), 0) FROM {prev})
           + row_number() OVER (ORDER BY iata NULLS LAST, icao NULLS LAST), iata, icao, name
  FROM p_pool{n} WHERE id IS NULL
)"""


_AIRPORTS_TWO_LOADS = [_empty("ap0"), _airport_load(1), _airport_load(2)]

_LATEST = """latest AS (
  SELECT * FROM c QUALIFY row_number() OVER (
    PARTITION BY flight_key
    ORDER BY ingest_time DESC, batch_id DESC, flight_date DESC, status DESC, flight_number DESC
  ) = 1
)"""

# One load with airports matched by IATA code alone.
_STAR = [
    f"""a_src AS (
  SELECT airline_iata AS iata, airline_icao AS icao, airline_name AS name, ingest_time FROM c
),
dim_airline AS (
  SELECT row_number() OVER (ORDER BY iata) AS airline_id, iata, icao, name AS airline_name
  FROM ({_fold("a_src", "iata", ["icao", "name"])})
)""",
    """dim_airport AS (
  SELECT row_number() OVER (ORDER BY iata) AS airport_id, iata, max(name) AS airport_name
  FROM ports_seen WHERE iata IS NOT NULL GROUP BY iata
)""",
    """pairs AS (
  SELECT DISTINCT d.airport_id AS dep_airport_id, a.airport_id AS arr_airport_id
  FROM c JOIN dim_airport d ON d.iata = c.dep_airport_iata
  JOIN dim_airport a ON a.iata = c.arr_airport_iata
)""",
    """dim_route AS (
  SELECT row_number() OVER (ORDER BY dep_airport_id, arr_airport_id) AS route_id, *
  FROM pairs
)""",
]

# Routes by the codes of their ends.
_ROUTE_CODES = """route_codes AS (
  SELECT route_id, d.iata AS dep_code, d.airport_name AS dep_name, a.iata AS arr_code,
         a.airport_name AS arr_name
  FROM dim_route JOIN dim_airport d ON d.airport_id = dep_airport_id
  JOIN dim_airport a ON a.airport_id = arr_airport_id
)"""
_ROUTE_LOOKUP = """LEFT JOIN route_codes r
    ON r.dep_code = x.dep_airport_iata AND r.arr_code = x.arr_airport_iata"""

_EXPORT = [
    *_STAR,
    _ROUTE_CODES,
    _LATEST,
    f"""frame AS (
  SELECT x.*, al.airline_name, r.dep_name AS dep_airport_name, r.arr_name AS arr_airport_name
  FROM (SELECT * EXCLUDE (airline_name) FROM latest) x
  LEFT JOIN dim_airline al ON al.iata = x.airline_iata
  {_ROUTE_LOOKUP}
)""",
]
_FRAME = f"SELECT {', '.join(EXPORT_COLUMNS)} FROM frame"

# Envelopes as the event adapter makes them, field by field from the events.
_K = "json_extract_string(props, '$.k')"
_EVENT_ROWS = f"""
  event_type || '_' || user_id AS flight_key,
  strftime(ts, '%Y-%m-%d') AS flight_date,
  event_type AS status,
  ts AS ingest_time,
  CAST(event_id AS VARCHAR) AS flight_number,
  'F' || user_id AS flight_iata,
  CAST(NULL AS VARCHAR) AS flight_icao,
  CASE WHEN event_type <> 'signup' THEN 'K' || {_K} END AS airline_iata,
  'KK' || {_K} AS airline_icao,
  CASE WHEN event_type <> 'error' THEN 'Line ' || {_K} END AS airline_name,
  'Airport ' || event_type AS dep_airport,
  upper(substr(event_type, 1, 3)) AS dep_airport_iata,
  CAST(NULL AS VARCHAR) AS dep_airport_icao,
  CAST(NULL AS VARCHAR) AS dep_terminal,
  CAST(NULL AS VARCHAR) AS dep_gate,
  date_trunc('second', ts) AS dep_scheduled,
  CAST(NULL AS TIMESTAMP) AS dep_estimated,
  CAST(NULL AS TIMESTAMP) AS dep_actual,
  trunc(value) AS dep_delay_min,
  CAST(NULL AS VARCHAR) AS arr_airport,
  CAST(NULL AS VARCHAR) AS arr_airport_iata,
  CAST(NULL AS VARCHAR) AS arr_airport_icao,
  CAST(user_id AS VARCHAR) AS arr_terminal,
  CAST(NULL AS VARCHAR) AS arr_gate,
  date_trunc('second', ts) AS arr_scheduled,
  date_trunc('second', ts) + to_minutes(CAST(trunc(value) AS BIGINT)) AS arr_estimated,
  CAST(NULL AS TIMESTAMP) AS arr_actual,
  CAST(NULL AS DOUBLE) AS arr_delay_min,
  trunc(value) AS arr_eta_delta_min,
  false AS partial_parse
FROM events"""

# Identifier and key of the two records that the page adapter makes per event.
_IDENTIFIER = """CASE WHEN event_type = 'view' THEN 'V' || user_id
       WHEN event_type = 'click' THEN 'CK' || user_id
       WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END"""
_DEPARTS = f"strftime(ts, '{_ISO}') || '+00:00'"
_RECORDS = """records AS (
  SELECT *, event_type AS flight_status FROM events
  UNION ALL
  SELECT *, 'active' FROM events
)"""
_ESTIMATED = f"""CASE WHEN epoch_us(ts) % 1000000 = 0 THEN {_DEPARTS}
       ELSE strftime(ts, '{_ISO}.%f') || '+00:00' END"""

# The tables after the first load and after both.
_LOADS = [
    *_AIRPORTS_TWO_LOADS,
    _AIRLINES_SEEN,
    "by_load AS (SELECT 1 AS batch_id, * FROM ap1 UNION ALL SELECT 2, * FROM ap2)",
]


def _loaded(n: int) -> str:
    """Export frame of the tables after load ``n``. A flight has the route that its own load
    found, with the names that the airports have after load ``n``."""
    return f"""
SELECT {', '.join(EXPORT_COLUMNS)} FROM (
  SELECT x.*, al.name AS airline_name,
    CASE WHEN d.id IS NOT NULL AND a.id IS NOT NULL THEN d2.name END AS dep_airport_name,
    CASE WHEN d.id IS NOT NULL AND a.id IS NOT NULL THEN a2.name END AS arr_airport_name
  FROM (
    SELECT * EXCLUDE (airline_name) FROM c WHERE batch_id <= {n} QUALIFY row_number() OVER (
      PARTITION BY flight_key
      ORDER BY ingest_time DESC, batch_id DESC, flight_date DESC, status DESC, flight_number DESC
    ) = 1
  ) x
  LEFT JOIN ({_fold(f"(SELECT * FROM airlines_seen WHERE batch_id <= {n})", 'iata', ['name'])}) al
    ON al.iata = x.airline_iata
  LEFT JOIN by_load d ON d.batch_id = x.batch_id AND d.iata = x.dep_airport_iata
  LEFT JOIN by_load a ON a.batch_id = x.batch_id AND a.iata = x.arr_airport_iata
  LEFT JOIN ap{n} d2 ON d2.id = d.id
  LEFT JOIN ap{n} a2 ON a2.id = a.id
)"""


ORACLE: dict[str, str] = {
    "envelope_roundtrip": f"SELECT {_EVENT_ROWS}",
    "staging_project": f"""
SELECT {_IDENTIFIER} || '_' || {_DEPARTS} AS flight_key,
  strftime(ts, '%Y-%m-%d') AS flight_date, 'active' AS status,
  TIMESTAMP '2024-02-01 00:00:00.5' AS ingest_time,
  CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS flight_number,
  CASE WHEN event_type = 'view' THEN 'V' || user_id ELSE '' END AS flight_iata,
  CASE WHEN event_type = 'click' THEN 'CK' || user_id END AS flight_icao,
  CAST(NULL AS VARCHAR) AS airline_iata, CAST(NULL AS VARCHAR) AS airline_icao,
  CASE WHEN event_type = 'signup' THEN 'ANY' ELSE 'L' || user_id END AS airline_name,
  'Airport ' || event_type AS dep_airport,
  upper(substr(event_type, 1, 3)) AS dep_airport_iata,
  CAST(NULL AS VARCHAR) AS dep_airport_icao, CAST(NULL AS VARCHAR) AS dep_terminal,
  CAST(user_id AS VARCHAR) AS dep_gate,
  date_trunc('second', ts) AS dep_scheduled,
  CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ts END AS dep_estimated,
  CAST(NULL AS TIMESTAMP) AS dep_actual, trunc(value) AS dep_delay_min,
  CAST(NULL AS VARCHAR) AS arr_airport, CAST(NULL AS VARCHAR) AS arr_airport_iata,
  CAST(NULL AS VARCHAR) AS arr_airport_icao, CAST(NULL AS VARCHAR) AS arr_terminal,
  CAST(NULL AS VARCHAR) AS arr_gate, CAST(NULL AS TIMESTAMP) AS arr_scheduled,
  CAST(NULL AS TIMESTAMP) AS arr_estimated, CAST(NULL AS TIMESTAMP) AS arr_actual,
  CAST(NULL AS DOUBLE) AS arr_delay_min
FROM events WHERE {_IDENTIFIER} IS NOT NULL""",
    "ts_parse": f"""
SELECT event_id, CAST(NULL AS TIMESTAMP) AS schedule_micros,
  date_trunc('second', ts) AS schedule_seconds, ts AS ingest_micros,
  date_trunc('second', ts) AS ingest_seconds, CAST(NULL AS TIMESTAMP) AS ingest_other,
  {_DEPARTS} AS iso_east, {_ESTIMATED} AS iso_micros, CAST(NULL AS VARCHAR) AS iso_empty
FROM events""",
    "date_parse": """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS from_date,
  CAST(try_cast(o_orderpriority AS DATE) AS VARCHAR) AS from_other
FROM orders""",
    "eta_delta": _with("""
SELECT flight_number, date_diff('second', arr_scheduled, arr_estimated) / 60.0 AS arr_eta_delta_min
FROM s"""),
    "code_clean": _with("""
SELECT flight_number, airline_iata, airline_icao, airline_name, dep_airport_iata, arr_airport_iata
FROM c"""),
    "page_explode": """
SELECT role, CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS INTEGER) AS turn, text
FROM conversations WHERE role = 'assistant'""",
    "page_normalize": f"""
WITH {_RECORDS}
SELECT {_IDENTIFIER} || '_' || {_DEPARTS} AS flight_key,
  strftime(ts, '%Y-%m-%d') AS flight_date, flight_status AS status,
  CASE WHEN event_type = 'signup' THEN 'ANY' ELSE 'L' || user_id END AS airline_name,
  CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS flight_number,
  upper(substr(event_type, 1, 3)) AS dep_iata, CAST(user_id AS VARCHAR) AS dep_gate,
  {_DEPARTS} AS dep_schedule, {_ESTIMATED} AS dep_estimated,
  CAST(NULL AS VARCHAR) AS dep_actual, CAST(trunc(value) AS INTEGER) AS dep_delay_min,
  CAST(NULL AS VARCHAR) AS arr_schedule,
  '2024-02-01T00:00:00.500000+00:00' AS ingest_time, 'aviationstack' AS source
FROM records""",
    "flight_key": f"""
SELECT {_IDENTIFIER} || '_' || {_DEPARTS} AS flight_key, {_DEPARTS} AS departs,
  CASE WHEN {_IDENTIFIER} IS NULL THEN 'flight_key' ELSE 'keyed' END AS outcome
FROM events""",
    "dq_split": _with("""
SELECT flight_number, CASE
    WHEN status = 'P' AND dep_terminal = '1-URGENT' THEN 'flight_key'
    WHEN status = 'P' THEN 'ingest_time'
    WHEN date_diff('day', CAST(dep_estimated AS DATE), CAST(dep_actual AS DATE)) < 0
      OR dep_delay_min < 0 THEN 'negative_delay'
    ELSE 'none' END AS reject_reason
FROM s"""),
    "dq_duplicates": """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_orphans": """
SELECT o_orderkey, -o_custkey AS o_custkey FROM orders
WHERE o_orderpriority = '5-LOW' AND o_custkey > 0""",
    "latest_per_flight": f"""
SELECT flight_key, status, ingest_time, flight_number, airline_name, dep_delay_min
FROM (SELECT {_EVENT_ROWS})
QUALIFY row_number() OVER (
  PARTITION BY flight_key ORDER BY ingest_time DESC, flight_number DESC) = 1""",
    "latest_per_key": _with(
        f"SELECT {', '.join(STAGING.fieldNames())}, batch_id FROM latest_raw"
        .replace("flight_date,", "CAST(flight_date AS VARCHAR) AS flight_date,"),
        _LATEST.replace("latest AS", "latest_raw AS").replace("FROM c", "FROM s"),
    ),
    "dim_fold": _with(
        f"SELECT iata, icao, name AS airline_name FROM ({_fold('airlines_seen', 'iata', ['icao', 'name'])})",
        _AIRLINES_SEEN,
    ),
    "dim_candidates": _with(
        "SELECT DISTINCT iata, icao, name AS airline_name FROM airlines_seen", _AIRLINES_SEEN),
    "surrogate_keys": _with("""
SELECT 1000 + row_number() OVER (ORDER BY flight_key) AS flight_id, flight_key
FROM (SELECT DISTINCT flight_key FROM s)"""),
    "dim_upsert_coalesce": _with(
        """
SELECT airline_id, coalesce(t.iata, n.iata) AS iata, coalesce(n.icao, t.icao) AS icao,
  coalesce(n.name, t.name) AS airline_name
FROM (SELECT row_number() OVER (ORDER BY iata) AS airline_id, * FROM f1) t
FULL JOIN f2 n ON t.iata = n.iata""",
        _AIRLINES_SEEN,
        "b1 AS (SELECT * FROM airlines_seen WHERE batch_id = 1)",
        "b2 AS (SELECT * FROM airlines_seen WHERE batch_id = 2)",
        f"f1 AS ({_fold('b1', 'iata', ['icao', 'name'])})",
        f"f2 AS ({_fold('b2', 'iata', ['icao', 'name'])})",
    ),
    "airport_union": _with(
        "SELECT DISTINCT iata, icao, name AS airport_name FROM ports_seen WHERE iata IS NOT NULL"),
    "airport_icao_anti": _with("""
SELECT DISTINCT iata, icao, name AS airport_name FROM ports_seen a
WHERE icao IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM ports_seen d WHERE d.batch_id = 1 AND d.iata = a.iata)"""),
    "dim_airline_merge": _with(
        "SELECT id AS airline_id, iata, icao, name AS airline_name FROM al2",
        _AIRLINES_SEEN, _empty("al0"), _airline_load(1), _airline_load(2),
    ),
    "airport_upsert_iata": _with(
        "SELECT id AS airport_id, iata, icao, name AS airport_name FROM p_iata2",
        *_AIRPORTS_TWO_LOADS,
    ),
    "airport_upsert_icao": _with(
        "SELECT id AS airport_id, iata, icao, name AS airport_name FROM ap2",
        *_AIRPORTS_TWO_LOADS,
    ),
    "airport_quarantine": _with(
        """SELECT iata, icao, name AS airport_name, 'icao_conflict' AS reason
FROM (SELECT iata, icao, name FROM p_set_aside1 UNION SELECT iata, icao, name FROM p_set_aside2)""",
        *_AIRPORTS_TWO_LOADS,
    ),
    "route_pairs": _with("SELECT dep_airport_id, arr_airport_id FROM pairs", *_STAR[1:3]),
    "route_insert_ignore": _with(
        """
SELECT row_number() OVER (ORDER BY dep_airport_id, arr_airport_id) AS route_id,
  dep_airport_id, arr_airport_id FROM pair_loads WHERE first_load = 1
UNION ALL
SELECT (SELECT count(*) FROM pair_loads WHERE first_load = 1)
  + row_number() OVER (ORDER BY dep_airport_id, arr_airport_id), dep_airport_id, arr_airport_id
FROM pair_loads WHERE first_load = 2""",
        _STAR[1],
        """pair_loads AS (
  SELECT d.airport_id AS dep_airport_id, a.airport_id AS arr_airport_id,
         min(batch_id) AS first_load
  FROM c JOIN dim_airport d ON d.iata = c.dep_airport_iata
  JOIN dim_airport a ON a.iata = c.arr_airport_iata
  GROUP BY 1, 2
)""",
    ),
    "fact_enrich": _with(
        f"""
SELECT x.flight_number AS flight_key, al.airline_id, r.route_id
FROM c x LEFT JOIN dim_airline al ON al.iata = x.airline_iata {_ROUTE_LOOKUP}""",
        *_STAR,
        _ROUTE_CODES,
    ),
    "fact_enrich_icao": _with(
        """
SELECT x.flight_number AS flight_key, al.airline_id, r.route_id
FROM c x LEFT JOIN dim_airline al ON al.iata = x.airline_iata
LEFT JOIN ends e ON e.flight_number = x.flight_number
LEFT JOIN routes r ON r.dep = e.dep AND r.arr = e.arr""",
        _STAR[0],
        """ports_by_icao AS (
  SELECT row_number() OVER (ORDER BY icao) AS id, icao, max(iata) AS iata
  FROM ports_seen WHERE icao IS NOT NULL GROUP BY icao
),
ends AS (
  SELECT c.flight_number, d.id AS dep, a.id AS arr
  FROM c
  LEFT JOIN ports_by_icao d ON CASE WHEN c.dep_airport_iata IS NOT NULL
    THEN d.iata = c.dep_airport_iata ELSE d.icao = c.dep_airport_icao END
  LEFT JOIN ports_by_icao a ON CASE WHEN c.arr_airport_iata IS NOT NULL
    THEN a.iata = c.arr_airport_iata ELSE a.icao = c.arr_airport_icao END
),
routes AS (
  SELECT row_number() OVER (ORDER BY dep, arr) AS route_id, dep, arr
  FROM (SELECT DISTINCT dep, arr FROM ends WHERE dep IS NOT NULL AND arr IS NOT NULL)
)""",
    ),
    "fact_upsert": _with(
        """
SELECT flight_key, CAST(flight_date AS VARCHAR) AS flight_date, status, ingest_time,
  flight_number, dep_actual, dep_delay_min, arr_actual
FROM (
  SELECT * FROM s QUALIFY row_number() OVER (
    PARTITION BY flight_key, batch_id
    ORDER BY ingest_time DESC, flight_date DESC, status DESC, flight_number DESC) = 1
) QUALIFY row_number() OVER (PARTITION BY flight_key ORDER BY batch_id DESC) = 1""",
    ),
    "fact_upsert_newer_only": _with(
        """
SELECT flight_key, CAST(flight_date AS VARCHAR) AS flight_date, status, ingest_time,
  flight_number, dep_actual, dep_delay_min, arr_actual
FROM s QUALIFY row_number() OVER (PARTITION BY flight_key
  ORDER BY ingest_time DESC, batch_id, flight_date DESC, status DESC, flight_number DESC) = 1""",
    ),
    "max_ingest": _with("SELECT max(ingest_time) AS max_ingest FROM s"),
    "export_gate": _with("""
SELECT max(ingest_time) IS NOT NULL AS first_run,
  coalesce(max(ingest_time) > TIMESTAMP '1996-01-01', false) AS newer,
  max(ingest_time) <> max(ingest_time) AS same, false AS empty_fact
FROM s"""),
    "export_full": _with(
        f"{_FRAME} ORDER BY dep_scheduled DESC NULLS FIRST, flight_key LIMIT {EXPORT_LIMIT}",
        *_EXPORT,
    ),
    "export_full_unlimited": _with(_FRAME, *_EXPORT),
    "export_delta": _with(
        f"""{_FRAME}
WHERE ingest_time <= TIMESTAMP '{DELTA_TARGET}' AND (ingest_time > TIMESTAMP '{DELTA_LAST}'
  OR (ingest_time = TIMESTAMP '{DELTA_LAST}' AND flight_key > '{DELTA_LAST_KEY}'))
ORDER BY ingest_time, flight_key LIMIT {PAGE_LIMIT}""",
        *_EXPORT,
    ),
    "warehouse_load": _with(_loaded(2), *_LOADS),
    "job_export_full": _with(_loaded(2), *_LOADS),
    "job_export_delta": _with(
        f"SELECT 1 AS after_load, * FROM ({_loaded(1)}) UNION ALL "
        f"SELECT 2, * FROM ({_loaded(2)}) WHERE ingest_time > "
        f"(SELECT max(ingest_time) FROM ({_loaded(1)}))",
        *_LOADS,
    ),
    "load_failure": _with(
        f"SELECT 'failed' AS state, * FROM ({_loaded(1)}) UNION ALL "
        f"SELECT 'retried', * FROM ({_loaded(2)})",
        *_LOADS,
    ),
    "stream_restart": f"""
SELECT flight_key, 'again ' || status AS status, max(ingest_time) AS ingest_time
FROM (SELECT {_EVENT_ROWS}) GROUP BY flight_key, status""",
    "default_ingest": """
SELECT event_type || '_' || user_id AS flight_key, CAST(event_id AS VARCHAR) AS flight_number,
  CASE WHEN event_type = 'view' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE ts END AS ingest_time
FROM events""",
    "page_rejects": f"""
SELECT CASE WHEN event_type = 'error' THEN 'malformed_page' ELSE 'keyed' END AS outcome,
  CASE WHEN event_type <> 'error' THEN {_IDENTIFIER} || '_' || {_DEPARTS} END AS flight_key,
  event_type = 'signup' AS partial_parse,
  CASE WHEN event_type NOT IN ('error', 'signup') THEN trunc(value) END AS dep_delay_min
FROM events""",
    "stream_ingest": """
SELECT
  CASE WHEN event_type NOT IN ('signup', 'error') THEN event_type || '_' || user_id END
    AS flight_key,
  CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS flight_number,
  CASE WHEN event_type NOT IN ('signup', 'error') THEN ts END AS ingest_time,
  CASE event_type WHEN 'signup' THEN 'flight_key' WHEN 'error' THEN 'malformed' ELSE 'none' END
    AS reason
FROM events""",
    "dq_touched_lines": """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem WHERE l_orderkey IN (
  SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1997-03-01'
    AND o_orderdate < DATE '1997-04-01')""",
    "dq_lost_lines": """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_shipdate >= DATE '1997-03-01' AND l_shipdate < DATE '1997-04-01' AND NOT EXISTS (
  SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority <> '5-LOW')""",
    "job_export_late": _with("""
SELECT after_load, flight_key, status, ingest_time FROM (
  SELECT *, CASE WHEN batch_id = 1 AND dep_terminal <> '1-URGENT' THEN 1 ELSE 2 END AS after_load
  FROM s
) QUALIFY row_number() OVER (PARTITION BY after_load, flight_key
  ORDER BY ingest_time DESC, flight_date DESC, status DESC, flight_number DESC) = 1"""),
    "job_export_empty": _with("""
SELECT step, kind, CASE WHEN step = 'loaded' OR (step = 'again' AND kind = 'full')
    THEN (SELECT count(DISTINCT flight_key) FROM s WHERE batch_id = 1) ELSE 0 END AS rows,
  step <> 'empty' AS written
FROM (VALUES ('empty'), ('loaded'), ('again')) steps(step),
     (VALUES ('full'), ('delta')) kinds(kind)"""),
    "stream_counts": """
SELECT CAST(day(ts) % 3 AS BIGINT) AS batch_id, count(*) AS total,
  count(*) FILTER (WHERE event_type NOT IN ('signup', 'error')) AS good,
  count(*) FILTER (WHERE event_type IN ('signup', 'error')) AS rejected,
  count(*) FILTER (WHERE event_type = 'click') AS partial
FROM events GROUP BY 1""",
    "stream_load": """
SELECT event_type || '_' || user_id AS flight_key, event_type AS status, max(ts) AS ingest_time,
  3 AS loads, (SELECT count(*) FROM events WHERE event_type NOT IN ('signup', 'error')) AS staged
FROM events WHERE event_type NOT IN ('signup', 'error') GROUP BY 1, 2""",
}
ORACLE["bucketed_upsert"] = ORACLE["fact_upsert"]
ORACLE["export_delta_sql"] = ORACLE["export_delta"]
