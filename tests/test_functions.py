from conftest import at
from pyspark.sql import functions as F

from skyledger.functions import (
    clean_code,
    flight_key,
    iso_utc,
    minutes_between,
    parse_date,
    parse_ingest_time,
    parse_schedule,
)
from skyledger.schemas import SCHEDULE_FORMAT


def values(spark, expression, inputs):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, x string").select("i", expression.alias("y"))
    return [r["y"] for r in df.orderBy("i").collect()]


def moments(spark, expression, inputs):
    micros = values(spark, F.unix_micros(expression), inputs)
    epoch = at("1970-01-01")
    return [None if m is None else (m - int(epoch.timestamp() * 1e6)) / 1e6 for m in micros]


def test_ingest_time_takes_microseconds_whole_seconds_and_zulu(spark):
    texts = ["2025-08-21T00:05:00.123456+00:00", "2025-08-21T00:05:00+00:00",
             "2025-08-21T00:05:00Z", "junk", "", None, "12:30"]
    base = at("2025-08-21 00:05").timestamp()
    got = moments(spark, parse_ingest_time(F.col("x")), texts)
    assert got == [base + 0.123456, base, base, None, None, None, None]


def test_schedule_time_is_strict(spark):
    base = at("2025-08-21 00:05").timestamp()
    got = moments(
        spark,
        parse_schedule(F.col("x")),
        ["2025-08-21T00:05:00+00:00", "2025-08-21T00:05:00.5+00:00", "2025-08-21T00:05:00", "x"],
    )
    assert got == [base, None, None, None]


def test_schedule_time_agrees_with_the_format(spark):
    texts = [
        "2025-08-21T00:05:00+00:00", "2025-08-21T00:05:00Z", "2025-08-21T09:05:00+09:00",
        "2025-08-21T00:05:00-11:30", "2024-02-29T23:59:59+18:00", "2025-02-29T00:00:00Z",
        "2025-13-01T00:00:00Z", "2025-08-21T24:00:00Z", "2025-08-21T00:60:00Z",
        "2025-08-21T00:05:00+0000", "2025-08-21T00:05:00+00", "2025-08-21T00:05:00+19:00",
        "2025-08-21 00:05:00+00:00", "2025-08-21T00:05Z", "2025-8-21T00:05:00Z", " ", "",
        "2025-08-21T00:05:00.000+00:00", "2025-08-21T00:05:00z", "2025-08-21t00:05:00Z", "0001-01-01T00:00:00Z",
    ]
    by_format = F.try_to_timestamp(F.col("x"), F.lit(SCHEDULE_FORMAT))
    assert moments(spark, parse_schedule(F.col("x")), texts) == moments(spark, by_format, texts)


def test_iso_is_utc_and_keeps_a_fraction(spark):
    got = values(
        spark,
        iso_utc(F.col("x")),
        ["2025-08-21T09:05:00+09:00", "2025-08-21T00:05:00.25Z", "2025-08-21", "", "bad", None],
    )
    assert got == ["2025-08-21T00:05:00+00:00", "2025-08-21T00:05:00.250000+00:00",
                   "2025-08-21T00:00:00+00:00", None, None, None]


def test_date(spark):
    got = values(spark, parse_date(F.col("x")).cast("string"), ["2025-08-21", "nope", "", None])
    assert got == ["2025-08-21", None, None, None]


def test_minutes_drop_the_fraction_and_need_both_sides(spark):
    row = spark.sql(
        "SELECT timestamp'2025-08-21 04:20:00.9' a, timestamp'2025-08-21 04:35:00.1' b"
    ).select(
        minutes_between(F.col("a"), F.col("b")).alias("m"),
        minutes_between(F.col("a"), F.lit(None).cast("timestamp")).alias("n"),
    ).first()
    assert (row["m"], row["n"]) == (-15.0, None)


def test_codes_are_trimmed_and_blank_is_null(spark):
    got = values(spark, clean_code(F.col("x")), [" NH ", "", "   ", None, "\tNH"])
    assert got == ["NH", None, None, None, "\tNH"]


def test_key_takes_the_first_identifier_that_is_not_empty(spark):
    rows = [("", "ANA849", "849", "T"), ("NH849", "ANA849", "849", "T"), (None, "", "849", "T"),
            ("", None, "", "T"), ("NH849", None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, t string")
    got = [r[0] for r in df.select(flight_key(*map(F.col, "abct"))).collect()]
    assert got == ["ANA849_T", "NH849_T", "849_T", None, None]
