import sys
from datetime import date, datetime, timezone
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from skyledger.schemas import STAGED  # noqa: E402
from skyledger.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            # on tiny tables most of the time would go into compiling generated code; the
            # catalogue test switches it on
            "spark.sql.codegen.wholeStage": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    """Point in time at UTC, as ``2025-03-04 13:40``."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


@pytest.fixture
def staged(spark):
    """Staging rows from dictionaries; the rest of the columns is null."""

    def make(*rows: dict):
        full = []
        for row in rows:
            base = dict.fromkeys(STAGED.fieldNames())
            base.update(flight_date=date(2025, 3, 4), ingest_time=at("2025-03-04 10:00"))
            base.update(row)
            full.append(tuple(base[name] for name in STAGED.fieldNames()))
        return spark.createDataFrame(full, STAGED)

    return make


@pytest.fixture
def table(spark):
    """Rows of a schema from tuples."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def tuples(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
