"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, suppress
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from skyledger.sources.files import Folder

# Runtime settings the operators rely on: UTC for every text/time conversion, ANSI so that
# unexpected input fails instead of wrapping, AQE for skew splitting and partition sizing.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def runtime_filters(
    spark: SparkSession, scan_bytes: str = "1g", keys: int = 10_000_000, build_bytes: str = "1g"
) -> SparkSession:
    """Let Spark filter scans of ``scan_bytes`` and more by the keys of a join's other side.

    The filter takes 8 bits for each of ``keys``; sides larger than ``build_bytes`` make none.
    """
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    for name, value in {
        "enabled": "true", "applicationSideScanSizeThreshold": scan_bytes,
        "creationSideThreshold": build_bytes, "expectedNumItems": keys,
        "maxNumItems": keys, "numBits": 8 * keys, "maxNumBits": 8 * keys,
    }.items():
        spark.conf.set(f"{prefix}.{name}", str(value))
    return spark


# Fixed when a session starts: no Python call site is recorded for every column expression.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build(app: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder all executors see.

    The cluster names it in ``spark.checkpoint.dir``. A folder of this machine is used only
    where nothing is named and the master is local, as in tests.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="skyledger-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
        current = context.getCheckpointDir()
    return current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Tables written outside of any ``scratch_tables`` block.
_open: list[str] = []
# Lists that take the paths of new tables, the innermost block's last.
_written: ContextVar[tuple[list[str], ...]] = ContextVar("written", default=(_open,))


def materialize(df: DataFrame, outlive: bool = False) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, fixes values that depend on the physical
    layout, and gives the planner the true size of what follows. The table goes at the end of
    the ``scratch_tables`` block around the call, else with ``drop_scratch``; with ``outlive`` it
    belongs to the block around that one.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "table")
    lists = _written.get()
    written = lists[-2] if outlive and len(lists) > 1 else lists[-1]
    if written is _open and not _open:
        atexit.register(_drop_at_exit)
    written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _drop_at_exit() -> None:
    with suppress(Exception):  # the cluster may be gone by now
        drop_scratch()


def _drop(spark: SparkSession | None, tables: list[str], keep: DataFrame | None = None) -> None:
    read = [] if keep is None or not tables else keep.inputFiles()
    for path in list(tables):
        name = path.rsplit("/", 1)[1]
        if spark is not None and not any(f"/{name}/" in file for file in read):
            Folder(spark, path).delete("")
            tables.remove(path)


def drop_scratch() -> None:
    """Drop the tables that ``materialize`` wrote outside of ``scratch_tables``.

    Frames made from them are lost. Runs by itself when the driver ends; call it between the
    jobs of a long session.
    """
    _drop(SparkSession.getActiveSession(), _open)


@contextmanager
def scratch_tables(
    spark: SparkSession, tables: list[str] | None = None, before: DataFrame | None = None
) -> Iterator[None]:
    """Drop the tables that ``materialize`` writes inside when the block ends.

    With a list for ``tables`` they stay there: those that an earlier block with the list has
    left are dropped at the start, but for what ``before`` reads.
    """
    own = [] if tables is None else tables
    _drop(spark, own, before)
    token = _written.set((*_written.get(), own))
    try:
        yield
    finally:
        _written.reset(token)
        if tables is None:
            _drop(spark, own)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run independent jobs at the same time, so one fills the cores another leaves idle.

    Returns their results in order; waits for all before the first error is raised.
    """
    wrap = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        futures = [pool.submit(copy_context().run, wrap(job)) for job in jobs]
    return [future.result() for future in futures]
