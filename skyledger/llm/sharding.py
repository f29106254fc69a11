"""Sharding: a two-pass external shuffle with DataFrame functions only.

Pass one scatters the records by a seeded hash into buckets that fit in memory. Pass two puts
every bucket in a Fisher-Yates order and writes it. The buckets, one after the other, are a
random order of all records; the shards are equal runs of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import materialize

BUCKET_BYTES = 16 << 20
# Bytes of buckets that a task shuffles, one bucket at a time in memory.
TASK_BYTES = 32 << 20


def record_bytes(df: DataFrame, text_col: str) -> int:
    """UTF-8 bytes of all texts and 16 for each row."""
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long") + 16
    return df.agg(F.sum(size)).first()[0] or 0


def shuffle_shards(
    df: DataFrame,
    shards: int = 40,
    text_col: str = "text",
    seed: int = 11,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The rows of ``df`` in random order, dealt to shards 0 to ``shards`` - 1.

    Adds ``shard`` and ``slot``, the row's place in its shard, gapless from 0; they replace
    input columns of the same name. Row counts of two shards differ by one at most: rank r of n
    rows is in shard floor(r * shards / n). Null texts count as empty. Equal rows are hashed
    with their number in the scan, so any number of copies spreads over all buckets. Fewer rows
    than shards leave shards empty; an empty table stays empty.
    """
    size = record_bytes(df, text_col)
    buckets = max(shards, -(-size // bucket_bytes))
    tasks = max(1, min(buckets, -(-size // TASK_BYTES)))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    place = F.monotonically_increasing_id()
    scattered = df.select(
        F.pmod(F.xxhash64(F.lit(seed), place), F.lit(buckets)).alias("bucket"),
        F.struct(place.alias("place"), row.alias("row")).alias("r"),
    ).withColumn("task", (F.col("bucket") % tasks).cast("int"))
    # A fixed order before the seeded shuffle, so a task that runs again repeats it.
    ordered = F.array_sort(F.collect_list("r"), lambda a, b: F.when(
        a["place"] < b["place"], -1).when(a["place"] > b["place"], 1).otherwise(0))
    written = materialize(
        # buckets are dealt by turns: a hash of so few would leave some tasks with many
        scattered.repartitionById(tasks, F.col("task")).groupBy("task", "bucket").agg(ordered.alias("rows"))
        .select("bucket", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("pos", "r"))
        .select("bucket", F.col("pos").cast("long").alias("pos"), "r.row")
    )
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket: bytes of input / bucket_bytes.
    starts = materialize(
        written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
                F.sum("n").over(Window.partitionBy()).alias("total"))
    )
    dealt = written.join(starts, "bucket").selectExpr(
        "row", "total", "start + pos as rank",
        f"cast((start + pos) * {shards} div total as int) as shard",
    )
    # the first rank whose shard is this one
    begin = F.expr(f"(cast(shard as bigint) * total + {shards - 1}) div {shards}")
    kept = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in ("shard", "slot")]
    return dealt.select(*kept, "shard", (F.col("rank") - begin).alias("slot"))
