"""Line dedup: lines of many documents are indexed by a sharded minimal perfect hash.

One aggregate counts the documents of every distinct line hash. The lines at or over the
threshold go into shards; each shard is a minimal perfect hash (bit levels with ranks) whose
slots hold a 64-bit fingerprint, the count and the last document. Documents probe these arrays.

The arrays of the most frequent lines, of bounded size, are sent to the executors and probed in
place: no line is joined, no text is shuffled. If there are more lines, the hashes of lines that
are not found there travel to the shard that would hold them and are probed in it. None of those
is frequent, so all shards get about as many.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyledger.llm.columns import BLANKS, LOWER, UPPER
from skyledger.session import materialize

# Bytes of the arrays that are sent to the executors, and what a line takes of them.
INDEX_BYTES = 64 << 20
KEY_BYTES = 24
# Lines that a shard holds, and lines of documents that come to a shard to be probed.
KEYS_PER_SHARD = 200_000
PROBES_PER_SHARD = 1_000_000
ABSENT = -(2**63)
# What a probe says of a line: in no array, found and kept, found and dropped.
UNKNOWN, STAYS, GOES = 0, 1, 2


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


# minimal perfect hash ----------------------------------------------------------------------


def _spread(key: np.ndarray, level: int) -> np.ndarray:
    """64-bit mixing of a hash, another one for each level."""
    x = key + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Maps n distinct (first, second) hash pairs to 0..n-1; other pairs to some slot or -1.

    A level is a bit array twice as long as the keys it gets. Keys alone at their bit stay,
    the others go to the next level. The slot is the number of set bits before the key's bit.
    Levels use the first and the second hash by turns, so equal first hashes part at once.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.bits: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        placed = 0
        while first.size:
            level = len(self.bits)
            length = -(-2 * first.size // 64) * 64
            at = _spread(first if level % 2 == 0 else second, level) % np.uint64(length)
            at = at.astype(np.int64)
            alone = np.bincount(at, minlength=length) == 1
            packed = np.packbits(alone, bitorder="little").view("<u8")
            ones = np.bitwise_count(packed).astype(np.int64)
            self.bits.append(packed)
            self.ranks.append(placed + np.cumsum(ones) - ones)
            placed += int(ones.sum())
            rest = ~alone[at]
            first, second = first[rest], second[rest]

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.full(first.size, -1, dtype=np.int64)
        open_ = np.arange(first.size)
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks, strict=True)):
            key = first[open_] if level % 2 == 0 else second[open_]
            at = (_spread(key, level) % np.uint64(bits.size * 64)).astype(np.int64)
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (ranks[at >> 6] + np.bitwise_count(below))[hit]
            open_ = open_[~hit]
        return out


class Shard:
    """Perfect hash of the lines of one shard with fingerprint, count and last document."""

    def __init__(self, first, second, count, last):
        self.hash = PerfectHash(first, second)
        slot = self.hash.slots(first, second)
        self.mark = np.empty(first.size, dtype=np.uint64)
        self.count = np.empty(first.size, dtype=np.int32)
        self.last = np.empty(first.size, dtype=np.int64)
        self.mark[slot] = second
        self.count[slot] = np.minimum(count, 2**31 - 1)
        self.last[slot] = last

    def dump(self) -> bytes:
        return pickle.dumps((self.hash.bits, self.hash.ranks, self.mark, self.count, self.last))

    @classmethod
    def load(cls, data: bytes) -> Shard:
        shard = cls.__new__(cls)
        shard.hash = PerfectHash.__new__(PerfectHash)
        shard.hash.bits, shard.hash.ranks, shard.mark, shard.count, shard.last = pickle.loads(data)
        return shard

    def probe(self, first, second) -> tuple[np.ndarray, np.ndarray]:
        """Count and last document per hash pair; count 0 where the shard does not hold it."""
        slot = self.hash.slots(first, second)
        if not self.mark.size:
            return np.zeros(first.size, dtype=np.int64), np.full(first.size, ABSENT)
        here = (slot >= 0) & (self.mark[slot] == second)
        return np.where(here, self.count[slot], 0), np.where(here, self.last[slot], ABSENT)


def shard_of(first: np.ndarray, shards: int) -> np.ndarray:
    return ((first >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    shard = Shard(
        group["first"].to_numpy(np.int64).view(np.uint64),
        group["second"].to_numpy(np.int64).view(np.uint64),
        group["n"].to_numpy(np.int64),
        group["last"].to_numpy(np.int64),
    )
    return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "data": [shard.dump()]})


# operator ----------------------------------------------------------------------------------


def _pairs(keys: Column) -> Column:
    """Two independent 64-bit hashes per key."""
    return F.transform(
        keys,
        lambda k: F.struct(F.xxhash64(k).alias("first"), F.xxhash64(k, F.lit(1)).alias("second")),
    )


def common_lines(
    df: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int,
    seen: Observation | None = None,
) -> DataFrame:
    """Hash pair, number of documents and largest id of every line of ``min_docs`` documents.

    ``seen`` gets the number of ``lines`` that were counted, once per document.
    """
    keys = F.transform(split_lines(F.col(text_col)), line_key)
    own = F.array_distinct(F.filter(keys, lambda k: F.char_length(k) >= min_chars))
    lines = df.select(F.col(id_col).alias("id"), F.explode(_pairs(own)).alias("line"))
    if seen is not None:
        lines = lines.observe(seen, F.count(F.lit(1)).alias("lines"))
    return (
        lines.groupBy(F.col("line.first").alias("first"), F.col("line.second").alias("second"))
        .agg(F.count(F.lit(1)).alias("n"),
             F.coalesce(F.max("id"), F.lit(ABSENT)).alias("last"))
        .where(F.col("n") >= min_docs)
    )


def _number(first: Column, shards: int) -> Column:
    """``shard_of`` as an expression."""
    return F.shiftrightunsigned(first, 32) % shards


def _index(lines: DataFrame, shards: int) -> DataFrame:
    """The arrays of ``lines``, a row per shard that holds any."""
    return materialize(
        lines.withColumn("shard", _number(F.col("first"), shards)).groupBy("shard")
        .applyInPandas(_build, "shard long, data binary")
    )


def _verdicts(shard: Shard, first: np.ndarray, second: np.ndarray, own: np.ndarray,
              min_docs: int) -> np.ndarray:
    count, last = shard.probe(first, second)
    return np.where(count < min_docs, UNKNOWN, np.where(last == own, STAYS, GOES))


def _in_place(lined: DataFrame, payloads: list[bytes], min_docs: int) -> DataFrame:
    """``lined`` with ``state`` per line, from arrays that every executor has."""
    shards = lined.sparkSession.sparkContext.broadcast(payloads)

    @F.pandas_udf("array<tinyint>")
    def probe(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        index = [Shard.load(data) for data in shards.value]
        for ids, firsts, seconds in batches:
            sizes = firsts.map(len).to_numpy()
            first = np.concatenate(firsts.to_numpy()).astype(np.int64).view(np.uint64)
            second = np.concatenate(seconds.to_numpy()).astype(np.int64).view(np.uint64)
            own = np.repeat(ids.to_numpy(np.int64), sizes)
            out = np.zeros(first.size, dtype=np.int8)
            where = shard_of(first, len(index))
            for number, shard in enumerate(index):
                at = np.flatnonzero(where == number)
                out[at] = _verdicts(shard, first[at], second[at], own[at], min_docs)
            yield pd.Series(np.split(out, np.cumsum(sizes)[:-1]))

    return lined.withColumn("state", probe("own", F.col("pairs.first"), F.col("pairs.second")))


def _in_shards(lined: DataFrame, index: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """``lined`` with ``state`` also for the lines of ``index``, which are probed in its shards.

    What becomes of a row's lines follows from its id and text, so rows alike in both share one
    answer, and rows without an id are told apart by their texts.
    """
    row = ["own", "text_first", "text_second"]
    asked = F.filter(F.arrays_zip("pairs", "long", "state"),
                     lambda p: p["long"] & (p["state"] == UNKNOWN))
    pairs = F.array_distinct(F.transform(asked, lambda p: p["pairs"]))
    probes = lined.select(*row, F.explode(pairs).alias("p")).select(
        *row, "p.first", "p.second", _number(F.col("p.first"), shards).alias("shard"))

    def probe(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        columns = [*row, "first", "second"]
        if held.empty or asking.empty:
            return asking.loc[[], columns]
        state = _verdicts(
            Shard.load(held["data"].iloc[0]), asking["first"].to_numpy(np.int64).view(np.uint64),
            asking["second"].to_numpy(np.int64).view(np.uint64), asking["own"].to_numpy(np.int64),
            min_docs)
        return asking.loc[state == GOES, columns]

    found = materialize(
        probes.groupBy("shard").cogroup(index.groupBy("shard"))
        .applyInPandas(probe, ", ".join(f"{c} long" for c in [*row, "first", "second"]))
        .groupBy(*row).agg(F.collect_set(F.struct("first", "second")).alias("found"))
    )
    late = F.transform("pairs", lambda p: F.when(
        F.coalesce(F.array_contains("found", p), F.lit(False)), GOES).otherwise(UNKNOWN))
    return lined.join(found, row, "left").withColumn(
        "state", F.zip_with("state", late, lambda a, b: F.greatest(a.cast("int"), b)))


def dedup_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    index_bytes: int = INDEX_BYTES,
    keys_per_shard: int = KEYS_PER_SHARD,
) -> DataFrame:
    """Drop the lines that ``min_docs`` documents share, but for their last document.

    A line is common if its key (blanks at both ends off, A-Z lowered) has ``min_chars`` code
    points and is in ``min_docs`` rows. All its lines go, except in the rows with the largest id
    that holds it. Returns the columns of ``df`` with the text of the lines that stay, and
    ``n_lines``, ``n_dropped``; these two replace input columns of the same name.

    A null or empty text is one empty line. A row counts as one document, repeated ids included;
    rows that repeat the largest id all keep the line. A null id is smaller than any other. An
    empty table gives an empty table.

    ``index_bytes`` bounds the arrays that are probed in place. A line goes there if it is in more
    documents than the lines' documents over the number of lines that fit, which no more lines
    than that can be; if all lines fit, all go there.
    """
    seen = Observation()
    common = materialize(common_lines(df, id_col, text_col, min_chars, min_docs, seen))
    n, rows = common.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    fit = index_bytes // KEY_BYTES
    often = min_docs if n <= fit else rows // max(1, fit) + 1

    keys = F.transform("lines", line_key)
    text = F.coalesce(F.col(f"row.{text_col}"), F.lit(""))
    lined = (
        df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
        .select("row", F.coalesce(F.col(f"row.{id_col}").cast("long"), F.lit(ABSENT)).alias("own"),
                F.xxhash64(text).alias("text_first"), F.xxhash64(text, F.lit(1)).alias("text_second"),
                split_lines(F.col(f"row.{text_col}")).alias("lines"))
        .withColumn("keys", keys)
        .select("row", "own", "text_first", "text_second", "lines",
                _pairs(F.col("keys")).alias("pairs"),
                F.transform("keys", lambda k: F.char_length(k) >= min_chars).alias("long"))
    )
    marked = lined.withColumn(
        "state", F.transform("lines", lambda _: F.lit(UNKNOWN).cast("tinyint")))
    if n and often <= rows:
        shards = max(1, -(-min(n, fit) // keys_per_shard))
        empty = Shard(*[np.empty(0, dtype=t) for t in "QQqq"]).dump()
        held = {r["shard"]: bytes(r["data"])
                for r in _index(common.where(F.col("n") >= often), shards).collect()}
        marked = _in_place(lined, [held.get(k, empty) for k in range(shards)], min_docs)
    if often > min_docs:
        shards = max(-(-n // keys_per_shard), -(-seen.get.get("lines", 0) // PROBES_PER_SHARD))
        marked = _in_shards(
            marked, _index(common.where(F.col("n") < often), shards), shards, min_docs)
    gone = F.zip_with("state", "long", lambda state, long: (state == GOES) & long)
    kept = F.filter("lines", lambda _, i: ~F.get("gone", i))
    out = marked.select("row", "lines", gone.alias("gone")).select(
        "row", F.array_join(kept, "\n").alias("kept"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("gone", lambda g: g)).cast("long").alias("n_dropped"),
    )
    columns = [
        (F.col("kept") if c == text_col else F.col(f"row.`{c}`")).alias(c)
        for c in df.columns if c not in ("n_lines", "n_dropped")
    ]
    return out.select(*columns, "n_lines", "n_dropped")
