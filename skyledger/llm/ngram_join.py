"""Similarity join of documents on the Jaccard of their word n-grams, by MinHash banding.

Equal texts are one class. Every class has a signature; bands of it are shuffled by their hashes.
A bucket of equal band hashes is compared inside a task on the full n-gram sets, large buckets in
blocks against blocks, and yields link counts and a spanning forest per text: no list of pairs
is made. Only a text whose set is larger than a block is cut by ranges of its hashes, and the
overlaps of its pairs are added. A pair counts in the first band that its texts share, so it
counts once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.graph import components
from skyledger.llm.groups import roots_of, sorted_groups
from skyledger.session import materialize, scratch_tables

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999999
BAND_ROWS = 5
# Bands that ``one_of_each`` compares first: buckets of the others whose texts hang together by
# then are settled.
FIRST_BANDS = 4
# A block of a bucket has about so many texts and bytes of n-grams at most.
BLOCK_TEXTS = 400
BLOCK_BYTES = 16 << 20
# Bytes of rows with n-grams that a task makes at a time, and n-grams it compares at a time.
OUT_BYTES = 16 << 20
AT_ONCE = 1 << 20
# Words hashed at a time, so that a very long text needs no more memory than others.
SLICE = 1 << 16


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` hashes that find a pair at ``similarity`` with ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


# n-grams and signatures --------------------------------------------------------------------

_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_BACK = pow(_BASE, -1, 2**64)


class Grams:
    """Distinct 64-bit hashes of a text's n-grams of words.

    Words are runs without blanks, in lower case. Hashes of byte spans come from one running
    sum over the text. Fewer words than ``words`` make one n-gram of them all; no word, none.
    """

    def __init__(self, words: int):
        self.words = words
        self.powers = self.back = np.empty(0, dtype=np.uint64)

    def _reach(self, n: int) -> None:
        if self.powers.size < n:
            size = max(n, 2 * self.powers.size, 1 << 14)
            for name, base in (("powers", _BASE), ("back", _BASE_BACK)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def of(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0, dtype=np.uint64)
        size = min(self.words, len(words))
        found = []
        for begin in range(0, len(words) - size + 1, SLICE):
            part = words[begin:begin + SLICE + size - 1]
            text = np.frombuffer(b" ".join(part), dtype=np.uint8)
            self._reach(text.size + 1)
            sums = np.zeros(text.size + 1, dtype=np.uint64)
            np.cumsum(_BYTE[text] * self.powers[:text.size], out=sums[1:])
            lengths = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
            ends = np.cumsum(lengths + 1) - 1
            starts = ends - lengths
            first, last = starts[:len(part) - size + 1], ends[size - 1:]
            hashes = (sums[last] - sums[first]) * self.back[first]
            hashes ^= hashes >> np.uint64(32)
            hashes *= np.uint64(0xD6E8FEB86659FD93)
            hashes ^= hashes >> np.uint64(32)
            found.append(np.unique(hashes))
        return np.unique(np.concatenate(found)) if len(found) > 1 else found[0]


def split(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def signature(grams: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Least value of every permutation over the n-grams."""
    x = (grams >> np.uint64(32)).astype(np.uint32) ^ grams.astype(np.uint32)
    out = np.full(factors.size, 2**32 - 1, dtype=np.uint32)
    for begin in range(0, x.size, 2048):
        part = factors[:, None] * x[None, begin:begin + 2048] + shifts[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def band_hashes(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = least.astype("<u4").reshape(bands, rows)
    return np.array([xxhash.xxh64_intdigest(p.tobytes(), k) for k, p in enumerate(parts)],
                    dtype=np.uint64).view(np.int64)


def _signed(df: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """Per row: uid, id, 128-bit key of its words, bytes of its n-grams, band hashes, its words
    under zstd; null where it has no words."""
    rng = np.random.default_rng(21)
    factors = rng.integers(0, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)

    names = ["key", "bytes", "bands", "packed"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, packer = Grams(words), zstandard.ZstdCompressor()
        for batch in batches:
            out = []
            for text in batch["text"]:
                own = split(text)
                if not own:
                    out.append((None, 0, None, None))
                    continue
                found = grams.of(own)
                least = signature(found, factors, shifts)
                joined = b" ".join(own)
                out.append((xxhash.xxh3_128_hexdigest(joined), found.nbytes,
                            band_hashes(least, bands, rows), packer.compress(joined)))
            frame = pd.DataFrame(out, columns=names)
            frame.insert(0, "uid", batch["uid"].array)
            frame.insert(1, "id", batch["id"].array)
            yield frame

    return df.mapInPandas(run, "uid long, id long, key string, bytes long, bands array<long>, "
                               "packed binary")


# buckets -----------------------------------------------------------------------------------


def _bucket_rows(candidates: DataFrame, words: int, similarity: float,
                 block_bytes: int) -> DataFrame:
    """A row per text, bucket and pair of blocks that the text takes part in.

    ``range`` is 0 where the text is whole: such a row has its words under zstd, which are
    fewer bytes than its n-grams. Texts larger than a block, and those of the same bucket that are large
    enough to link with one, have a row with the n-grams of every range of hashes.
    """
    names = ["band", "hash", "low", "high", "range", "id", "copies", "block", "limit", "size",
             "bands", "data"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, packer = Grams(words), zstandard.ZstdDecompressor()
        out, held = [], 0

        def pieces(row: tuple, ranges: int) -> Iterator[tuple[int, bytes]]:
            if row.bytes <= block_bytes:
                yield 0, row.packed
            if ranges > 1 and row.bytes >= similarity * block_bytes:
                found = grams.of(packer.decompress(row.packed).split())
                for k, part in enumerate(_cut([found], ranges), 1):
                    yield k, part[0].tobytes()

        for batch in batches:
            for row in batch.itertuples(index=False):
                bands = row.bands.astype("<i8").tobytes()
                for b in row.buckets:
                    own = xxhash.xxh64_intdigest(int(row.id).to_bytes(8, "little", signed=True),
                                                 9) % b["blocks"]
                    for part, data in pieces(row, b["ranges"]):
                        for other in range(b["blocks"]):
                            out.append((b["band"], b["hash"], min(own, other), max(own, other),
                                        part, row.id, row.copies, own, block_bytes // 8,
                                        row.bytes // 8, bands, data))
                            held += len(bands) + len(data)
                            if held >= OUT_BYTES:
                                yield pd.DataFrame(out, columns=names)
                                out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)

    return candidates.mapInPandas(
        run, "band int, hash long, low int, high int, range int, id long, copies long, "
        "block int, limit long, size long, bands binary, data binary")


def _cut(sets: list[np.ndarray], ranges: int) -> Iterator[list[np.ndarray]]:
    """The parts of sorted sets in equal ranges of hashes."""
    cuts = np.array([(k << 64) // ranges for k in range(1, ranges)], dtype=np.uint64)
    places = [[0, *np.searchsorted(s, cuts).tolist(), s.size] for s in sets]
    for k in range(ranges):
        yield [s[at[k]:at[k + 1]] for s, at in zip(sets, places, strict=True)]


def _overlaps(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Common n-grams of the pairs (first, second) of sets, some ranges of hashes at a time."""
    out = np.zeros(first.size, dtype=np.int64)
    for parts in _cut(sets, max(1, -(-sum(s.size for s in sets) // AT_ONCE))):
        out += _common(parts, first, second)
    return out


def _common(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    if first.size <= 64 or len(sets) < 16:
        held: dict[int, set] = {}
        out = np.empty(first.size, dtype=np.int64)
        for k, (a, b) in enumerate(zip(first.tolist(), second.tolist(), strict=True)):
            for own in (a, b):
                if own not in held:
                    held[own] = set(sets[own].tolist())
            out[k] = len(held[a] & held[b])
        return out
    # n-grams of one text alone are common to no pair
    owner = np.repeat(np.arange(len(sets)), [s.size for s in sets])
    values, place, times = np.unique(np.concatenate(sets), return_inverse=True,
                                     return_counts=True)
    shared = times[place] > 1
    owner, place = owner[shared], place[shared]
    _, place = np.unique(place, return_inverse=True)
    width = int(place.max()) + 1 if place.size else 0
    rows, back = np.unique(np.concatenate([first, second]), return_inverse=True)
    left, right = np.unique(first), np.unique(second)
    table = np.zeros((left.size, right.size), dtype=np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for begin in range(0, width, 4096):
        low, high = np.searchsorted(place, [begin, begin + 4096])
        held = np.zeros((len(sets), min(4096, width - begin)), dtype=np.float32)
        held[owner[low:high], place[low:high] - begin] = 1
        table += held[left] @ held[right].T
    return table[np.searchsorted(left, first), np.searchsorted(right, second)].astype(np.int64)


def _bucket_links(group: pd.DataFrame, similarity: float) -> pd.DataFrame | None:
    """Links inside one bucket, or between two blocks of it: per text the number of linked
    documents and the smallest text it hangs together with here. In a range of hashes: the
    common n-grams of the pairs with a text larger than a block."""
    group = group.sort_values("id").drop_duplicates("id")
    sets = [np.frombuffer(data, dtype=np.uint64) for data in group["grams"]]
    bands = np.stack([np.frombuffer(data, dtype="<i8") for data in group["bands"]])
    band = int(group["band"].iloc[0])
    low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
    block = group["block"].to_numpy()
    sizes = group["size"].to_numpy()
    first, second = np.triu_indices(len(sets), 1)
    able = np.minimum(sizes[first], sizes[second]) >= similarity * np.maximum(
        sizes[first], sizes[second])
    part = int(group["range"].iloc[0])
    if part:
        able &= np.maximum(sizes[first], sizes[second]) > group["limit"].iloc[0]
    if low != high:
        able &= block[first] != block[second]
    first, second = first[able], second[able]
    if band:
        before = np.zeros(first.size, dtype=bool)
        for k in range(band):
            before |= bands[first, k] == bands[second, k]
        first, second = first[~before], second[~before]
    if not first.size:
        return None
    common = _overlaps(sets, first, second)
    copies, ids = group["copies"].to_numpy(), group["id"].to_numpy()
    if part:
        return pd.DataFrame({
            "id": ids[first], "links": copies[first], "root": ids[second], "common": common,
            "sizes": sizes[first] + sizes[second], "others": copies[second]})
    near = common >= similarity * (sizes[first] + sizes[second] - common) - 1e-9
    first, second = first[near], second[near]
    if not first.size:
        return None
    links = np.bincount(first, copies[second], len(sets)) + np.bincount(
        second, copies[first], len(sets))
    out = links > 0
    roots = roots_of(len(sets), first, second)
    return pd.DataFrame({"id": ids[out], "links": links[out].astype(np.int64),
                         "root": ids[roots[out]], "common": None, "sizes": None,
                         "others": None})


def join_ngrams(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    band_rows: int = BAND_ROWS,
    block_texts: int = BLOCK_TEXTS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents joined on the Jaccard of their sets of ``words``-grams.

    Returns a row per row of ``df``: doc_id, ``copy_id`` (smallest id with the same words),
    ``n_links`` (other rows at ``similarity`` or more, copies included) and ``class_id``
    (smallest id reachable by links). A pair at ``similarity`` is found with probability
    ``recall``, a closer one with more; every pair found is verified on its full sets.

    Texts differ only by their words in lower case. A null text or one without words links with
    nothing. Repeated rows are copies of each other. Rows link by their texts, never by ids: an
    id may stand for many texts, and rows with a null id link like others; where all ids are
    null, ``copy_id`` and ``class_id`` are. An empty table gives an empty table.
    """
    slim = df.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"))
    joined = _joined(slim, words, similarity, recall, band_rows, block_texts, block_bytes)
    return joined.select(F.col("id").alias("doc_id"), "copy_id", "n_links", "class_id")


def one_of_each(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    band_rows: int = BAND_ROWS,
    block_texts: int = BLOCK_TEXTS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Exactly one row of ``df`` for each group of texts that links connect.

    It is a row with the smallest id, null last; of several any one. A row without words is a
    group of its own. Ids may repeat, also with other texts.
    """
    spark = df.sparkSession
    rows = materialize(df.select(
        F.monotonically_increasing_id().alias("uid"), F.struct("*").alias("row")))
    slim = rows.select("uid", F.col("row")[id_col].cast("long").alias("id"),
                       F.col("row")[text_col].alias("text"))
    with scratch_tables(spark):
        grouped = _grouped(slim, words, similarity, recall, band_rows, block_texts, block_bytes)
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid"))
        kept = materialize(
            grouped.where("class IS NOT NULL").groupBy("class").agg(first.alias("first"))
            .select("first.uid").unionByName(grouped.where("class IS NULL").select("uid")),
            outlive=True)
    return rows.join(kept, "uid", "left_semi").select("row.*")


def _grouped(slim, words, similarity, recall, band_rows, block_texts, block_bytes) -> DataFrame:
    """Per row (uid, id, text) its ``class``: the smallest uid that the links between texts lead
    to, null without words.

    The first bands are compared as a whole. A bucket of a later band is compared only if its
    texts do not hang together by then; so every link between two groups is still found.
    """
    bands = bands_for(similarity, recall, band_rows)
    signed, classes = _classes(slim, words, bands, band_rows)
    met = materialize(_met(classes))
    first, later = met.where(F.col("band") < FIRST_BANDS), met.where(F.col("band") >= FIRST_BANDS)
    compared = materialize(_buckets(first, block_bytes))
    near = materialize(_found(signed, classes, first, compared, words, similarity, block_texts,
                              block_bytes))
    groups = materialize(components(_edges(near, similarity)))
    known = later.join(groups.withColumnRenamed("node", "uid"), "uid", "left").withColumn(
        "group", F.coalesce("component", "uid"))
    settled = F.min("group") == F.max("group")
    # nor is one with the same texts as a bucket of the first bands
    open_ = materialize(_buckets(known, block_bytes, ~settled).join(
        compared.select("n", "texts"), ["n", "texts"], "left_anti"))
    far = _found(signed, classes, later, open_, words, similarity, block_texts, block_bytes)
    parts = components(
        groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(
            _edges(materialize(far), similarity)))
    by_text = classes.select("key", "uid").join(
        parts.withColumnRenamed("node", "uid"), "uid", "left").select(
        "key", F.coalesce("component", "uid").alias("class"))
    return signed.select("uid", "id", "key").join(by_text, "key", "left").drop("key")


def _edges(found: DataFrame, similarity: float) -> DataFrame:
    return _all_links(found, similarity).select(F.col("id").alias("a"), F.col("root").alias("b"))


def _joined(slim, words, similarity, recall, band_rows, block_texts, block_bytes) -> DataFrame:
    """Per row (uid, id, text) the results and its ``class``: the smallest uid that the links
    between texts lead to, null without words. A text goes by the smallest uid that has it."""
    bands = bands_for(similarity, recall, band_rows)
    signed, classes = _classes(slim, words, bands, band_rows)
    met = materialize(_met(classes))
    buckets = materialize(_buckets(met, block_bytes))
    found = materialize(_found(
        signed, classes, met, buckets, words, similarity, block_texts, block_bytes))
    return _linked(signed, classes, _all_links(found, similarity))


def _classes(slim: DataFrame, words: int, bands: int, band_rows: int) -> tuple:
    """Rows with keys and bands, and a row per text; both written."""
    signed = materialize(_signed(slim, words, bands, band_rows))
    classes = materialize(
        signed.where(F.col("key").isNotNull())
        .groupBy("key").agg(F.min("uid").alias("uid"), F.min("id").alias("copy_id"),
                            F.count(F.lit(1)).alias("copies"), F.first("bytes").alias("bytes"),
                            F.first("bands").alias("bands"))
    )
    return signed, classes


def _met(classes: DataFrame) -> DataFrame:
    """Texts and their band hashes (uid, bytes, band, hash), those without another text left out.

    All bands are shuffled here, once; what follows reads only the texts that meet another.
    """
    spread = classes.select("uid", "bytes", F.posexplode("bands").alias("band", "hash"))
    texts = F.count(F.lit(1)).over(Window.partitionBy("band", "hash"))
    return spread.withColumn("n", texts).where("n > 1").drop("n")


def _buckets(met: DataFrame, block_bytes: int, wanted: Column | None = None) -> DataFrame:
    """A bucket per band hash of several texts; of buckets with the same texts the first.

    ``wanted`` is a condition on the texts of a bucket.
    """
    # a text larger than a block is cut, so its part counts as one
    part = F.least("bytes", F.lit(block_bytes))
    return (
        met.groupBy("band", "hash").agg(
            F.count(F.lit(1)).alias("n"), F.sum(part).alias("bytes"),
            F.max("bytes").alias("most"),
            F.sum(F.xxhash64("uid").cast("decimal(38,0)")).alias("texts"),
            (F.lit(True) if wanted is None else wanted).alias("wanted"))
        .where("n > 1 AND wanted").groupBy("n", "texts")
        .agg(F.min(F.struct("band", "hash", "bytes", "most")).alias("own"))
        .select("own.band", "own.hash", "n", "texts", "own.bytes", "own.most")
    )


def _found(signed, classes, met, buckets, words, similarity, block_texts,
           block_bytes) -> DataFrame:
    """What ``_bucket_links`` finds in the buckets."""
    blocks = F.greatest(F.ceil(F.col("n") / block_texts), F.ceil(F.col("bytes") / block_bytes))
    ranges = F.ceil(F.col("most") / block_bytes)
    members = (
        met.drop("bytes").join(buckets.drop("texts"), ["band", "hash"])
        .groupBy("uid")
        .agg(F.collect_list(F.struct("band", "hash", blocks.cast("int").alias("blocks"),
                                     ranges.cast("int").alias("ranges"))).alias("buckets"))
    )
    # one text of each class that is in a bucket
    wanted = classes.join(members, "uid").select("uid", "copies", "bytes", "bands", "buckets")
    own = signed.select("uid", "packed").join(wanted, "uid")
    rows = _bucket_rows(
        own.select(F.col("uid").alias("id"), "packed", "copies", "bytes", "bands", "buckets"),
        words, similarity, block_bytes)
    group = ["band", "hash", "low", "high", "range"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, packer = Grams(words), zstandard.ZstdDecompressor()
        for part in sorted_groups(batches, group):
            whole = int(part["range"].iloc[0]) == 0
            sets = [grams.of(packer.decompress(data).split()).tobytes() if whole else data
                    for data in part["data"]]
            found = _bucket_links(part.drop(columns="data").assign(grams=sets), similarity)
            if found is not None:
                yield found

    return rows.repartition(*group).sortWithinPartitions(*group).mapInPandas(
        run, "id long, links long, root long, common long, sizes long, others long")


def _all_links(found: DataFrame, similarity: float) -> DataFrame:
    """Links of texts: (id, links, root), those found in ranges of hashes included."""
    whole = found.where("common IS NULL").select("id", "links", "root")
    # the pairs of texts larger than a block, their ranges added
    large = (
        found.where("common IS NOT NULL").groupBy("id", "root")
        .agg(F.sum("common").alias("common"), F.first("sizes").alias("sizes"),
             F.first("links").alias("copies"), F.first("others").alias("others"))
        .where(F.col("common") >= similarity * (F.col("sizes") - F.col("common")) - 1e-9)
    )
    return whole.unionByName(
        large.select("id", F.col("others").alias("links"), "root")).unionByName(
        large.select(F.col("root").alias("id"), F.col("copies").alias("links"),
                     F.col("id").alias("root")))


def _linked(signed: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Per row of ``signed`` its class, number of links and smallest ids."""
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    by_text = materialize(
        classes.select("key", "uid", "copy_id", "copies")
        .join(links.withColumnRenamed("id", "uid"), "uid", "left")
        .join(parts.withColumnRenamed("node", "uid"), "uid", "left")
        .select("key", "copy_id",
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "uid").alias("class"))
    )
    lowest = by_text.groupBy("class").agg(F.min("copy_id").alias("class_id"))
    by_text = by_text.join(lowest, "class")
    return signed.select("uid", "id", "key").join(by_text, "key", "left").select(
        "uid", "id", "class", F.coalesce("copy_id", "id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("class_id", "id").alias("class_id"),
    )
