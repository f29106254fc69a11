"""Near-duplicate vectors by collision-counting projections.

Vectors of a label are projected on many random directions. Every projection is sorted; a query's
window on it is a range of ranks around the query. The windows that a pair shares are counted,
and pairs with enough of them are verified by their cosine. Window and count are calibrated so
that a pair at the threshold passes with the wanted recall.

Equal vectors are one class. Labels are cut into blocks that meet pairwise in tasks, which give
link counts and a spanning forest per vector: no list of pairs is made, and no task holds more
than two blocks. The number of block pairs grows with the square of a label's distinct vectors:
one-dimensional windows are too wide to leave any of them out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.graph import components
from skyledger.llm.groups import roots_of, sorted_groups
from skyledger.session import materialize

SIMILARITY = 0.93
RECALL = 0.9999
PROJECTIONS = 32
# Half a window in standard deviations of the difference of a pair at the threshold.
WINDOW = 2.0
BLOCK = 1000


def calibrate(similarity: float, recall: float, projections: int, window: float) -> tuple[float, int]:
    """Half the window, and the collisions that a pair needs.

    Unit vectors at ``similarity`` are sqrt(2 - 2 * similarity) apart; along a Gaussian
    direction they differ by a normal variable with that deviation. The collisions of the pair
    are binomial: the count is the largest that it reaches with probability ``recall``.
    """
    apart = math.sqrt(2 - 2 * similarity)
    chance = math.erf(window / math.sqrt(2))
    tail, need = 0.0, 0
    for hits in range(projections + 1):
        tail += math.comb(projections, hits) * chance**hits * (1 - chance) ** (projections - hits)
        if tail > 1 - recall:
            break
        need = hits + 1
    return window * apart, need


def _units(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.frombuffer(v, dtype="<f8") for v in vectors])
    # the squares of very large and very small components would not fit a double; a subnormal
    # is scaled in two steps, as its inverse does not fit either
    x = x * 2.0 ** -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1].clip(-1000, 1000)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pairs(query: np.ndarray, base: np.ndarray, half: float, need: int, seed: int,
           projections: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, base) that collide often enough; with ``same`` each pair once."""
    rng = np.random.default_rng(seed)
    count = np.zeros((len(query), len(base)), dtype=np.int8)
    for _ in range(projections):
        direction = rng.standard_normal(query.shape[1])
        at, line = query @ direction, base @ direction
        order = np.argsort(line, kind="stable")
        rank = np.empty(len(base), dtype=np.int16)
        rank[order] = np.arange(len(base), dtype=np.int16)
        line = line[order]
        low = np.searchsorted(line, at - half, "left").astype(np.int16)
        high = np.searchsorted(line, at + half, "right").astype(np.int16)
        count += (rank >= low[:, None]) & (rank < high[:, None])
    passed = count >= need
    if same:
        passed = np.triu(passed, 1)
    return np.nonzero(passed)


def _block_links(group: pd.DataFrame, similarity: float, half: float, need: int,
                 projections: int, seed: int) -> pd.DataFrame | None:
    """Links of two blocks of a label, or inside one: per vector the number of linked vectors and
    the smallest one it hangs together with here."""
    group = group.sort_values("uid")
    x = _units(group["vector"])
    low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
    block = group["block"].to_numpy()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    a, b = _pairs(x[left], x[right], half, need, seed, projections, low == high)
    first, second = left[a], right[b]
    if first.size > 0.02 * left.size * right.size:
        near = (x[left] @ x[right].T)[a, b] >= similarity
    else:
        near = np.concatenate([np.empty(0, dtype=bool), *[
            np.einsum("ij,ij->i", x[first[k:k + 65536]], x[second[k:k + 65536]]) >= similarity
            for k in range(0, first.size, 65536)]])
    first, second = first[near], second[near]
    if not first.size:
        return None
    ids, copies = group["uid"].to_numpy(), group["copies"].to_numpy()
    links = np.bincount(first, copies[second], len(x)) + np.bincount(
        second, copies[first], len(x))
    out = links > 0
    roots = roots_of(len(x), first, second)
    return pd.DataFrame({"uid": ids[out], "links": links[out].astype(np.int64),
                         "root": ids[roots[out]]})


def dedup_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    projections: int = PROJECTIONS,
    window: float = WINDOW,
    block: int = BLOCK,
    seed: int = 17,
) -> DataFrame:
    """Links between vectors of equal labels at a cosine of ``similarity`` or more.

    Returns a row per row of ``df``: vec_id, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable by links) and ``kept`` (vec_id is component_id).

    A null label or id, or a vector that is null, empty, zero or holds null or non-finite
    numbers, links with nothing; a null id has a null component and is kept. Vectors of another
    length are no neighbours. Repeated rows are links of each other. Vectors link by themselves,
    never by ids: an id may stand for several vectors, each row with the links of its own.
    Components of any finite size are compared. An empty table gives an empty table.
    """
    half, need = calibrate(similarity, recall, projections, window)
    rows = df.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    able = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
        & ~bad & F.exists("vector", lambda x: x != 0)
    )
    # zeros lose their sign, so equal vectors have equal hashes
    plain = F.transform("vector", lambda x: x + 0.0)
    key = F.when(F.coalesce(able, F.lit(False)), F.concat_ws(
        ":", F.xxhash64("label", plain).cast("string"),
        F.xxhash64(F.lit(1), "label", plain).cast("string")))
    keyed = rows.withColumn("key", key)
    classes = materialize(
        keyed.where(F.col("key").isNotNull()).groupBy("key").agg(
            F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"),
            F.first(F.struct("label", "vector")).alias("of"))
        .select("key", "vec_id", "copies", "of.label", "of.vector",
                F.size("of.vector").alias("dim"), F.monotonically_increasing_id().alias("uid"))
    )
    sizes = classes.groupBy("label", "dim").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 0")
    own = F.pmod(F.xxhash64(F.lit(seed), "key"), F.col("blocks")).cast("int")
    group = ["label", "dim", "low", "high"]
    dealt = (
        classes.join(sizes, ["label", "dim"]).withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("label", "dim", F.least("block", "other").alias("low"),
                F.greatest("block", "other").alias("high"), "block", "uid", "copies",
                "vector")
        .withColumn("group", F.xxhash64(*group))
    )
    packed = dealt.mapInPandas(_packed, "group long, label string, dim int, low int, high int, "
                               "block int, uid long, copies long, vector binary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in sorted_groups(batches, ["group", *group]):
            found = _block_links(part, similarity, half, need, projections, seed)
            if found is not None:
                yield found

    found = materialize(
        packed.repartition("group").sortWithinPartitions("group", *group)
        .mapInPandas(run, "uid long, links long, root long"))
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    by_class = materialize(
        classes.select("key", "vec_id", "uid", "copies")
        .join(links, "uid", "left")
        .join(parts.withColumnRenamed("node", "uid"), "uid", "left")
        .select("key", "vec_id",
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "uid").alias("component"))
    )
    lowest = by_class.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    by_class = by_class.drop("vec_id").join(lowest, "component").drop("component")
    out = keyed.select("vec_id", "key").join(by_class, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors as bytes, which are cheaper to sort and to send than arrays."""
    for batch in batches:
        yield pd.DataFrame({
            "group": batch["group"], "label": batch["label"].astype(str), "dim": batch["dim"],
            "low": batch["low"], "high": batch["high"], "block": batch["block"],
            "uid": batch["uid"], "copies": batch["copies"],
            "vector": [np.asarray(v, dtype="<f8").tobytes() for v in batch["vector"]],
        })
