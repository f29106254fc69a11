"""A Merkle manifest of a table: one tree of leaf digests per group and one tree of their roots.

Digests are lowercase hex SHA-256. In a tree, while there are several nodes, every eight
neighbours (the last run: what is left, also one) become the digest of their digests put together.

Trees are cut into superblocks of 8 ** 4 neighbours, whose ends are ends of runs, so a superblock
is reduced by itself and its top is a member of the same tree four levels up. ``reduced`` goes up
from members to tops until every tree is one digest. ``exchange`` goes down again: the members of
a superblock are cogrouped with the nodes outside of it that a proof needs (the path of its top)
and one function reduces the members again, joins both parts of the proof and, at the lowest
level, folds the leaf that a row claims to have with them.

A group with most of the rows is many superblocks; no task holds more than one, and the number of
rounds is the logarithm of the rows to the base 4096.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.joins import lookup_join
from skyledger.operators.keys import assign_ids
from skyledger.session import materialize

ARITY = 8
# Levels and members of a superblock.
LEVELS = 4
MEMBERS = ARITY ** LEVELS

# A node of a tree at some height: its place among ``members`` nodes there.
_NODE = "tree long, place long, members long, digest string"
# Way from a node to the root. For each level, from below: the digests of the siblings before
# the node, put together, and of those after it.
_PATH = (
    "tree long, place long, digest string, lefts array<string>, rights array<string>, "
    "subroot string, root string"
)


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(members: int) -> int:
    """Levels until one node is left, inside one superblock at most."""
    levels = 0
    while levels < LEVELS and members > 1:
        members = -(-members // ARITY)
        levels += 1
    return levels


def raised(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level above the members ``digests``."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([digest_of("".join(below[i:i + ARITY])) for i in range(0, len(below), ARITY)])
    return out


def siblings(levels: list[list[str]], place: int) -> tuple[list[str], list[str]]:
    """Siblings before and after the node at each level, up to the top of ``levels``."""
    lefts, rights = [], []
    for nodes in levels[:-1]:
        first = place - place % ARITY
        lefts.append("".join(nodes[first:place]))
        rights.append("".join(nodes[place + 1:first + ARITY]))
        place //= ARITY
    return lefts, rights


def folded(digest: str, lefts: list[str], rights: list[str]) -> str:
    for left, right in zip(lefts, rights, strict=True):
        digest = digest_of(left + digest + right)
    return digest


# leaves ------------------------------------------------------------------------------------


def encoded(value: Column) -> Column:
    """``-`` for null, else the value's length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


# trees -------------------------------------------------------------------------------------


def _block() -> Column:
    return F.floor(F.col("place") / MEMBERS).cast("long").alias("block")


def _tops(key: tuple, members: pd.DataFrame) -> pd.DataFrame:
    """The top of a superblock, as a member of the round above."""
    tree, block = key
    members = members.sort_values("place")
    count = int(members["members"].iloc[0])
    top = raised(members["digest"].tolist(), levels_of(count))[-1]
    return pd.DataFrame({"tree": [tree], "place": [block],
                         "members": [-(-count // MEMBERS)], "digest": top})


def reduced(nodes: DataFrame) -> list[DataFrame]:
    """Members of all rounds, written: ``nodes`` first, at last one node per tree."""
    rounds = [nodes.select("tree", "place", "members", "digest")]
    while (rounds[-1].agg(F.max("members")).first()[0] or 0) > 1:
        blocks = rounds[-1].groupBy("tree", _block())
        rounds.append(materialize(blocks.applyInPandas(_tops, _NODE)))
    return rounds


def _whole_proofs(members: pd.DataFrame, above: pd.Series) -> tuple[list, list]:
    """Siblings of each member: inside its superblock, then on from the top."""
    levels = raised(members["digest"].tolist(), levels_of(int(members["members"].iloc[0])))
    inner = [siblings(levels, number) for number in range(len(members))]
    return ([[*left, *above["lefts"]] for left, _ in inner],
            [[*right, *above["rights"]] for _, right in inner])


def _paths(members: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    members, above = members.sort_values("place"), outer.iloc[0]
    lefts, rights = _whole_proofs(members, above)
    return pd.DataFrame({
        "tree": members["tree"].array, "place": members["place"].array,
        "digest": members["digest"].array, "lefts": lefts, "rights": rights,
        "subroot": above["subroot"], "root": above["root"]})


def exchange(
    members: DataFrame,
    outer: DataFrame,
    finish: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """``finish`` of the members of each superblock and the path of its top.

    In ``outer`` the ``place`` of a top is the number of its superblock.
    """
    tops = outer.groupBy("tree", F.col("place").alias("block"))
    return members.groupBy("tree", _block()).cogroup(tops).applyInPandas(finish, schema)


def paths(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """Ways from the members of the first round, given those of the last, ``top``."""
    return reduce(lambda outer, members: exchange(members, outer, _paths, _PATH),
                  reversed(rounds[:-1]), top)


# manifest ----------------------------------------------------------------------------------


def _proved(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Proofs of a superblock's leaves, and what the claimed leaves fold to."""
    leaves, above = leaves.sort_values("place"), outer.iloc[0]
    lefts, rights = _whole_proofs(leaves, above)
    proofs = [[a + b for a, b in zip(*both, strict=True)]
              for both in zip(lefts, rights, strict=True)]
    roots = np.array([folded(claim, left, right) for claim, left, right
                      in zip(leaves["claimed"], lefts, rights, strict=True)], dtype=object)
    return pd.DataFrame({
        "id": leaves["id"].array, "leaf": leaves["digest"].array, "subroot": above["subroot"],
        "root": above["root"], "proof": proofs,
        "proof_sha256": [digest_of("".join(proof)) for proof in proofs],
        "folded_root": roots, "verified": roots == above["root"]})


def _placed_leaves(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with their tree, place and its number of members, and the trees."""
    # false sorts before true: null first
    leaves = leaves.withColumns({
        "has_group": F.col("group").isNotNull(),
        "group": F.coalesce(F.col("group").cast("string"), F.lit("")),
        "has_id": F.col("id").isNotNull()})
    group = ["has_group", "group"]
    ordered = materialize(assign_ids(
        leaves, "position", [*group, "has_id", "id", "digest", "row"]))
    trees = ordered.groupBy(*group).agg(
        F.min("position").alias("first"), F.count(F.lit(1)).alias("members"))
    trees = materialize(assign_ids(trees, "tree", ["first"]))
    placed = lookup_join(ordered, trees, group, how="inner", spread=["position"])
    return materialize(placed.select(
        F.col("id").cast("string").alias("id"), "tree",
        (F.col("position") - F.col("first")).alias("place"), "members", "digest",
        F.coalesce("claimed", "digest").alias("claimed"))), trees


def manifest(
    df: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    claimed: Column | None = None,
    with_proofs: bool = False,
) -> DataFrame:
    """Per row: ``id_col``, ``leaf``, ``subroot`` of its group, ``root``, ``proof_sha256``,
    ``folded_root`` and ``verified``; ``with_proofs`` adds ``proof``, the siblings' digests put
    together per level, from below.

    A leaf is the digest of the ``fields`` in order, null ones too. The leaves of a group ascend
    by id, null first, then by leaf: rows that repeat have a leaf each. The groups ascend by
    their bytes, null first. ``claimed`` is a digest that a row says is its leaf (null: the leaf
    itself); it is folded with the siblings of the true leaf, and verified if that gives the
    root. A text of any length is one digest. An empty table gives no rows. Columns beside the
    named ones do not matter.
    """
    ids = df.schema[id_col].dataType
    leaf = leaf_digest([F.col(f"`{name}`") for name in fields])
    # written before they are placed: equal leaves need a number that stays
    leaves = materialize(df.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").alias("group"),
        leaf.alias("digest"), (F.lit(None) if claimed is None else claimed).cast("string")
        .alias("claimed"), F.monotonically_increasing_id().alias("row")))
    placed, trees = _placed_leaves(leaves)

    rounds = reduced(placed)
    # the tops of all groups are the members of one more tree
    count = trees.agg(F.count(F.lit(1))).scalar()
    tops = materialize(rounds[-1].select(
        F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("place"),
        count.alias("members"), "digest"))
    top_rounds = reduced(tops)
    nothing = F.array().cast("array<string>")
    root = top_rounds[-1].select(
        "tree", "place", "digest", nothing.alias("lefts"), nothing.alias("rights"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    group_tops = paths(top_rounds, root).select(
        (F.col("place") + 1).alias("tree"), F.lit(0).cast("long").alias("place"), "digest",
        "lefts", "rights", F.col("digest").alias("subroot"), "root")
    found = exchange(placed, paths(rounds[1:], group_tops), _proved, (
        "id string, leaf string, subroot string, root string, proof array<string>, "
        "proof_sha256 string, folded_root string, verified boolean"))
    shown = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return found.select(F.col("id").cast(ids).alias(id_col), *shown,
                        *(["proof"] if with_proofs else []))
