"""The manifest against a plain tree over all leaves."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from skyledger.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return sha("".join(parts))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 8])) for i in range(0, len(below), 8)])
    return levels


def way(levels, place):
    out = []
    for nodes in levels[:-1]:
        run = place // 8 * 8
        out.append(("".join(nodes[run:place]), "".join(nodes[place + 1:run + 8])))
        place //= 8
    return out


def changed(row):
    key = row["doc_id"]
    return key is not None and row["text"] is not None and zlib.crc32(str(key).encode()) % 3 == 0


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row, leaf_of(row, row["text"])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
    trees = {g: tree([leaf for _, leaf in groups[g]]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for number, g in enumerate(order):
        for place, (row, leaf) in enumerate(groups[g]):
            steps = way(trees[g], place) + way(top, number)
            end = leaf_of(row, lowered(row["text"])) if changed(row) else leaf
            for left, right in steps:
                end = sha(left + end + right)
            out.append((row["doc_id"], leaf, trees[g][-1][0], top[-1][0],
                        sha("".join(a + b for a, b in steps)), end, end == top[-1][0]))
    return sorted(out, key=repr)


def run(df):
    claimed = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
        merkle.leaf_digest([
            F.translate("text", merkle_upper(), merkle_upper().lower()) if n == "text"
            else F.col(n) for n in FIELDS]))
    return merkle.manifest(df, "doc_id", "lang", FIELDS, claimed)


def merkle_upper():
    return "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = sorted((tuple(r) for r in run(df).collect()), key=repr)
    assert found == plain([dict(zip(df.columns, r, strict=True)) for r in rows])


def docs(n, lang, first=0):
    return [(first + i, f"Text {i} ÄB", lang, "web", i) for i in range(n)]


def test_one_superblock(spark):
    check(spark, docs(70, "en") + docs(8, "de", 100) + docs(1, "fr", 200) + docs(9, None, 300))


def test_several_superblocks(spark, monkeypatch):
    """Superblocks of 8 ** 2: four rounds up and down, beside groups that end sooner."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "MEMBERS", 64)
    check(spark, docs(4200, "en") + docs(64, "de", 5000) + docs(65, "fr", 6000)
          + docs(1, "ü", 7000))


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "MEMBERS", 8)
    check(spark, [(i, "X", f"l{i}", None, None) for i in range(100)])


def test_edges(spark):
    rows = [
        (None, "A", "en", None, None), (None, None, None, None, None), (None, "A", "en", None, None),
        (3, None, "en", "s", 0), (3, "", "en", "s", 0), (3, "", "en", "s", 0),
        (12, "UPPER", "", "s", 1), (-5, "Long " * 50_000, "en", "s", 2),
    ]
    check(spark, rows)
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []


def test_single_leaf(spark):
    [row] = run(spark.createDataFrame(docs(1, "en", 1), SCHEMA)).collect()
    assert row["leaf"] == row["subroot"] == row["root"]
    assert row["proof_sha256"] == sha("")


def test_proofs_and_clashing_columns(spark):
    df = spark.createDataFrame(docs(20, "en"), SCHEMA)
    clash = df.select(F.col("doc_id").alias("i.d"), F.col("lang").alias("tree"),
                      F.col("text").alias("digest"), F.lit(1).alias("root"),
                      F.lit("x").alias("leaf"))
    found = merkle.manifest(clash, "i.d", "tree", ["i.d", "digest"], with_proofs=True).collect()
    assert all(r["verified"] and sha("".join(r["proof"])) == r["proof_sha256"] for r in found)
    assert sorted(r["i.d"] for r in found) == list(range(20))


@pytest.mark.parametrize("members,levels", [(1, 0), (2, 1), (8, 1), (9, 2), (4096, 4), (4097, 4)])
def test_levels(members, levels):
    assert merkle.levels_of(members) == levels
