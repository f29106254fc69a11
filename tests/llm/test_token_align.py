"""Aligned tokenisations and pair counts against a plain reading of the tokenizers' output."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skyledger.llm import token_align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


class Plain:
    """Both sides by the libraries' own calls, without the operator's tables."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i)))
             for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                      else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if any(b"".join(t for _, t in side) != whole for side in (a, b)):
            return [], []
        return a, b

    def results(self, texts):
        docs, corpus = [], Counter()
        for text in texts:
            a, b = self.tokens(text)
            ends = [np.cumsum([len(t) for _, t in side]).tolist() for side in (a, b)]
            common = sorted(set(ends[0]) & set(ends[1]))
            links, groups, at = [], [], [0, 0]
            for end in common:
                to = [ends[0].index(end, at[0]) + 1, ends[1].index(end, at[1]) + 1]
                ids = [[str(i) for i, _ in side[f:t]]
                       for side, f, t in zip((a, b), at, to, strict=True)]
                groups.append(",".join(ids[0]) + "|" + ",".join(ids[1]))
                links.append((int(ids[0][-1]), int(ids[1][-1])))
                at = to
            corpus.update(links)
            docs.append((len(a), len(b), links, ";".join(groups)))
        highest = Counter()
        for (_, b), n in corpus.items():
            highest[b] = max(highest[b], n)
        return [(n_a, n_b, len(links), len(links),
                 sum(corpus[p] == highest[p[1]] for p in links), sum(corpus[p] for p in links),
                 hashlib.sha256(groups.encode()).hexdigest() if n_a else "")
                for n_a, n_b, links, groups in docs]


@pytest.fixture(scope="module")
def plain():
    return Plain()


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "a", "<|endoftext|> and <s> </s> <unk> <0x0A>", "tab\tand\r\nlines\n\n",
    "snow ▁ man", "ﬁ ligature   nbsp", "日本語 and emoji 🙂🙂", "  two  spaces  ",
    "\u0000 nul ​", "é combining", "x" * 3000, "don't we'll I'm", "1234567890 12.5%",
]


def check(spark, plain, texts, **options):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS)
             for r in token_align.align_tokens(df, A, B, **options).collect()}
    assert found == dict(enumerate(plain.results(texts)))


def test_odd_texts(spark, plain):
    check(spark, plain, ODD + ODD + ["a", "a b", "a b a b"])


def test_many_blocks_and_chunks(spark, plain, monkeypatch):
    """Several blocks a task, and several chunks a part, whose counts are added up."""
    seed = random.Random(5)
    words = "the of and to market Straße été ¿qué? don't 42 ,".split()
    texts = [" ".join(seed.choices(words, k=seed.randint(1, 60))) for _ in range(200)]
    monkeypatch.setattr(token_align, "BLOCK_RECORDS", 300)
    check(spark, plain, texts + ODD, parts=4, chunk_bytes=400)


def test_long_text_is_cut(spark, plain, monkeypatch):
    seed = random.Random(6)
    text = "".join(seed.choices(["word ", "Another ", "x, ", "é ", "\n", "don't ", "  "], k=4000))
    sides = token_align.byte_bpe_side(A), token_align.sentence_piece_side(B)
    assert all(side.cuts for side in sides)
    assert len(list(token_align.cut(text, 50))) > 50
    for pieces in (list(token_align.cut(text, 50)), [text]):
        ids = [[i for piece in pieces for i in side.encode([piece])[0]] for side in sides]
        assert ids == [[i for i, _ in side] for side in plain.tokens(text)]
    monkeypatch.setattr(token_align, "LONG_TEXT", 50)
    monkeypatch.setattr(token_align.aligned_pieces, "__defaults__", (50,))
    check(spark, plain, [text, text[:700], "snow ▁ man " + text, *ODD])


def test_edges(spark, plain):
    empty = token_align.align_tokens(spark.createDataFrame([], SCHEMA), A, B)
    assert empty.collect() == []
    rows = [(None, "a b"), (None, "a b"), (7, "a b"), (7, "b"), (7, None)]
    found = token_align.align_tokens(spark.createDataFrame(rows, SCHEMA), A, B)
    expected = [(i, *r) for (i, _), r in zip(
        rows, plain.results([t for _, t in rows]), strict=True)]
    assert sorted(map(repr, map(tuple, found.select("doc_id", *COLUMNS).collect()))) == sorted(
        map(repr, expected))
    nothing = token_align.align_tokens(spark.createDataFrame([(1, None)], SCHEMA), A, B)
    assert tuple(nothing.select(COLUMNS).first()) == (0, 0, 0, 0, 0, 0, "")


def test_groups_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "Hi there")], SCHEMA).select(
        F.col("doc_id").cast("int").alias("a.id"), F.col("text").alias("run"),
        F.lit(1).alias("block"), F.lit("x").alias("text"), F.lit(2).alias("part"))
    [row] = token_align.align_tokens(df, A, B, "a.id", "run", with_groups=True).collect()
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"]
    assert row["a.id"] == 1 and row["groups"].count("|") == row["n_groups"]


def test_query_on_the_table(spark, plain):
    import os

    from compare import ROOT

    from skyledger.llm import queries
    folder = f"{ROOT}/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no tables")
    texts = queries.table(spark, folder, "documents").collect()
    expected = dict(zip([r["doc_id"] for r in texts],
                        plain.results([r["text"] for r in texts]), strict=True))
    found = queries.token_alignment(spark, folder).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found} == expected


@pytest.mark.parametrize("arrays", [
    [[]], [[0]], [[1, 255, 256]], [[2 ** 40, 3], [], [7]]])
def test_packed(arrays):
    packed = token_align.packed(*[np.array(a, dtype=np.int64) for a in arrays])
    assert [a.tolist() for a in token_align.unpacked(packed)] == arrays
