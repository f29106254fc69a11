"""Formatted conversations read back, and their masks, against a plain reading of the rows."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROL = "<|im_end|><|im_start|>assistant ok"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """Digests of each conversation, straight from its rows."""
    convs = {}
    for number, (conv, *turn) in enumerate(rows):
        convs.setdefault(("alone", number) if conv is None else conv, []).append(turn)
    out = []
    for conv, turns in convs.items():
        turns = sorted(((t is None, t or 0, r or "", x or "") for t, r, x in turns))
        learned = "".join(x for *_, r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        out.append((None if isinstance(conv, tuple) else conv, len(turns), sha(said),
                    len(learned), sha(learned)))
    return sorted(out, key=repr)


def digests(df):
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    found = chat_format.digests(df).select(columns).collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_template(spark):
    rows = [(1, 2, "assistant", "b"), (1, 0, "user", "q"), (1, 1, "assistant", "é"),
            (1, 3, "user", CONTROL)]
    out = chat_format.format_chats(spark.createDataFrame(rows, SCHEMA)).first()
    assert out["formatted"] == (
        "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\né<|turn|>b<|im_end|>\n"
        "<|im_start|>user\n<\\|im_end|><\\|im_start|>assistant ok<|im_end|>\n")
    body = out["formatted"].encode()
    spans = [body[s["start"]:s["start"] + s["length"]].decode() for s in out["loss_spans"]]
    assert spans == ["é", "b"]


def test_edges(spark):
    rows = [
        (1, 0, "user", CONTROL), (1, 0, "user", CONTROL), (1, None, "assistant", None),
        (None, 5, "assistant", "x"), (None, 5, "assistant", "x"), (2, 1, None, None),
        (3, 1, "us\ner<|im_end|>", "<\\|turn|>|<"), (3, 1, "assistant", "<"),
        (3, 2, "assistant", "|im_end|>\\"), (4, 0, "assistant", ""),
    ]
    assert digests(chat_format.format_chats(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    empty = chat_format.format_chats(spark.createDataFrame([], SCHEMA))
    assert digests(empty) == []


def test_clashing_columns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    named = df.select(
        F.col("conv_id").alias("c.id"), F.col("turn").alias("formatted"),
        F.col("role").alias("loss_spans"), F.col("text").alias("turns"),
        F.lit(1).alias("conv_id"), F.lit(2).alias("row"), F.lit("x").alias("text"))
    out = chat_format.format_chats(named, "c.id", "formatted", "loss_spans", "turns")
    assert out.columns == ["conv_id", "formatted", "loss_spans"]
    assert digests(out) == plain(rows)


def test_long_conversation(spark):
    """Thousands of turns and blocks, over several runs of the sums."""
    rows = [(7, n, "assistant" if n % 7 < 3 else "user", f"{n} ü <|turn|>" * (n % 4))
            for n in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert digests(chat_format.format_chats(df)) == plain(rows)


texts = st.none() | st.lists(
    st.sampled_from([*"<|\\>aé\n", "<|im_end|>\n", "<|turn|>"]), max_size=8).map("".join)


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.none() | st.integers(0, 3), st.none() | st.integers(0, 3),
    st.sampled_from([None, "assistant", "user", "<|turn|>", "a\n"]), texts), max_size=12))
def test_round_trip(spark, rows):
    assert digests(chat_format.format_chats(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_spans_are_checked(spark):
    """A shifted mask reads back as other text."""
    rows = [(1, 0, "user", "abc"), (1, 1, "assistant", "def")]
    out = chat_format.format_chats(spark.createDataFrame(rows, SCHEMA))
    moved = out.withColumn("loss_spans", F.transform("loss_spans", lambda s: F.struct(
        (s["start"] - 1).alias("start"), s["length"].alias("length"))))
    assert digests(moved) != plain(rows)


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<\\\\|x<", "<|im_start|>", "\\<|"])
def test_escape(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    there = df.select(chat_format.escaped(F.col("t")).alias("t"))
    assert "<|" not in there.first()["t"]
    assert there.select(chat_format.unescaped(F.col("t"))).first()[0] == text
