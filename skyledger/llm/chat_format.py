"""Conversations as formatted texts with a loss mask, by expressions over collected turns.

The turns of a conversation are collected as structs and sorted, neighbours of one role become a
block, and the blocks' pieces are concatenated:

    <|im_start|>role LF text <|turn|> text <|im_end|> LF

``<|turn|>`` stands between the turns of a block only, so the turns come back as they were. Inside
texts and roles a backslash goes between ``<`` and ``|`` (one more where some are there), so no
text holds a control string and reading back takes the backslash out; a line feed in a role is
``<|lf|>``.

The mask is a list of spans: ``start`` and ``length`` in UTF-8 bytes of the formatted text, one
per turn of the learned role, also an empty one.

Rows are ordered by turn, null turns last, then by role and text: ties and repeated rows stay and
have one order. Null texts and roles are empty. A row without a conversation is one by itself. An
empty table gives no rows. Columns beside the four named ones do not matter. A conversation is
one value of the result, so it must fit a row (2 GB in Spark); a long one is formatted in linear
time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.columns import let

START, END, TURN, LINE = "<|im_start|>", "<|im_end|>\n", "<|turn|>", "<|lf|>"
# Sums run over this many pieces at a time: an accumulated array is copied at each step.
RUN = 512


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(LINE))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(LINE), F.lit("\n")))


def merged_blocks(turns: Column) -> Column:
    """``role`` and ``texts`` of each run of neighbours with one role; linear in the turns."""

    def at(t: Column, i: Column) -> Column:
        return F.get(t, i)["role"]

    def blocks(t: Column, begins: Column) -> Column:
        def block(begin: Column, number: Column) -> Column:
            end = F.coalesce(F.get(begins, number + 1), F.size(t))
            texts = F.transform(F.slice(t, begin + 1, end - begin), lambda turn: turn["text"])
            return F.struct(at(t, begin).alias("role"), texts.alias("texts"))

        return F.transform(begins, block)

    def begins(t: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(t) - 1),
            lambda i: (i == 0) | (at(t, i) != at(t, i - 1)))

    return let(turns, lambda t: let(begins(t), lambda b: blocks(t, b)))


def _piece(text: Column, learned: Column) -> Column:
    return F.struct(text.alias("text"), learned.alias("learned"))


def _pieces(blocks: Column, learn: str) -> Column:
    """The strings that make up the formatted text, and which of them are learned."""
    control = F.lit(False)

    def block(b: Column) -> Column:
        head = _piece(F.concat(F.lit(START), b["role"], F.lit("\n")), control)
        texts = F.transform(b["texts"], lambda text, i: F.when(
            i == 0, F.array(_piece(text, b["role"] == learn))).otherwise(
            F.array(_piece(F.lit(TURN), control), _piece(text, b["role"] == learn))))
        return F.concat(F.array(head), F.flatten(texts), F.array(_piece(F.lit(END), control)))

    return F.flatten(F.transform(blocks, block))


def _starts(lengths: Column) -> Column:
    """Sum of the lengths before each one; the array is not empty."""

    def sums(values: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("sum"),
                        F.array().cast("array<bigint>").alias("before"))
        return F.aggregate(values, zero, lambda acc, value: F.struct(
            (acc["sum"] + value).alias("sum"),
            F.concat(acc["before"], F.array(acc["sum"])).alias("before")))

    def joined(runs: Column) -> Column:
        whole = sums(F.transform(runs, lambda run: run["sum"]))["before"]
        return let(whole, lambda base: F.flatten(F.transform(
            runs, lambda run, k: F.transform(run["before"], lambda s: s + F.get(base, k)))))

    def runs(values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int"))
        return F.transform(numbers, lambda k: sums(F.slice(values, k * RUN + 1, F.lit(RUN))))

    return let(lengths, lambda values: let(runs(values), joined))


def _spans(pieces: Column) -> Column:
    def spans(p: Column, starts: Column) -> Column:
        placed = F.transform(p, lambda piece, i: F.struct(
            F.get(starts, i).alias("start"), F.octet_length(piece["text"]).alias("length"),
            piece["learned"].alias("learned")))
        return F.transform(F.filter(placed, lambda s: s["learned"]), lambda s: F.struct(
            s["start"].alias("start"), s["length"].alias("length")))

    return let(pieces, lambda p: let(
        _starts(F.transform(p, lambda piece: F.octet_length(piece["text"]).cast("long"))),
        lambda starts: spans(p, starts)))


def format_chats(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """Per conversation: ``conv_id``, ``formatted`` and ``loss_spans`` of the role ``learn``."""
    conv, turn, role, text = (F.col(f"`{c}`") for c in (conv_col, turn_col, role_col, text_col))
    empty = F.lit("")
    rows = df.select(conv.alias("conv_id"), F.struct(
        turn.isNull().alias("late"), turn.alias("turn"),
        _escaped_role(F.coalesce(role, empty)).alias("role"),
        escaped(F.coalesce(text, empty)).alias("text")).alias("row"))
    grouped = rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("row")).alias("turns"))
    alone = rows.where(F.col("conv_id").isNull()).select(
        "conv_id", F.array("row").alias("turns"))
    pieces = _pieces(merged_blocks(F.col("turns")), learn)
    formatted = let(pieces, lambda p: F.struct(
        F.array_join(F.transform(p, lambda piece: piece["text"]), "").alias("formatted"),
        _spans(p).alias("loss_spans")))
    return grouped.unionByName(alone).select("conv_id", formatted.alias("_out")).select(
        "conv_id", "_out.formatted", "_out.loss_spans")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of ``role`` and ``text``."""

    def turns(block: Column) -> Column:
        body = F.substr(block, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substr(body, F.char_length(role) + 2), rf"\Q{TURN}\E")
        return F.transform(texts, lambda text: F.struct(
            _unescaped_role(role).alias("role"), unescaped(text).alias("text")))

    # what follows the last end mark is empty
    blocks = F.split(formatted, rf"\Q{END}\E")
    return F.flatten(F.transform(
        let(blocks, lambda b: F.slice(b, F.lit(1), F.size(b) - 1)), turns))


def learned_text(formatted: Column, spans: Column) -> Column:
    """What lies under the mask, unescaped and put together."""
    return let(formatted.cast("binary"), lambda body: F.array_join(F.transform(
        spans, lambda s: unescaped(
            F.substr(body, (s["start"] + 1).cast("int"), s["length"]).cast("string"))), ""))


def digests(chats: DataFrame) -> DataFrame:
    """Digests of turns and learned text, both read back from the formatted conversations."""
    read = chats.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
        learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    line = F.lit("\n")
    said = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
