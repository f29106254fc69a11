"""A training corpus from ``documents``: good documents, without lines that many share, one of
each near-duplicate group, mixed to source weights, packed into sequences."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import cutting_stock, line_dedup, mixing, ngram_join, pairwise_quality
from skyledger.llm.columns import ready, table
from skyledger.session import materialize, scratch_tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Intermediate tables of the stage that ran last.
_LEFT: list[str] = []


def stage(function: Stage) -> Stage:
    """A stage's result is written before the next stage begins: that one drops what it needed."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with scratch_tables(spark, _LEFT, docs):
            return function(spark, docs, sf_dir)

    return run_stage


def _documents(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``operator`` makes of ``docs``, with the columns of ``docs``.

    Columns that no stage reads go through it as one, so none can clash with a result's name.
    A count of characters follows the text.
    """
    beside = [c for c in docs.columns if c not in ("doc_id", "text", "source")]
    out = operator(docs.select("doc_id", "text", "source",
                               F.struct(*[F.col(f"`{c}`") for c in beside]).alias("beside")))
    return out.select(*[
        F.char_length("text").cast("long").alias(c) if c == "n_chars"
        else F.col(f"beside.`{c}`" if c in beside else c).alias(c)
        for c in docs.columns
    ])


@stage
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, predicts to be good.

    A null text is scored as an empty one; rows alike in text are all kept or all rejected;
    without labels of both kinds all are kept; an empty table gives an empty table.
    """
    return pairwise_quality.keep_good(docs, table(spark, sf_dir, "labels"))


@stage
def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of five documents or more, but for the last document's.

    A null text becomes an empty one. Rows count as documents, those that repeat an id or have
    none included; rows that repeat the largest id all keep the line. No row goes, also if no
    line of it stays; an empty table gives an empty table.
    """
    ready(spark)
    return _documents(docs, line_dedup.dedup_lines)


@stage
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near duplicates, of the smallest id; ids may repeat.

    Rows are alike by their texts, so of rows that repeat one stays, whatever their ids; a null
    id is chosen only where the group has no other. Texts without words are alike to none and
    all stay. An empty table gives an empty table.
    """
    ready(spark)
    return ngram_join.one_of_each(docs)


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time that the mix takes a document, by shard and shuffled place.

    A document without words is never taken; those with a null source are of one source; rows
    alike in id and text are taken one by one. An empty table gives an empty table.
    """
    return _documents(docs, lambda slim: mixing.mixed_documents(mixing.mix(slim)))


@stage
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of 1024 tokens.

    Every row is a document of its own, also if its id repeats or is null. A null or empty text
    is the token that ends it. An empty table gives no pieces.
    """
    ready(spark)
    return cutting_stock.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("lines", own_lines),
    ("near_duplicates", one_of_each),
    ("mix", source_mix),
    ("pack", sequences),
]

# The classifier and the similarity join have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes its result before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = materialize(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
