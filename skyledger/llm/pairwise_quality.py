"""Quality classifier: a Bradley-Terry model of preferences between documents.

Every document has a worth, a sum over binned measures of its text. A good document is preferred
to a bad one with the probability of the logistic function of the difference of their worths;
the weights are learned from such pairs. The threshold on the worth is a quantile of it.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.session import materialize

# Bounds of what is learned from: labelled documents of each class, and preference pairs.
SAMPLE = 10_000
PAIRS = 40_000
BINS = 10
THRESHOLD = 0.3

MEASURES = [
    "log_words", "word_length", "distinct_share", "top_share", "repeated_share", "stutter",
    "upper_share", "symbols", "marks", "digits", "full_stops", "commas", "line_words",
    "duplicate_lines", "wide_share", "longest_word",
]


def measure(text: str | None) -> list[float]:
    """Measures of the whole text, in the order of MEASURES; all 0 without words."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(MEASURES)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    windows = max(1, n - 2)
    chars = sum(map(len, counts)) if n == len(counts) else sum(
        len(word) * times for word, times in counts.items())
    return [
        float(np.log1p(n)),
        chars / n,
        len(counts) / n,
        max(counts.values()) / n,
        1 - len(set(zip(words, words[1:], words[2:], strict=False))) / windows if n > 2 else 0.0,
        sum(map(eq, words, words[1:])) / n,
        sum(times for word, times in counts.items() if word.isupper() and len(word) > 1) / n,
        sum(map(text.count, "#*$%&|<>@~^=")) / n,
        (text.count("!") + text.count("?")) / n,
        sum(times for word, times in counts.items() if word[:1].isdigit()) / n,
        text.count(".") / n,
        text.count(",") / n,
        n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        (len(text.encode("utf-8", "surrogatepass")) - len(text)) / max(1, chars),
        float(max(map(len, counts))),
    ]


@F.pandas_udf(T.StructType([T.StructField(name, T.DoubleType()) for name in MEASURES]))
def measured_text(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        np.array([measure(text) for text in texts]).reshape(len(texts), -1), columns=MEASURES)


def measures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and the measures of every row; one narrow pass over the texts."""
    return df.select(F.col(id_col).alias("doc_id"), measured_text(text_col).alias("m")).select(
        "doc_id", "m.*")


def held_out(doc_id: Column) -> Column:
    """Rows never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def known_rows(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """The measures of all labelled rows that are not held out, with their ``quality``; written."""
    known = labels.select("doc_id", "quality").where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return materialize(measured.join(known, "doc_id"))


def sampled(rows: DataFrame, count: dict[int, int], sample: int) -> pd.DataFrame:
    """About ``sample`` rows of either class at most, by a hash of the id."""
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(3), "doc_id"), 11) / F.lit(float(2**53))
    chance = F.lit(0.0)
    for label, n in count.items():
        chance = F.when(F.col("quality") == label, min(1.0, sample / n)).otherwise(chance)
    return rows.where(unit < chance).orderBy("doc_id").toPandas()


# Bins of a round of the search for a rank, and values that are looked at one by one.
RANK_BINS = 1000
RANK_VALUES = 10_000


def value_at(rows: DataFrame, value: Column, rank: int) -> float:
    """The value of rank ``rank``, from 0, among all rows, exactly.

    Rounds of counts per bin of a narrowing range; at last the few values of a bin are sorted.
    """
    values = rows.select(value.alias("v"))
    low, high = values.agg(F.min("v"), F.max("v")).first()
    inside = F.lit(True)
    while low < high:
        width = (high - low) / RANK_BINS
        at = F.least(F.floor((F.col("v") - low) / width), F.lit(RANK_BINS - 1)).alias("bin")
        bins = values.where(inside).groupBy(at).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        ).orderBy("bin").collect()
        for found in bins:
            if rank < found["n"]:
                break
            rank -= found["n"]
        inside = (F.col("v") >= found["low"]) & (F.col("v") <= found["high"])
        low, high = found["low"], found["high"]
        if found["n"] <= RANK_VALUES:
            return sorted(r[0] for r in values.where(inside).collect())[rank]
    return low


def _bins(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """One column per bin edge, 1 where the measure is over it; few edges per measure."""
    return np.concatenate(
        [(values[:, [k]] > own[None, :]) for k, own in enumerate(edges)], axis=1
    ).astype(np.float64)


def learn(rows: pd.DataFrame, pairs: int, bins: int) -> dict:
    """Edges and weights from a bounded sample.

    The loss is the logistic loss of the differences in features of (good, bad) pairs, with a
    ridge, by Newton's method. Without both labels all documents score alike and are kept.
    """
    values = rows[MEASURES].to_numpy(np.float64)
    good = np.flatnonzero(rows["quality"].to_numpy() == 1)
    bad = np.flatnonzero(rows["quality"].to_numpy() == 0)
    if not len(good) or not len(bad):
        return {"edges": [np.empty(0)] * len(MEASURES), "weights": np.empty(0)}
    # quantiles of both classes by themselves: a rare kind of bad document gets edges too
    at = np.linspace(0, 1, bins + 1)[1:-1]
    edges = [
        np.unique(np.concatenate([np.quantile(values[own, k], at) for own in (good, bad)]))
        for k in range(values.shape[1])
    ]
    x = _bins(values, edges)
    rng = np.random.default_rng(5)
    diff = x[rng.choice(good, pairs)] - x[rng.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    ridge = 1e-3 * pairs
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        grad = diff.T @ (1 - p) - ridge * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff + ridge * np.eye(len(w))
        w += np.linalg.solve(curve, grad)
    return {"edges": edges, "weights": w}


def cut_of(rows: DataFrame, model: dict, count: dict[int, int]) -> float:
    """Between the worths of the last bad and the first good of all labelled rows, if they were
    ranked by worth: the quantile at the share of bad ones. -2 without labels of both classes."""
    bad, good = count.get(0, 0), count.get(1, 0)
    if not bad or not good:
        return -2.0
    # written: the worth is a long expression, to be compiled once and not for each count
    worths = materialize(rows.select(worth(model).alias("w")))
    return (value_at(worths, F.col("w"), bad - 1) + value_at(worths, F.col("w"), bad)) / 2


def worth(model: dict) -> Column:
    total, k = F.lit(0.0), 0
    for name, edges in zip(MEASURES, model["edges"], strict=True):
        for edge in edges:
            total = total + F.when(F.col(name) > float(edge), float(model["weights"][k])).otherwise(0.0)
            k += 1
    return total


def score_quality(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    pairs: int = PAIRS,
    bins: int = BINS,
) -> DataFrame:
    """Quality of every document, learned from the rows of ``labels`` that are not held out.

    Returns doc_id, held_out, score and predicted. The score is the logistic function of the
    worth, shifted so that the quantile of the worth at the share of bad ones, among all
    labelled documents that are not held out, has the score ``threshold``; predicted is 1 from
    there on. The weights are learned from about ``sample`` labelled documents of either class
    and ``pairs`` pairs at most; every document is scored.

    Null and empty texts have all measures 0 and a score like any other. A null id is not held
    out and has no label; repeated rows are scored one by one; of several labels of an id the
    lowest counts. Without labels of both classes every document scores alike and is kept.
    """
    measured, score = _fitted(df, labels, id_col, text_col, threshold, sample, pairs, bins)
    return measured.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _fitted(df, labels, id_col, text_col, threshold, sample, pairs, bins):
    """The measures of all rows, written, and the score over their columns."""
    measured = materialize(measures(df, id_col, text_col))
    rows = known_rows(measured, labels)
    count = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    model = learn(sampled(rows, count, sample), pairs, bins)
    shift = float(np.log(threshold / (1 - threshold)) - cut_of(rows, model, count))
    return measured, 1 / (1 + F.exp(-(worth(model) + shift)))


def keep_good(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    pairs: int = PAIRS,
    bins: int = BINS,
) -> DataFrame:
    """The rows of ``df`` that ``score_quality`` predicts to be good, with their columns.

    The texts are measured a second time, which takes no shuffle, instead of joined with their
    scores; so rows with equal or null ids are decided one by one.
    """
    _, score = _fitted(df, labels, id_col, text_col, threshold, sample, pairs, bins)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    measured = df.select(row, measured_text(text_col).alias("m")).select("row", "m.*")
    return measured.where(score >= threshold).select("row.*")
