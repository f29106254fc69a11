"""Quality rules as weak supervision: rules vote or abstain, EM weighs them.

A rule says good (1), bad (-1) or nothing (0) about a document. Bad documents are bad in
different ways, so the hidden class of a document is good or one way of being bad per rule.
Expectation-maximisation over the counts of vote patterns estimates the share of each class and
each rule's rate of bad votes in it: how accurate the rule is there. Quality is the posterior
probability of good given the votes; no label is used. Only DataFrame functions: the counters
are computed inside each row, the patterns number at most 3 ** rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.columns import BLANKS, count_chars, let, words
from skyledger.session import materialize

SYMBOLS = "#*$%&|<>"

# Name of the measure, then the bounds of a good vote and of a bad vote on it.
# (measure, good below or equal, bad above); a measure between them abstains.
RULES = {
    "symbols_per_word": (0.02, 0.20),
    "repeated_share": (0.20, 0.45),
    "duplicate_lines": (0.05, 0.60),
    "capitals_share": (0.10, 0.30),
    "marks_per_word": (0.03, 0.20),
    "word_length_off": (2.5, 5.0),
    "same_words": (0.60, 0.85),
}
ROUNDS = 15
KEEP_AT = 0.5


def _repeated(grams: Column) -> Column:
    """Words in windows of three that are found twice, from (hash, position) of each window."""
    first, at = (lambda i: F.get("grams", i)["h"]), (lambda g: g["p"])
    twice = F.filter("grams", lambda g, i: (g["h"] == first(i - 1)) | (g["h"] == first(i + 1)))
    places = F.sort_array(F.transform(twice, at))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        places, zero,
        lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(acc["end"], p)).alias("n"),
                                (p + 3).alias("end")),
        lambda acc: acc["n"].cast("long"),
    )


# Words among which the distinct ones are counted: a share of them falls with the length.
DISTINCT_IN = 2000


def _distinct(words: Column) -> Column:
    """Distinct words of each run of ``DISTINCT_IN`` words, added up over the whole text."""
    begins = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / DISTINCT_IN).cast("int"))
    counts = F.transform(begins, lambda k: F.size(F.array_distinct(
        F.slice(words, k * DISTINCT_IN + 1, F.lit(DISTINCT_IN)))))
    return F.when(F.size(words) > 0, F.aggregate(
        counts, F.lit(0), lambda total, n: total + n)).otherwise(0).cast("long")


def counters(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document: the counts that the rules look at. Windows of words are compared by their
    64-bit hashes, sorted inside the row: n log n, no shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
        "doc_id", "text", words(F.col("text")).alias("words"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.char_length(F.btrim(x, F.lit(BLANKS))) > 0)
    n = F.size("words")
    window = lambda i: F.xxhash64(
        F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    grams = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.struct(window(i).alias("h"), i.alias("p"))))
    counted = rows.select(
        "doc_id", n.cast("long").alias("n_words"),
        F.char_length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        count_chars(text, SYMBOLS).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.sort_array(F.coalesce(grams, F.array().cast("array<struct<h:bigint,p:int>>")))
        .alias("grams"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, r"\p{Lu}+", "")))
        .cast("long").alias("n_capitals"),
        count_chars(text, "!?").cast("long").alias("n_marks"),
        _distinct(F.col("words")).alias("n_distinct"),
    )
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("grams")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), "n_capitals", "n_marks", "n_distinct",
    )


def measures() -> dict[str, Column]:
    """What the rules measure; null where a document has no words, which makes a rule abstain."""
    n = F.when(F.col("n_words") > 0, F.col("n_words"))
    chars = F.when(F.col("word_chars") > 0, F.col("word_chars"))
    lines = F.when(F.col("n_lines") > 0, F.col("n_lines"))
    return {
        "symbols_per_word": F.col("n_symbols") / n,
        "repeated_share": F.col("n_repeat_words") / n,
        "duplicate_lines": F.col("n_dup_lines") / lines,
        "capitals_share": F.col("n_capitals") / chars,
        "marks_per_word": F.col("n_marks") / n,
        "word_length_off": F.abs(chars / n - 5.5),
        "same_words": 1 - F.col("n_distinct") / n,
    }


def votes(rules: dict[str, tuple[float, float]] = RULES) -> Column:
    measured = measures()
    return F.array(*[
        F.when(measured[name] <= good, 1).when(measured[name] > bad, -1).otherwise(0)
        for name, (good, bad) in rules.items()
    ])


# A rule that votes at all is wrong about at most this share of good documents, and right about
# at least half of the documents that are bad in its own way.
FALSE_ALARMS = 0.02
OWN_ALARMS = 0.5
# Documents at the first guess that smooth each rate.
SMOOTHING = 20


def first_guess(n_rules: int) -> list[tuple[float, list[float]]]:
    """Per class its share and the rules' rates of bad votes; class 0 is good."""
    bad = [(0.1 / n_rules, [0.9 if j == own else 0.1 for j in range(n_rules)])
           for own in range(n_rules)]
    return [(0.9, [FALSE_ALARMS] * n_rules), *bad]


def _class_weights(params: list[tuple[float, list[float]]]) -> Column:
    """Posterior of every class for the votes ``v``, an array."""

    def joint(share: float, rates: list[float]) -> Column:
        out = F.lit(share)
        for j, rate in enumerate(rates):
            vote = F.col("v")[j]
            out = out * F.when(vote == -1, rate).when(vote == 1, 1 - rate).otherwise(1.0)
        return out

    return let(
        F.array(*[joint(*each) for each in params]),
        lambda w: let(F.aggregate(w, F.lit(0.0), lambda a, x: a + x),
                      lambda z: F.transform(w, lambda x: x / z)),
    )


def fit(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS) -> list:
    """EM over (votes ``v``, ``n`` documents); a row of sums per class comes to the driver."""
    begin = params = first_guess(n_rules)
    for _ in range(rounds):
        shared = patterns.select("v", "n", F.posexplode(_class_weights(params)).alias("c", "w"))
        mass = F.col("n") * F.col("w")
        sums = [F.sum(mass).alias("mass")]
        for j in range(n_rules):
            for name, value in (("good", 1), ("bad", -1)):
                own = F.when(F.col("v")[j] == value, mass).otherwise(0.0)
                sums.append(F.sum(own).alias(f"{name}_{j}"))
        rows = {r["c"]: r for r in shared.groupBy("c").agg(*sums).collect()}
        if not rows:
            return params
        total = sum(r["mass"] for r in rows.values())
        params = []
        for c, (share, guesses) in enumerate(begin):
            rates = []
            for j, guess in enumerate(guesses):
                bad, good = rows[c][f"bad_{j}"], rows[c][f"good_{j}"]
                rate = (bad + SMOOTHING * guess) / (bad + good + SMOOTHING)
                low = OWN_ALARMS if j == c - 1 else 0.0005
                rates.append(min(max(rate, low), FALSE_ALARMS if c == 0 else 0.9995))
            params.append(((rows[c]["mass"] + SMOOTHING * share) / (total + SMOOTHING), rates))
    return params


def score_rules(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT
) -> DataFrame:
    """Counters, votes and posterior quality of every document.

    Returns doc_id, the counters, ``base_failed`` (under 50 words, or over half of the words in
    repeated windows of three), ``quality`` (posterior of good) and ``kept``: not base_failed
    and ``quality`` of ``keep_at`` at least. Null and empty texts have no words, no votes and
    fail the base; rows are counted one by one, repeated ids included; other columns of ``df``
    are not looked at. An empty table gives an empty table.
    """
    counted = materialize(counters(df, id_col, text_col))
    failed = (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    voted = counted.select("*", failed.alias("base_failed"), votes().alias("v"))
    patterns = materialize(voted.groupBy("v").agg(F.count(F.lit(1)).alias("n")).coalesce(1))
    params = fit(patterns, len(RULES))
    quality = _class_weights(params)[0]
    return voted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & (quality >= keep_at)).alias("kept"),
        F.round(quality, 6).alias("quality"), F.col("v").alias("votes"),
    )
