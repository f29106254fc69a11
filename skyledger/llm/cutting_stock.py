"""Packing documents into sequences by column generation for the cutting-stock problem.

A document is its whole sequences and a rest. The histogram of rest lengths is the demand of a
cutting-stock problem: a linear program over patterns of lengths that fill one sequence, whose
columns come from a knapsack by dynamic programming. Rounded patterns are assigned to the rests,
ranked within their length. What rounding leaves, and lengths that no pattern fills well, is
laid end to end and cut at the sequence boundaries.

Only the histogram, a row per length and sorted partition, comes to the driver. Token ids stay
in the tasks; a rest's ids travel once, to be sorted by length.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import materialize

LENGTH = 1024
END_ID = 0
# The program stops within this share of its lower bound; a pattern may waste this share.
GAP = 0.002
WASTE = 0.008


# tokens ------------------------------------------------------------------------------------


def byte_bpe(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Encoder of a byte-level BPE file without special tokens added.

    The merges of ``path`` run in tiktoken, several times as fast, if the same vocabulary is
    beside it as ranks; texts with the special token's own string take the tokenizers library.
    Both give the same ids.
    """
    import base64
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    slow = Tokenizer.from_file(path)

    def by_tokenizers(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]

    ranks_path = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks_path):
        return by_tokenizers
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})
    special = [token.content for token in slow.get_added_tokens_decoder().values()]

    def encode(texts: list[str]) -> list[list[int]]:
        return [
            by_tokenizers([text])[0] if any(s in text for s in special)
            else fast.encode_ordinary(text)
            for text in texts
        ]

    return encode


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenized(df: DataFrame, id_col: str, text_col: str, tokenizer: str, length: int) -> DataFrame:
    """Per row: doc_id, its tokens, checksums of its whole sequences, its rest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = byte_bpe(tokenizer)
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.iloc[begin:begin + 256]
                tokens, crcs, rests = [], [], []
                for ids in encode([text or "" for text in part["text"]]):
                    ids = np.append(np.asarray(ids, dtype="<u4"), np.uint32(END_ID))
                    whole = ids.size // length
                    tokens.append(ids.size)
                    crcs.append([_crc(ids[k * length:(k + 1) * length]) for k in range(whole)])
                    rests.append(ids[whole * length:].astype("<u4").tobytes())
                yield pd.DataFrame({"doc_id": part["doc_id"].array, "tokens": tokens,
                                    "crcs": crcs, "rest": rests})

    slim = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInPandas(
        run, "doc_id string, tokens long, crcs array<long>, rest binary")


# the program -------------------------------------------------------------------------------


def _knapsack(values: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total value of any lengths for every capacity, and the length taken last (0: none).

    ``values[k]`` is the value of length k; a length may be taken any number of times.
    """
    best = np.zeros(length + 1)
    last = np.zeros(length + 1, dtype=np.int64)
    for room in range(1, length + 1):
        sums = best[room - 1::-1] + values[1:room + 1]
        at = int(sums.argmax())
        if sums[at] > best[room - 1]:
            best[room], last[room] = sums[at], at + 1
        else:
            best[room] = best[room - 1]
    return best, last


def _unfold(last: np.ndarray, room: int) -> dict[int, int]:
    pattern: dict[int, int] = {}
    while room > 0:
        if last[room]:
            pattern[int(last[room])] = pattern.get(int(last[room]), 0) + 1
            room -= int(last[room])
        else:
            room -= 1
    return pattern


def _first_columns(demand: dict[int, int], length: int) -> list[tuple[dict, int, float]]:
    """Patterns that meet the demand, each around the longest rest still there, with the length
    that it uses up for good and its number; so, in this order, they are a triangular basis.

    The knapsack fills the room beside the rest, exactly if it can, with lengths of which many
    are left.
    """
    left = np.zeros(length + 1)
    left[list(demand)] = list(demand.values())
    own = np.arange(length + 1)
    out = []
    while True:
        open_ = np.flatnonzero(left > 1e-9)
        if not open_.size:
            return out
        longest = int(open_[-1])
        pattern = {longest: 1}
        room = length - longest
        if room:
            rare = 0.5 * own / length * (1 - left / left.max())
            values = np.where(left >= 1, own - rare, 0.0)
            if left[longest] < 2:
                values[longest] = 0
            _, last = _knapsack(values[:room + 1], room)
            for rest, n in _unfold(last, room).items():
                n = min(n, int(left[rest]) - (rest == longest))
                if n > 0:
                    pattern[rest] = pattern.get(rest, 0) + n
        keys = list(pattern)
        amounts = np.array([pattern[k] for k in keys])
        share = left[keys] / amounts
        left[keys] -= share.min() * amounts
        spent = keys[int(share.argmin())]
        left[spent] = 0
        out.append((pattern, spent, float(share.min())))


# Patterns that a pricing round brings in at most, and pivots after which the inverse is made anew.
ENTERING = 64
REFACTOR = 100
# The rounds also end when so many of them gain less than this share.
STALL_ROUNDS = 100
STALL_GAIN = 0.0005


def solve(
    demand: dict[int, int], length: int, gap: float = GAP, price: bool = True
) -> list[tuple[dict, float]]:
    """Patterns and their numbers that cover ``demand`` with few sequences.

    Column generation by a revised simplex. It begins with patterns that each use up a length. A
    pricing round solves one knapsack at the current duals and brings in the best pattern around
    each of the lengths that gain most, while it still improves. The duals over the value of the
    best pattern are feasible, as are lengths over the sequence length; the better of both bounds
    ends the rounds within ``gap`` of the optimum, a long stall ends them above. A length that
    ran out beside another one begins with a small demand of its own, so that no row of the basis
    is at zero and pivots move: the cover is larger by up to a part in 1000.

    ``price`` off leaves the patterns of the beginning, for comparison.
    """
    if not demand:
        return []
    lengths = sorted(demand)
    row = {own: k for k, own in enumerate(lengths)}
    m = len(lengths)
    due = np.array([demand[own] for own in lengths], dtype=np.float64)
    own_times = length // np.array(lengths, dtype=np.int64)
    patterns = [{own: int(n)} for own, n in zip(lengths, own_times, strict=True)]
    basis = np.diag(own_times.astype(np.float64))
    number = 1e-3 * (0.5 + 0.5 * np.random.default_rng(3).random(m)) * due / own_times
    for pattern, spent, times in _first_columns(demand, length):
        k = row[spent]
        patterns[k], number[k] = pattern, max(times, number[k])
        basis[:, k] = 0
        for own, n in pattern.items():
            basis[row[own], k] = n
    need = basis @ number
    inverse = np.linalg.inv(basis)
    duals, bound, pivots, values_at = inverse.sum(axis=0), float(need @ lengths) / length, 0, []
    while price:
        values = np.zeros(length + 1)
        values[lengths] = np.maximum(duals, 0)
        best, last = _knapsack(values, length)
        bound = max(bound, float(need @ values[lengths]) / max(best[length], 1.0))
        values_at.append(number.sum())
        if number.sum() <= (1 + gap) * bound:
            break
        if (len(values_at) > STALL_ROUNDS
                and values_at[-1] > (1 - STALL_GAIN) * values_at[-1 - STALL_ROUNDS]):
            break
        moved = False
        for first in sorted(lengths, key=lambda own: -(values[own] + best[length - own]))[:ENTERING]:
            pattern = _unfold(last, length - first)
            pattern[first] = pattern.get(first, 0) + 1
            places = [row[own] for own in pattern]
            amounts = np.array(list(pattern.values()), dtype=np.float64)
            excess = amounts @ duals[places] - 1
            if excess <= 1e-9:
                continue
            step = inverse[:, places] @ amounts
            able = np.flatnonzero(step > 1e-9)
            ratio = number[able] / step[able]
            # of nearly equal ratios the largest pivot
            near = able[ratio <= ratio.min() * (1 + 1e-9) + 1e-12]
            leave = int(near[step[near].argmax()])
            times = number[leave] / step[leave]
            number -= times * step
            number[leave] = times
            np.maximum(number, 0, out=number)
            patterns[leave] = pattern
            basis[:, leave] = 0
            basis[places, leave] = amounts
            pivots += 1
            if pivots % REFACTOR:
                pivot = inverse[leave] / step[leave]
                step[leave] = 0
                inverse -= np.multiply.outer(step, pivot)
                inverse[leave] = pivot
                duals = duals - excess * pivot
            else:
                inverse = np.linalg.inv(basis)
                number, duals = np.maximum(inverse @ need, 0), inverse.sum(axis=0)
            moved = True
        if not moved:
            break
    return [(p, float(x)) for p, x in zip(patterns, number, strict=True) if x > 1e-9]


@dataclass
class Plan:
    """Where the r-th rest of a length goes.

    ``runs[l]``: (first rank, end rank, first sequence, copies a sequence, offset of the first
    copy); from rank ``end`` of the last run on, a rest is on the line that begins at
    ``line[l]``, which is cut into sequences from ``line_sequence`` on.
    """

    length: int
    runs: dict[int, list[tuple[int, int, int, int, int]]] = field(default_factory=dict)
    line: dict[int, int] = field(default_factory=dict)
    line_sequence: int = 0
    sequences: int = 0

    def place(self, rest: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the rest, length, sequence, offset) of its pieces."""
        used = 0
        for first, end, sequence, copies, offset in self.runs.get(rest, ()):
            if rank < end:
                turn = rank - first
                return [(0, rest, sequence + turn // copies, offset + turn % copies * rest)]
            used = end
        at = self.line[rest] + (rank - used) * rest
        pieces, begin = [], 0
        while begin < rest:
            room = self.length - (at + begin) % self.length
            size = min(room, rest - begin)
            pieces.append((begin, size, self.line_sequence + (at + begin) // self.length,
                           (at + begin) % self.length))
            begin += size
        return pieces


def make_plan(demand: dict[int, int], length: int, waste: float = WASTE) -> Plan:
    """Round the program's patterns and lay out the sequences.

    Patterns that waste more than ``waste`` of a sequence are left out. The others are used as
    often as their whole number says, then, by the largest fraction, once more while the rests
    last. All further rests go on the line, longest first.
    """
    left = dict(demand)
    plan = Plan(length)
    used: dict[int, int] = dict.fromkeys(demand, 0)
    chosen = []
    if demand:
        for pattern, x in solve(demand, length):
            if sum(own * n for own, n in pattern.items()) >= (1 - waste) * length:
                chosen.append((x - int(x), int(x), pattern))
    counts = []
    for extra in (False, True):
        for fraction, whole, pattern in sorted(chosen, key=lambda c: -c[0]):
            most = min(left[own] // n for own, n in pattern.items())
            times = min(most, 1 if extra else whole)
            if times:
                counts.append((pattern, times))
                for own, n in pattern.items():
                    left[own] -= n * times
    for pattern, times in counts:
        offset = 0
        for own in sorted(pattern, reverse=True):
            n = pattern[own]
            plan.runs.setdefault(own, []).append(
                (used[own], used[own] + n * times, plan.sequences, n, offset))
            used[own] += n * times
            offset += own * n
        plan.sequences += times
    plan.line_sequence = plan.sequences
    at = 0
    for own in sorted(left, reverse=True):
        plan.line[own] = at
        at += own * left[own]
    plan.sequences += -(-at // length)
    return plan


# operator ----------------------------------------------------------------------------------


def _ranked(rows: DataFrame, length: int) -> DataFrame:
    """Rows sorted by rest length, numbered: partition, place among its equals and the whole
    sequences before it there. Written, so the numbers hold."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, current, place, whole = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            places, wholes = [], []
            for tokens in batch["tokens"].to_numpy():
                rest = tokens % length
                if rest != current:
                    current, place = rest, 0
                places.append(place)
                wholes.append(whole)
                place += 1
                whole += tokens // length
            yield batch.drop(columns="uid").assign(part=part, place=places, before=wholes)

    dealt = rows.withColumn("uid", F.monotonically_increasing_id()).repartitionByRange(
        F.col("tokens") % length, "uid"
    ).sortWithinPartitions(F.col("tokens") % length, "uid")
    return materialize(dealt.mapInPandas(
        number, "doc_id string, tokens long, crcs array<long>, rest binary, part long, "
        "place long, before long"))


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    length: int = LENGTH,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens.

    A document is the ids of its text and the id 0. Per piece: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id and offset. Whole sequences of a document stand alone; its rest goes
    where the plan says, whole or, if it crosses a boundary of the line, in two pieces. At most
    one sequence of all is filled less than its pattern allows.

    A null or empty text is the single id 0. Null and repeated ids are rows like any other, each
    with pieces of its own; an empty table gives no pieces.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = materialize(
        tokenized(df, id_col, text_col, tokenizer or default_tokenizer(), length))
    ranked = _ranked(rows, length)
    # a row per partition and length in it: sorted partitions hold few lengths each
    groups = ranked.groupBy("part", (F.col("tokens") % length).alias("rest")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("tokens") / length)).alias("whole"),
    ).orderBy("part", "rest").collect()
    demand: dict[int, int] = {}
    rank_before: dict[tuple[int, int], int] = {}
    whole_by_part: dict[int, int] = {}
    for g in groups:
        rank_before[g["part"], g["rest"]] = demand.get(g["rest"], 0)
        demand[g["rest"]] = demand.get(g["rest"], 0) + g["n"]
        whole_by_part[g["part"]] = whole_by_part.get(g["part"], 0) + g["whole"]
    demand.pop(0, None)
    plan = make_plan(demand, length)
    whole_before, total = {}, plan.sequences
    for part in sorted(whole_by_part):
        whole_before[part] = total
        total += whole_by_part[part]
    shared = df.sparkSession.sparkContext.broadcast((vars(plan), rank_before, whole_before))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fields, rank_before, whole_before = shared.value
        plan = Plan(**fields)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                rest = row.tokens % length
                sequence = whole_before[row.part] + row.before
                for k, crc in enumerate(row.crcs):
                    out.append((row.doc_id, k * length, length, crc, row.tokens, sequence + k, 0))
                if rest:
                    ids = np.frombuffer(row.rest, dtype="<u4")
                    rank = rank_before[row.part, rest] + row.place
                    for begin, size, sequence, offset in plan.place(rest, rank):
                        out.append((row.doc_id, row.tokens - rest + begin, size,
                                    _crc(ids[begin:begin + size]), row.tokens, sequence, offset))
            yield pd.DataFrame(out, columns=names)

    return ranked.mapInPandas(
        pieces, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long",
    ).withColumn("doc_id", F.col("doc_id").cast(kind))
