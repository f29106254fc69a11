"""Two tokenisations of each text, aligned at common token ends, with corpus-wide pair counts.

A link is a token of side A and one of side B that end at the same byte. How often a pair of ids
is linked in the whole corpus is counted outside of memory:

- A task encodes its texts and keeps blocks of pair-document records: the block's distinct pairs,
  side B first, and per document the pairs' numbers and how often they occur. The pairs with
  their counts in the block are cut by the low bits of the B id into parts. Block and parts are
  runs of bytes under zstd in a written table.
- Runs of a part are merged through a heap, B id by B id. Parts with many runs are cut into
  chunks of bounded size, whose counts are added up.
- A second merge, with the totals as one more run, knows all pairs of a B id at once, so its
  highest count too, and streams counts and highest marks back, one run per block and part.
- Block by block these meet the records, which gives the sums per document.

Documents never travel as rows per link; a pair that is in every document is one entry per block.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import io
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import materialize

# A block of documents ends at this many pair-document records or documents.
BLOCK_RECORDS = 2_000_000
BLOCK_DOCS = 20_000
# Parts of the pairs by B id, and the bytes of runs that are merged in one task at a time.
PARTS = 64
CHUNK_BYTES = 16 * 1024 * 1024
# Texts that are encoded together; a longer text than this is encoded piece by piece.
ENCODED = 64
LONG_TEXT = 100_000


# tokenizers --------------------------------------------------------------------------------


class Side:
    """An encoder of texts, and the bytes of each id.

    ``cuts`` tells that no token goes on from a Latin letter to a space.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.cuts = not any(re.search(rb"[A-Za-z] ", piece) for piece in pieces)


def _byte_letters() -> dict[str, int]:
    """The bytes that the letters of a byte-level vocabulary stand for: printable Latin-1 stands
    for itself, the other bytes in order for letters from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_bpe_side(path: str) -> Side:
    """Side A: texts after a space by a byte-level BPE file; special tokens are plain text.

    The ranks beside the file, if they are there, run the same merges in tiktoken.
    """
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    letters = _byte_letters()
    pieces = [b""] * model.get_vocab_size()
    for token, number in model.get_vocab().items():
        known = all(c in letters for c in token)
        pieces[number] = bytes(letters[c] for c in token) if known else token.encode()

    ranks_path = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks_path):
        def encode(texts: list[str]) -> list[list[int]]:
            batch = [" " + text for text in texts]
            return [e.ids for e in model.encode_batch(batch, add_special_tokens=False)]

        return Side(encode, pieces)
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})
    return Side(lambda texts: [fast.encode_ordinary(" " + text) for text in texts], pieces)


def sentence_piece_side(path: str) -> Side:
    """Side B: texts by a SentencePiece model, which puts the space before them itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        pieces.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number)
                      else piece.replace("▁", " ").encode())
    return Side(lambda texts: model.encode(texts, num_threads=1), pieces)


# alignment ---------------------------------------------------------------------------------

_POWERS = 10 ** np.arange(10, dtype=np.int64)


def _written(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Decimal ids, each followed by the byte in ``ends``, as one array of bytes."""
    width = int(np.searchsorted(_POWERS, ids.max(initial=0), side="right")) or 1
    digits = (ids[:, None] // _POWERS[width - 1::-1]) % 10 + ord("0")
    used = ids[:, None] >= _POWERS[width - 1::-1]
    used[:, -1] = True
    table = np.concatenate([digits.astype(np.uint8), ends[:, None].astype(np.uint8)], axis=1)
    return table[np.concatenate([used, np.ones((len(ids), 1), dtype=bool)], axis=1)]


class Aligned:
    """Tokens of a text on both sides, cut where a token of each ends."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray):
        self.a, self.b = a, b
        # no token is empty, so ends ascend and a common end is one link
        _, self.at_a, self.at_b = np.intersect1d(
            a_ends, b_ends, assume_unique=True, return_indices=True)

    def groups_text(self) -> bytes:
        comma, bar, mark = b",|;"
        a_sep = np.full(len(self.a), comma, dtype=np.uint8)
        b_sep = np.full(len(self.b), comma, dtype=np.uint8)
        a_sep[self.at_a], b_sep[self.at_b] = bar, mark
        # tokens of a group: its A tokens, then its B tokens
        a_before = np.diff(self.at_a, prepend=-1)
        b_before = np.diff(self.at_b, prepend=-1)
        a_done, b_done = np.cumsum(a_before), np.cumsum(b_before)
        ids = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        ends = np.empty(len(ids), dtype=np.uint8)
        place_a = np.arange(len(self.a)) + np.repeat(b_done - b_before, a_before)
        place_b = np.arange(len(self.b)) + np.repeat(a_done, b_before)
        ids[place_a], ids[place_b] = self.a, self.b
        ends[place_a], ends[place_b] = a_sep, b_sep
        return _written(ids, ends)[:-1].tobytes()


def aligned(texts: list[str], side_a: Side, side_b: Side) -> list[Aligned | None]:
    """Alignment of each text; None where it does not come back from its tokens."""
    out: list[Aligned | None] = []
    for text, a, b in zip(texts, side_a.encode(texts), side_b.encode(texts), strict=True):
        whole = (" " + text).encode()
        a_back = b"".join(map(side_a.pieces.__getitem__, a))
        if a_back != whole or b"".join(map(side_b.pieces.__getitem__, b)) != whole:
            out.append(None)
            continue
        a, b = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
        out.append(Aligned(a, b, np.cumsum(side_a.sizes[a]), np.cumsum(side_b.sizes[b])))
    return out


_WORD_GAP = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


def cut(text: str, length: int) -> Iterator[str]:
    """Pieces of about ``length``, cut at spaces between words, which go: both sides begin a
    token with such a space, as they do at the start of a text."""
    begin = 0
    while found := _WORD_GAP.search(text, begin + length):
        yield text[begin:found.start()]
        begin = found.end()
    yield text[begin:]


def aligned_pieces(
    texts: list[str], side_a: Side, side_b: Side, length: int = LONG_TEXT
) -> Iterator[Iterator[Aligned | None]]:
    """Per text the alignments of its pieces, one after the other; none for an empty text."""
    cuts = side_a.cuts and side_b.cuts
    short = [text for text in texts if text and not (cuts and len(text) > length)]
    together = iter(aligned(short, side_a, side_b))
    for text in texts:
        if cuts and len(text) > length:
            yield (aligned([piece], side_a, side_b)[0] for piece in cut(text, length))
        else:
            yield iter([next(together)] if text else [])


class _Document:
    """What is kept of a text: numbers of tokens and groups, linked pairs, the groups' digest."""

    def __init__(self, pieces: Iterator[Aligned | None], a_ids: int, with_groups: bool):
        self._clear()
        digest = hashlib.sha256()
        for number, one in enumerate(pieces):
            if one is None:
                self._clear()
                return
            self.n_a += len(one.a)
            self.n_b += len(one.b)
            self.n_groups += len(one.at_a)
            self.keys.append(one.b[one.at_b] * a_ids + one.a[one.at_a])
            groups = b";" * (number > 0) + one.groups_text()
            digest.update(groups)
            if with_groups:
                self.groups += groups.decode()
            self.sha256 = digest.hexdigest()

    def _clear(self) -> None:
        self.n_a = self.n_b = self.n_groups = 0
        self.keys: list[np.ndarray] = []
        self.groups = self.sha256 = ""

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs and how often each is."""
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.unique(np.concatenate(self.keys), return_counts=True)


# runs --------------------------------------------------------------------------------------


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers as zstd bytes: per array byte by byte of the numbers."""
    import zstandard

    out = io.BytesIO()
    for array in arrays:
        array = np.ascontiguousarray(array, dtype="<u8")
        out.write(np.uint64(array.size).tobytes())
        planes = array.view(np.uint8).reshape(-1, 8).T
        width = 8
        while width and not planes[width - 1].any():
            width -= 1
        out.write(np.uint64(width).tobytes())
        out.write(np.ascontiguousarray(planes[:width]).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(out.getvalue())


def unpacked(run: bytes) -> list[np.ndarray]:
    import zstandard

    body = zstandard.ZstdDecompressor().decompress(run)
    out, at = [], 0
    while at < len(body):
        size, width = np.frombuffer(body, dtype="<u8", count=2, offset=at).tolist()
        at += 16
        planes = np.zeros((8, size), dtype=np.uint8)
        planes[:width] = np.frombuffer(
            body, dtype=np.uint8, count=size * width, offset=at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.int64))
        at += size * width
    return out


def _steps(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=0)


class _Block:
    """Records of the documents that a task has encoded since the last block."""

    def __init__(self, a_ids: int):
        self.a_ids = a_ids
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.records = 0

    def add(self, one: _Document) -> None:
        keys, counts = one.pairs()
        self.keys.append(keys)
        self.counts.append(counts)
        self.sizes.append(len(keys))
        self.records += len(keys)

    def full(self) -> bool:
        return self.records >= BLOCK_RECORDS or len(self.sizes) >= BLOCK_DOCS

    def runs(self, parts: int) -> Iterator[tuple[int, bytes]]:
        """The records under part -1, then pairs and counts of each part."""
        counts = np.concatenate(self.counts)
        pairs, numbers = np.unique(np.concatenate(self.keys), return_inverse=True)
        firsts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        # numbers ascend inside a document: small steps, from its first one on
        steps = _steps(numbers)
        begins = firsts[np.asarray(self.sizes) > 0]
        steps[begins] = numbers[begins]
        yield -1, packed(np.asarray(self.sizes), steps, counts)
        sums = np.bincount(numbers, weights=counts, minlength=len(pairs)).astype(np.int64)
        part = (pairs // self.a_ids) % parts
        for number in np.unique(part).tolist():
            mine = part == number
            yield number, packed(_steps(pairs[mine]), sums[mine])


def _records(run: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: records per document, their pairs' numbers, their counts."""
    sizes, steps, counts = unpacked(run)
    steps = steps.copy()
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    begins = firsts[sizes > 0]
    # a document's first number stands alone: take away what the sum has reached before it
    sums = np.cumsum(steps)
    reached = sums[begins - 1] if len(begins) else begins
    if len(begins):
        reached = np.where(begins > 0, reached, 0)
    offsets = np.repeat(reached, sizes[sizes > 0])
    return sizes, sums - offsets, counts


# merge -------------------------------------------------------------------------------------


def _by_side(run: int, pairs: np.ndarray, counts: np.ndarray, a_ids: int) -> Iterator[tuple]:
    """Slices of a sorted run with one B id each."""
    sides = pairs // a_ids
    edges = np.flatnonzero(np.diff(sides)) + 1
    for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(pairs)], strict=True):
        if end > begin:
            yield int(sides[begin]), run, pairs[begin:end], counts[begin:end]


def merged(runs: list[tuple[np.ndarray, np.ndarray]], a_ids: int) -> Iterator[list[tuple]]:
    """The slices of all runs, B id by B id, through a heap of the runs' next slices."""
    streams = [_by_side(number, *run, a_ids) for number, run in enumerate(runs)]
    held: list[tuple] = []
    for found in heapq.merge(*streams, key=lambda s: s[:2]):
        if held and held[0][0] != found[0]:
            yield held
            held = []
        held.append(found)
    if held:
        yield held


def _summed(slices: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    pairs, numbers = np.unique(np.concatenate([s[2] for s in slices]), return_inverse=True)
    counts = np.bincount(numbers, weights=np.concatenate([s[3] for s in slices]))
    return pairs, counts.astype(np.int64)


def _opened(runs: pd.Series) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for run in runs:
        steps, counts = unpacked(run)
        out.append((np.cumsum(steps), counts))
    return out


# Blocks of documents and their runs in one table: the columns of a row of one kind are null in
# a row of the other.
_DOC = {"doc": "int", "id": "string", "n_a": "long", "n_b": "long", "n_groups": "long",
        "groups_sha256": "string", "groups": "string"}
_RUN = {"part": "int", "run": "binary", "bytes": "long"}
_STORED = {"block": "long", **_DOC, **_RUN}


def _schema(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def _rows(block: int, columns: dict[str, str], rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=list(columns), dtype=object)
    return frame.assign(block=block).reindex(columns=list(_STORED)).astype(object).where(
        lambda f: f.notna(), None)


def _blocks(
    df: DataFrame, a_path: str, b_path: str, a_ids: int, parts: int, with_groups: bool
) -> DataFrame:
    """Documents, their records and the parts' runs, block by block."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        side_a, side_b = byte_bpe_side(a_path), sentence_piece_side(b_path)
        number, block, held = TaskContext.get().partitionId() << 32, _Block(a_ids), []

        def closed() -> Iterator[pd.DataFrame]:
            for begin in range(0, len(held), 1000):
                yield _rows(number, _DOC, held[begin:begin + 1000])
            for part, run in block.runs(parts) if held else ():
                yield _rows(number, _RUN, [(part, run, len(run))])

        for batch in batches:
            for begin in range(0, len(batch), ENCODED):
                rows = batch.iloc[begin:begin + ENCODED]
                texts = [text or "" for text in rows["text"]]
                for key, pieces in zip(
                        rows["id"], aligned_pieces(texts, side_a, side_b), strict=True):
                    one = _Document(pieces, a_ids, with_groups)
                    held.append((len(held), key, one.n_a, one.n_b, one.n_groups, one.sha256,
                                 one.groups if with_groups else None))
                    block.add(one)
                if block.full():
                    yield from closed()
                    number, block, held = number + 1, _Block(a_ids), []
        yield from closed()

    return df.mapInPandas(encode, _schema(_STORED))


def _counts_of_blocks(runs: DataFrame, a_ids: int, chunk_bytes: int) -> DataFrame:
    """For each run of pairs their counts in all runs, and whether a B id's highest."""
    # a row per part, which bounds the broadcast
    chunks = F.broadcast(runs.groupBy("part").agg(
        F.ceil(F.sum("bytes") / chunk_bytes).cast("int").alias("chunks")))
    chunked = runs.join(chunks, "part").withColumn(
        "chunk", F.pmod(F.xxhash64("block"), "chunks").cast("int")).drop("chunks", "bytes")

    def count(key: tuple, runs: pd.DataFrame) -> pd.DataFrame:
        sums = [_summed(slices) for slices in merged(_opened(runs["run"]), a_ids)]
        return pd.DataFrame({"part": key[0], "pair": np.concatenate([s[0] for s in sums]),
                             "count": np.concatenate([s[1] for s in sums])})

    totals = chunked.groupBy("part", "chunk").applyInPandas(
        count, "part int, pair long, count long").groupBy("part", "pair").agg(
        F.sum("count").alias("count"))
    totals = materialize(totals).join(chunks, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "pair",
        "count")

    def stream_back(key: tuple, runs: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        totals = totals.sort_values("pair")
        opened = _opened(runs["run"])
        known = (totals["pair"].to_numpy(), totals["count"].to_numpy())
        counts = [[] for _ in opened]
        highest = [[] for _ in opened]
        for slices in merged([*opened, known], a_ids):
            *own, (_, _, pairs, total) = slices
            top = total.max()
            for _, number, mine, _ in own:
                found = total[np.searchsorted(pairs, mine)]
                counts[number].append(found)
                highest[number].append(found == top)
        return pd.DataFrame({
            "block": runs["block"].array, "part": runs["part"].array,
            "run": [packed(_steps(pairs), np.concatenate(c), np.concatenate(h))
                    for (pairs, _), c, h in zip(opened, counts, highest, strict=True)]})

    return chunked.groupBy("part", "chunk").cogroup(
        totals.groupBy("part", "chunk")).applyInPandas(
        stream_back, "block long, part int, run binary")


def _sums(docs: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
    """Results of the documents of a block: its records meet the counts of their pairs."""
    docs = docs.sort_values("doc")
    sizes, numbers, counts = _records(runs.loc[runs["part"] < 0, "run"].iloc[0])
    known = [unpacked(run) for run in runs.loc[runs["part"] >= 0, "run"]]
    nothing = [np.zeros(0, dtype=np.int64)]
    # the records number the pairs in order over all parts
    order = np.argsort(np.concatenate([np.cumsum(run[0]) for run in known] or nothing))
    total, highest = (np.concatenate([run[i] for run in known] or nothing)[order] for i in (1, 2))
    doc = np.repeat(np.arange(len(sizes)), sizes)

    def per_doc(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(sizes), dtype=np.int64)
        np.add.at(out, doc, values)
        return out

    shown = ["id", "n_a", "n_b", "n_groups", "groups_sha256", "groups"]
    return pd.DataFrame({
        **{name: docs[name].array for name in shown},
        "n_links": per_doc(counts), "n_best": per_doc(counts * highest[numbers]),
        "count_sum": per_doc(counts * total[numbers])})


def align_tokens(
    df: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_groups: bool = False,
    parts: int = PARTS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per row: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256``; ``with_groups`` adds ``groups``, the aligned ids as text.

    ``a_path`` is a byte-level BPE file, ``b_path`` a SentencePiece model; both must be there on
    every executor. ``n_best`` counts links whose pair is, with ties, the most frequent of its B
    id in the whole table; ``count_sum`` adds up the counts of the links' pairs. A null or empty
    text, and one that either side does not give back byte by byte, has no tokens: numbers are 0,
    texts empty. Rows count by themselves: ids may repeat or be null, and repeated texts count
    each time. Very long texts are encoded piece by piece, cut where both sides cut. An empty
    table gives no rows. Columns beside the two named ones do not matter.
    """
    ids = df.schema[id_col].dataType
    a_ids = len(byte_bpe_side(a_path).pieces)
    slim = df.select(F.col(f"`{id_col}`").cast("string").alias("id"),
                     F.col(f"`{text_col}`").alias("text"))
    stored = materialize(_blocks(slim, a_path, b_path, a_ids, parts, with_groups))
    # named anew: both sides of the cogroup below come from one table
    docs = stored.where(F.col("part").isNull()).select(F.col("block").alias("of"), *_DOC)
    runs = stored.where(F.col("part").isNotNull()).select("block", *_RUN)
    back = _counts_of_blocks(runs.where("part >= 0"), a_ids, chunk_bytes)
    records = runs.where("part < 0").drop("bytes")
    results = docs.groupBy("of").cogroup(
        records.unionByName(back).groupBy("block")).applyInPandas(_sums, (
            "id string, n_a long, n_b long, n_groups long, groups_sha256 string, groups string, "
            "n_links long, n_best long, count_sum long"))
    return results.select(
        F.col("id").cast(ids).alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best",
        "count_sum", "groups_sha256", *(["groups"] if with_groups else []))
