"""Main text of web pages by differencing against the page with the nearest URL.

Distinct pages of a host are sorted by URL path; each is paired with the neighbour that shares the
longer start of the path, past copies of itself. The lines of the two are aligned by their longest common subsequence, and the
shared lines go: they are the site's frame. The page's own markup then has the last word: lines
inside an article or main element stay, also where two articles share a paragraph; lines inside
menus, adverts, forms and the like go, also where no other page has them.

Pairs are made of line hashes, not of texts: neighbours come from an equi-join on the number of
the run of equal pages in the sorted order, so a host with a third of all pages is spread like
any other. All copies of a page at a URL have the verdict of one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from os.path import commonprefix
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType

from skyledger.session import materialize

INSIDE, OUTSIDE, FRAME = "i", "o", "f"

# Elements and the words of class, id and role that tell what an element holds.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol "
    "p pre search section summary table tbody tfoot thead tr ul".split()
)
SPACES = frozenset("br td th option".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
FRAME_ELEMENTS = frozenset(
    "nav footer aside form menu dialog button select label fieldset search".split()
)
CONTENT_ELEMENTS = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
FRAME_WORDS = frozenset(
    "ad ads adsense advert advertisement adverts advertising sponsor sponsored sponsors promo "
    "promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup sidebar widget widgets menu nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar comment comments "
    "reply replies respond disqus share sharing social related recommended login search "
    "complementary contentinfo skip".split()
)
HEAD_WORDS = frozenset(["header", "head"])
# A class such as with-sidebar or no-comments says what is beside an element's content.
BESIDE_WORDS = frozenset("with has no without".split())
# Elements whose content is no text of the page.
_RAW = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|math|textarea|object|title)\b"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)",
    re.S | re.I,
)
_TAG = re.compile(
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*(?:>|\Z)"
    r"|<(?=[a-zA-Z/])[^<>]*\Z"
)
_HINT = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HINT_WORD = re.compile(r"[a-z0-9]+")


def _is_frame(tag: str, attributes: str, inside: bool) -> bool:
    if tag in FRAME_ELEMENTS or (tag == "header" and not inside):
        return True
    if tag in ("html", "body") or not attributes:
        return False
    found: set[str] = set()
    for match in _HINT.finditer(attributes):
        for name in "".join(filter(None, match.groups())).lower().split():
            parts = _HINT_WORD.findall(name)
            if parts and parts[0] not in BESIDE_WORDS:
                # an article or main element that has a frame beside it is not the frame
                found.update(parts[:1] if tag in CONTENT_ELEMENTS else parts)
    return not FRAME_WORDS.isdisjoint(found) or (
        not inside and tag not in CONTENT_ELEMENTS and not HEAD_WORDS.isdisjoint(found))


def page_lines(source: str | None) -> list[tuple[str, str]]:
    """(state, line) of every block with text, in page order.

    The state is INSIDE an article or main element, in the FRAME by an element or its class, or
    OUTSIDE of both. Unclosed elements end with the next one around them; a tag that the end of
    the page cuts off is no text.
    """
    source = _RAW.sub(" ", source or "")
    out: list[tuple[str, str]] = []
    parts: list[str] = []
    # (element, state of what is in it)
    stack: list[tuple[str, str]] = [("", OUTSIDE)]
    # whether the open paragraph is a frame by its class; any block ends it
    framed = False

    def flush() -> None:
        if parts:
            line = " ".join(html.unescape("".join(parts)).split())
            if line:
                out.append((FRAME if framed else stack[-1][1], line))
            parts.clear()

    at = 0
    for match in _TAG.finditer(source):
        if match.start() > at:
            parts.append(source[at:match.start()])
        at = match.end()
        closing, tag, attributes = match.group(1), (match.group(2) or "").lower(), match.group(3)
        if tag in BLOCKS:
            flush()
            framed = False
        elif tag in SPACES:
            parts.append(" ")
        if tag == "p" and not closing:
            framed = _is_frame(tag, attributes, stack[-1][1] == INSIDE)
        if not tag or tag in VOID or tag == "p":
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if any(name in BLOCKS for name, _ in stack[depth:]):
                        flush()
                    del stack[depth:]
                    break
        elif tag in BLOCKS or tag in FRAME_ELEMENTS or attributes:
            state = stack[-1][1]
            inside = state == INSIDE
            if state != FRAME:
                if _is_frame(tag, attributes, inside):
                    state = FRAME
                elif tag in CONTENT_ELEMENTS:
                    state = INSIDE
            if state != stack[-1][1]:
                flush()
            stack.append((tag, state))
    if at < len(source):
        parts.append(source[at:])
    flush()
    return out


# alignment ---------------------------------------------------------------------------------

# Cells of the bit table of an alignment that is held at a time, and columns in a block of it.
TABLE_BITS = 1 << 31
COLUMNS = 1 << 14


def shared_lines(own: list[int], other: list[int]) -> list[bool]:
    """Which of ``own`` are in a longest common subsequence with ``other``.

    Common ends first; the middle by bit vectors, one word operation for many cells. A table of
    more than ``TABLE_BITS`` is made in pieces, with the same result.
    """
    flags = [False] * len(own)
    begin = 0
    while begin < min(len(own), len(other)) and own[begin] == other[begin]:
        flags[begin] = True
        begin += 1
    end = 0
    while (end < min(len(own), len(other)) - begin
           and own[len(own) - 1 - end] == other[len(other) - 1 - end]):
        flags[len(own) - 1 - end] = True
        end += 1
    a, b = own[begin:len(own) - end], other[begin:len(other) - end]
    common = set(a) & set(b)
    places = [begin + k for k, x in enumerate(a) if x in common]
    a, b = [x for x in a if x in common], [x for x in b if x in common]
    row = [(1 << min(COLUMNS, len(b) - at)) - 1 for at in range(0, len(b), COLUMNS)]
    found: list[int] = []
    _trace(a, b, 0, len(a), row, len(b) - 1, found)
    for k in found:
        flags[places[k]] = True
    return flags


def _rows(a: list[int], b: list[int], row: list[int], keep: bool) -> list:
    """Per block of columns of ``b`` the row after the lines ``a``, or all rows from ``row`` on.

    Zeros of a row up to j: length of the subsequence of the lines so far and b[:j + 1].
    """
    carries = bytearray(len(a))
    out: list = []
    for c, now in enumerate(row):
        part = b[c * COLUMNS:(c + 1) * COLUMNS]
        masks: dict[int, int] = {}
        for j, x in enumerate(part):
            masks[x] = masks.get(x, 0) | (1 << j)
        width, every = len(part), (1 << len(part)) - 1
        rows = [now]
        for i, x in enumerate(a):
            mask = masks.get(x, 0)
            if mask or carries[i]:
                match = now & mask
                total = now + match + carries[i]
                carries[i] = total >> width
                now = (total & every) | (now - match)
            if keep:
                rows.append(now)
        out.append(rows if keep else now)
    return out


def _trace(a: list[int], b: list[int], low: int, high: int, row: list[int], j: int,
           found: list[int]) -> int:
    """Adds the lines of a[low:high] in the subsequence that ends at column j; ``row`` is the
    table's before them. The column where it goes on above."""
    if j < 0 or low == high:
        return j
    if high - low > 1 and (high - low) * (j + 1) > TABLE_BITS:
        middle = (low + high) // 2
        j = _trace(a, b, middle, high, _rows(a[low:middle], b, row, False), j, found)
        return _trace(a, b, low, middle, row[:j // COLUMNS + 1], j, found)
    table = _rows(a[low:high], b, row, True)
    i = high - low
    while i and j >= 0:
        rows, bit = table[j // COLUMNS], j % COLUMNS
        if (rows[i] >> bit) & 1:
            j -= 1
        elif not (rows[i - 1] >> bit) & 1:
            i -= 1
        else:
            found.append(low + i - 1)
            i, j = i - 1, j - 1
    return j


# operator ----------------------------------------------------------------------------------


def _hash(line: str) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"))).view("i8"))


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for page_id, url, source in zip(batch["id"], batch["url"], batch["html"], strict=True):
            lines = page_lines(source)
            inside = [line for state, line in lines if state == INSIDE]
            try:
                parts = urlsplit(url or "")
                host, path = parts.netloc.lower(), parts.path
            except ValueError:
                host, path = "", url
            rows.append((
                page_id, url, host, path,
                "\n".join(inside) if inside else None,
                None if inside else [line for state, line in lines if state == OUTSIDE],
                "".join(state for state, _ in lines),
                hashes := [_hash(line) for _, line in lines],
                xxhash.xxh3_128_hexdigest(np.array(hashes, dtype="<i8").tobytes()),
            ))
        yield pd.DataFrame(rows, columns=[
            "id", "url", "host", "path", "article", "outside", "states", "hashes", "content"])


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Numbers, in a sorted partition, the runs of pages of a host with equal lines."""
    run, last = -1, None
    for batch in batches:
        runs = []
        for now in zip(batch["host"], batch["content"], strict=True):
            run += now != last
            last = now
            runs.append(run)
        yield batch.assign(run=np.array(runs, dtype=np.int64))


@F.pandas_udf(StringType())
def _nearest(
    path: pd.Series, before_path: pd.Series, before: pd.Series, after_path: pd.Series,
    after: pd.Series,
) -> pd.Series:
    """The content with the longer common path; the prior one at a tie."""
    out = []
    for own, prior_path, prior, next_path, later in zip(
            path, before_path, before, after_path, after, strict=True):
        near = [
            (-len(commonprefix([own or "", there or ""])), turn, content)
            for turn, (there, content) in enumerate(((prior_path, prior), (next_path, later)))
            if content is not None
        ]
        out.append(min(near)[2] if near else None)
    return pd.Series(out, dtype=object)


@F.pandas_udf(ArrayType(BooleanType()))
def _shared(own: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([shared_lines(a.tolist(), b.tolist())
                      for a, b in zip(own, other, strict=True)], dtype=object)


def _neighbours(parsed: DataFrame) -> DataFrame:
    """host, path, content and the content ``other`` of the nearest page of the host that is no
    copy; a row per distinct page that has one.

    Pages with equal lines that follow each other are a run. Around it are the last page of the
    run before and the first page of the run after, also where a run goes over partitions.
    """
    order = ["host", "path", "content"]
    ordered = materialize(
        parsed.select(*order).distinct().repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .mapInPandas(_runs, "host string, path string, content string, part int, run long"))
    pieces = ordered.groupBy("part", "run").agg(
        F.min("path").alias("first"), F.max("path").alias("last"),
        F.first("host").alias("host"), F.first("content").alias("content"))
    # a row per sorted partition; its first run may go on from the one before
    both = F.struct("host", "content")
    parts = pieces.groupBy("part").agg(
        (F.max("run") + 1).alias("n"), F.min_by(both, "run").alias("begins"),
        F.max_by(both, "run").alias("ends"))
    whole = Window.orderBy("part")
    goes_on = F.coalesce((F.lag("ends").over(whole) == F.col("begins")).cast("long"), F.lit(0))
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    until = whole.rowsBetween(Window.unboundedPreceding, 0)
    starts = parts.select("part", "n", goes_on.alias("goes_on")).select(
        "part", (F.coalesce(F.sum("n").over(before), F.lit(0))
                 - F.sum("goes_on").over(until)).alias("start"))
    number = (F.col("start") + F.col("run")).alias("run")
    runs = materialize(
        pieces.join(F.broadcast(starts), "part").select(number, "host", "content", "first", "last")
        .groupBy("run").agg(F.min("first").alias("first"), F.max("last").alias("last"),
                            F.first("host").alias("host"), F.first("content").alias("content")))
    prior = runs.select((F.col("run") + 1).alias("run"), F.struct(
        "host", F.col("last").alias("path"), "content").alias("prior"))
    later = runs.select((F.col("run") - 1).alias("run"), F.struct(
        "host", F.col("first").alias("path"), "content").alias("later"))

    def of(name: str, part: str) -> Column:
        return F.when(F.col(f"{name}.host") == F.col("host"), F.col(f"{name}.{part}"))

    around = (
        runs.select("run", "host").join(prior, "run", "left").join(later, "run", "left")
        .select("run", *[of(name, part).alias(f"{name}_{part}")
                         for name in ("prior", "later") for part in ("path", "content")])
    )
    other = _nearest("path", "prior_path", "prior_content", "later_path", "later_content")
    return (
        ordered.join(F.broadcast(starts), "part").select(*order, number)
        .join(around, "run").select(*order, other.alias("other")).where("other IS NOT NULL")
    )


def extract_pages(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Main text of every page: page_id, url, text.

    A block is a line: references decoded, white space made one space. If the page has an
    article or main element, the text is its lines outside of frames. If not, it is the lines
    in no frame that the neighbour page does not share. Lines are joined by a line feed; without
    any the text is empty. Null html is an empty page; pages without a URL are one host; rows
    with the same id or URL are pages of their own, and copies of a page show nothing about it:
    its neighbour is the nearest page of the host with other lines.
    An empty table gives an empty table.
    """
    kind = df.schema[id_col].dataType.simpleString()
    slim = df.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"),
                     F.col(html_col).alias("html"))
    parsed = materialize(slim.mapInPandas(
        _parsed, "id string, url string, host string, path string, article string, "
        "outside array<string>, states string, hashes array<long>, content string",
    ).withColumn("uid", F.monotonically_increasing_id()))

    near = materialize(_neighbours(parsed))
    # every two contents are aligned once, however many pages have them
    lines = parsed.join(parsed.groupBy("content").agg(F.min("uid").alias("uid")).select("uid"),
                        "uid").select("content", "hashes")
    aligned = (
        near.select("content", "other").distinct()
        .join(lines.withColumnRenamed("hashes", "own"), "content")
        .join(lines.select(F.col("content").alias("other"), F.col("hashes").alias("there")), "other")
        .select("content", "other", _shared("own", "there").alias("shared"))
    )
    # whether a line goes, for the lines outside of frames and articles
    letters = F.split("states", "")
    gone = F.transform(
        F.filter(F.arrays_zip(F.col("shared").alias("shared"), letters.alias("state")),
                 lambda line: line["state"] == OUTSIDE),
        lambda line: line["shared"])
    verdicts = materialize(
        parsed.where(F.col("article").isNull())
        .select("uid", "host", "path", "content", "states")
        .join(near, ["host", "path", "content"]).join(aligned, ["content", "other"])
        .select("uid", gone.alias("gone")).where(F.exists("gone", lambda g: g)))
    kept = F.filter("outside", lambda _, i: ~F.coalesce(F.get("gone", i), F.lit(False)))
    text = F.coalesce("article", F.array_join(kept, "\n"), F.lit(""))
    return parsed.join(verdicts, "uid", "left").select(
        F.col("id").cast(kind).alias("page_id"), "url", text.alias("text"))
