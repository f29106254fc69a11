"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source lies on a line of words in a seeded order. Its target is cut into a quota of equal
blocks. The quotas of all sources are split down a binary tree over the output shards: the left
half of a node's shards gets a multivariate-hypergeometric draw of the node's blocks. A shard
thus gets an exact number of blocks, disjoint from those of the others. Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.columns import let, replace, words
from skyledger.session import materialize

WEIGHTS = (3, 1, 2)
SHARDS = 32
BLOCKS_PER_SHARD = 64
# Leading hex digits of the order key: a source has 16 ** 4 groups in 16 ** 2 chapters, however
# large it is, so the windows over groups and over chapters see 256 rows of a source at most.
CHAPTER_DIGITS = 2
GROUP_DIGITS = 4


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5,
                   cap: int = 2) -> DataFrame:
    """Target words per row of (source, source_size).

    Sources by code point, null last, weigh ``weights`` repeating. They share ``share`` of all
    words by weight; what exceeds ``cap`` times a source's words is shared again among the
    others. In the order of cap by weight the sources that stop come first, and the level that
    the rest reaches is the largest of the levels before each source.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    first_full = Window.orderBy(F.col("limit") / F.col("weight"), "number").rowsBetween(
        Window.unboundedPreceding, -1)
    level = (
        F.lit(share) * F.sum("source_size").over(every).cast("double")
        - F.coalesce(F.sum("limit").over(first_full), F.lit(0)).cast("double")
    ) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(first_full), F.lit(0))
    ).cast("double")
    return (
        sizes.select("source", "source_size", weight.alias("weight"),
                     F.row_number().over(by_name).alias("number"),
                     (F.col("source_size") * cap).alias("limit"))
        .select("*", level.alias("level"))
        .select("source", "source_size", "number",
                F.least(F.col("limit").cast("double"),
                        F.max("level").over(every) * F.col("weight")).alias("target"))
    )


# the tree ----------------------------------------------------------------------------------


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(2**53))


def hypergeometric(total: Column, marked: Column, drawn: Column, unit: Column) -> Column:
    """How many of ``drawn`` out of ``total`` blocks are ``marked`` ones, by inverting the
    distribution at ``unit``.

    Weights run from the mode outwards, as ratios to the mode's, so none overflows. A side is
    as long as the range or, if that is longer, 20 standard deviations.
    """

    def centre(v: Column) -> Column:
        low = F.greatest(F.lit(0).cast("long"), v["drawn"] + v["marked"] - v["total"])
        high = F.least(v["drawn"], v["marked"])
        middle = F.floor((v["drawn"] + 1).cast("double") * (v["marked"] + 1).cast("double")
                         / (v["total"] + 2).cast("double"))
        return F.struct(
            *[v[name].alias(name) for name in ("total", "marked", "drawn", "unit")],
            low.alias("low"), high.alias("high"),
            F.least(high, F.greatest(low, middle)).alias("mode"),
            # the deviation is at most half the root of the draws
            (F.ceil(F.sqrt(v["drawn"].cast("double"))) * 10 + 40).alias("most"),
        )

    def invert(v: Column) -> Column:
        up = F.least(v["high"] - v["mode"], v["most"])
        down = F.least(v["mode"] - v["low"], v["most"])
        steps = F.sequence(F.lit(0).cast("long"), up + down)

        def at(step: Column) -> Column:
            """The mode, the numbers above it, then those below it."""
            return F.when(step <= up, v["mode"] + step).otherwise(v["mode"] - (step - up))

        def weight(inner: Column, step: Column) -> Column:
            k = at(step).cast("double")
            spare = v["total"] - v["marked"] - v["drawn"] + k
            rise = (v["marked"] - k + 1) * (v["drawn"] - k + 1) / (k * spare)
            fall = (k + 1) * (spare + 1) / ((v["marked"] - k) * (v["drawn"] - k))
            return (
                F.when(step == 0, 1.0).when(step <= up, inner * rise)
                .when(step == up + 1, fall).otherwise(inner * fall)
            )

        def add(acc: Column, step: Column) -> Column:
            return let(weight(acc["w"], step),
                       lambda w: F.struct(w.alias("w"), (acc["z"] + w).alias("z")))

        def pick(goal: Column):
            def visit(acc: Column, step: Column) -> Column:
                return let(weight(acc["w"], step), lambda w: F.struct(
                    w.alias("w"), (acc["z"] + w).alias("z"),
                    F.coalesce(acc["k"], F.when(acc["z"] + w > goal, at(step))).alias("k")))
            return visit

        begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("z"))
        seek = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("z"),
                        F.lit(None).cast("long").alias("k"))
        whole = F.aggregate(steps, begin, add, lambda acc: acc["z"])
        return let(v["unit"] * whole, lambda goal: F.aggregate(
            steps, seek, pick(goal), lambda acc: F.coalesce(acc["k"], v["mode"])))

    given = F.struct(total.alias("total"), marked.alias("marked"), drawn.alias("drawn"),
                     unit.alias("unit"))
    return let(let(given, centre), invert)


def _split(frame: DataFrame, seed: int) -> DataFrame:
    """One level of the tree: every node of several shards becomes its two halves."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("long")
    want = (middle - F.col("low")) * F.col("each")
    zero = F.lit(0).cast("long")
    start = F.struct(
        F.aggregate("quotas", zero, lambda a, q: a + q).alias("total"), want.alias("want"),
        F.array().cast("array<long>").alias("got"),
    )

    def draw(acc: Column, quota: Column) -> Column:
        unit = _unit(F.lit(seed), F.col("low"), F.col("high"), F.size(acc["got"]))
        got = F.when((quota == 0) | (acc["want"] == 0), zero).otherwise(
            hypergeometric(acc["total"], quota, acc["want"], unit))
        return let(got, lambda g: F.struct(
            (acc["total"] - quota).alias("total"), (acc["want"] - g).alias("want"),
            F.concat(acc["got"], F.array(g)).alias("got"),
        ))

    left = F.when(F.col("high") - F.col("low") > 1,
                  F.aggregate("quotas", start, draw, lambda acc: acc["got"]))
    parted = frame.select("*", left.alias("left"), middle.alias("middle"))

    def node(low: Column, high: Column, quotas: Column) -> Column:
        return F.struct(low.alias("low"), high.alias("high"), quotas.alias("quotas"))

    halves = F.when(F.col("left").isNull(),
                    F.array(node(F.col("low"), F.col("high"), F.col("quotas")))).otherwise(
        F.array(
            node(F.col("low"), F.col("middle"), F.col("left")),
            node(F.col("middle"), F.col("high"),
                 F.zip_with("quotas", "left", lambda q, g: q - g)),
        ))
    return parted.select("each", F.explode(halves).alias("n")).select(
        "each", "n.low", "n.high", "n.quotas")


def shard_quotas(sources: DataFrame, shards: int, blocks_per_shard: int, seed: int) -> DataFrame:
    """The rows of (source, target, ...) with ``quota`` blocks and ``cuts``.

    ``cuts[k]`` is the number of the source's blocks that shards 0 to k hold. Every source with
    words to take has a block at least; the sum of the quotas is a multiple of the shards.
    """
    every = Window.partitionBy()
    words_due = F.floor("target").cast("long")
    counted = (
        sources.withColumn("due", words_due)
        .withColumn("each", F.greatest(
            F.lit(blocks_per_shard).cast("long"),
            F.ceil(F.sum(F.lit(1)).over(every) / F.lit(shards)).cast("long")))
        .withColumn("open", F.sum((F.col("due") > 0).cast("long")).over(every))
        .withColumn("part", F.when(F.col("due") > 0, (F.col("each") * shards - F.col("open"))
                                   * F.col("due").cast("double")
                                   / F.sum("due").over(every).cast("double")))
    )
    by_rest = Window.orderBy((F.col("part") - F.floor("part")).desc_nulls_last(), "number")
    whole = F.when(F.col("due") > 0, F.floor("part").cast("long") + 1).otherwise(F.lit(0))
    spare = F.col("each") * shards - F.sum(whole).over(every)
    quotas = materialize(
        counted.select("*", whole.alias("whole"), spare.alias("spare"),
                       F.row_number().over(by_rest).alias("place"))
        .withColumn("quota", F.when(F.col("due") > 0, F.col("whole")
                                    + (F.col("place") <= F.col("spare")).cast("long"))
                    .otherwise(F.lit(0)).cast("long"))
        .drop("whole", "spare", "place", "part", "open")
    )
    tree = quotas.groupBy("each").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("number", "quota"))),
                    lambda s: s["quota"]).alias("quotas")
    ).select("each", F.lit(0).cast("long").alias("low"),
             F.lit(shards).cast("long").alias("high"), "quotas")
    for _ in range(max(0, shards - 1).bit_length()):
        tree = materialize(_split(tree, seed))
    cuts = (
        tree.select("low", F.posexplode("quotas").alias("at", "blocks"))
        .groupBy("at")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("low", "blocks"))),
                         lambda s: s["blocks"]).alias("parts"))
        .select((F.col("at") + 1).alias("number"), F.transform(
            F.sequence(F.lit(1), F.size("parts")),
            lambda k: F.aggregate(F.slice("parts", 1, k), F.lit(0).cast("long"),
                                  lambda a, b: a + b)).alias("cuts"))
    )
    return materialize(quotas.join(cuts, "number").drop("number", "each"))


# the mix -----------------------------------------------------------------------------------


def _group_starts(groups: DataFrame) -> DataFrame:
    """Where each group begins on its source's line of words."""

    def before(*keys: str, by: str) -> Column:
        window = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("words").over(window), F.lit(0))

    chapters = groups.groupBy("source", "chapter").agg(F.sum("words").alias("words")).select(
        F.col("source").alias("of"), F.col("chapter").alias("in_chapter"),
        before("source", by="chapter").alias("chapter_start"))
    return groups.withColumn("inner", before("source", "chapter", by="group")).join(
        chapters, F.col("source").eqNullSafe(F.col("of"))
        & (F.col("chapter") == F.col("in_chapter")),
    ).select("source", "group", (F.col("chapter_start") + F.col("inner")).alias("group_start"))


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = 1.5,
    cap: int = 2,
    shards: int = SHARDS,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    seed: int = 7,
) -> DataFrame:
    """What a mix at the target weights takes of every document.

    Returns the columns of ``df`` with ``size`` (words), ``source_size``, ``target`` (words of
    the source), and ``draws``: an array of (pass, block, shard, start, words), the runs of the
    document's words that each shard takes; a run of a later pass repeats words. Result columns
    replace input columns of the same name.

    A source gives floor(target) words: all its documents as often as they fit, then the first
    of its seeded order, of which at most one is taken in part. The order is that of the MD5 of
    seed, id and text, so it depends on no partitioning. A null text has no words and no draws;
    null sources are one source; rows that are alike in id and text are taken in any order;
    a source without words and an empty table give no draws.
    """
    spark = df.sparkSession
    order = F.md5(F.concat_ws("|", F.lit(str(seed)),
                              F.coalesce(F.col(f"row.{id_col}").cast("string"), F.lit("")),
                              F.coalesce(F.col(f"row.{text_col}"), F.lit(""))))
    placed = (
        df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
        .select("row", F.col(f"row.{source_col}").alias("source"),
                F.size(words(F.col(f"row.{text_col}"))).cast("long").alias("size"),
                order.alias("order"))
        .withColumn("group", F.substring("order", 1, GROUP_DIGITS))
        # a key without nulls, so that the join below finds the rows where the window left them
        .withColumns({"has_source": F.col("source").isNotNull(),
                      "name": F.coalesce(F.col("source").cast("string"), F.lit(""))})
    )
    groups = materialize(
        placed.groupBy("source", F.substring("group", 1, CHAPTER_DIGITS).alias("chapter"),
                       "group").agg(F.sum("size").alias("words"))
    )
    starts = _group_starts(groups)
    sizes = groups.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, share, cap))
    plan = shard_quotas(targets, shards, blocks_per_shard, seed)
    # Small groups' starts and the plan, keyed by source and group: a hot source is many keys.
    starts = materialize(starts.join(
        plan.select(F.col("source").alias("of"), "source_size", "target", "due", "quota", "cuts"),
        F.col("source").eqNullSafe(F.col("of")),
    ).drop("of", "cuts", "quota").select(
        F.col("source").isNotNull().alias("has_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"), "group",
        "group_start", "source_size", "target", "due"))
    key = ["has_source", "name", "group"]
    inner = Window.partitionBy(*key).orderBy("order", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    lined = (
        placed.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
        .join(starts, key)
        .withColumn("at", F.col("group_start") + F.col("inner"))
        .drop(*key, "group_start", "inner", "order")
        .join(plan.select(F.col("source").alias("of"), "quota", "cuts"),
              F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
    )
    drawn = lined.withColumn("draws", _draws(seed))
    result = {name: F.col(name) for name in ("size", "source_size", "target", "draws")}
    kept = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in result]
    return drawn.select(*kept, *result.values())


def _draws(seed: int) -> Column:
    """Runs of words per block that a document meets on its source's line of ``due`` words."""
    due, quota, size = F.col("due"), F.col("quota"), F.col("size")

    def block_of(word: Column) -> Column:
        return F.floor(((word + 1) * quota - 1) / due).cast("long")

    def edge(block: Column) -> Column:
        return F.floor(block * due / quota).cast("long")

    def run(turn: Column, begin: Column, end: Column, block: Column) -> Column:
        start = F.greatest(begin, edge(block))
        stop = F.least(end, edge(block + 1))
        permuted = (block * F.lit(2**31 - 1) + F.lit(seed)) % quota
        shard = F.size(F.filter("cuts", lambda c: c <= permuted))
        return F.struct(
            turn.cast("int").alias("pass"), block.alias("block"), shard.alias("shard"),
            (start - begin).alias("start"), (stop - start).alias("words"),
        )

    def turn_runs(turn: Column) -> Column:
        begin = F.col("at") + turn * F.col("source_size")
        end = F.least(begin + size, due)
        blocks = F.sequence(block_of(begin), block_of(end - 1))
        runs = F.transform(blocks, lambda b: run(turn, begin, end, b))
        return F.when(end > begin, F.filter(runs, lambda r: r["words"] > 0)).otherwise(
            F.array().cast("array<struct<pass:int,block:bigint,shard:int,start:bigint,"
                           "words:bigint>>"))

    turns = F.floor((due - 1) / F.col("source_size"))
    return F.when(
        (size > 0) & (due > 0),
        F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), turns), turn_runs)),
    ).otherwise(F.array().cast("array<struct<pass:int,block:bigint,shard:int,start:bigint,"
                               "words:bigint>>"))


def taken(draws: Column) -> Column:
    """Words that the mix takes, repeats counted."""
    return F.aggregate(draws, F.lit(0).cast("long"), lambda a, d: a + d["words"])


def mixed_documents(mixed: DataFrame, text_col: str = "text", seed: int = 7) -> DataFrame:
    """One row per document and pass, whole or, for the last of a source, its first words.

    A whole document keeps its text; one taken in part is its words joined by a space. A row
    lies in the shard that drew the block of its first word. The rows are ranges of the shards in
    order, inside a shard shuffled by ``seed``; a hot shard is cut into as many as it takes.
    """

    def run(number: Column) -> Column:
        runs = F.filter("draws", lambda d: d["pass"] == number)
        return F.struct(number.alias("pass"), F.get(runs, 0)["shard"].alias("shard"),
                        F.get(runs, 0)["block"].alias("block"), taken(runs).alias("words"))

    passes = F.transform(F.array_distinct(F.transform("draws", lambda d: d["pass"])), run)
    columns = [c for c in mixed.columns if c not in ("source_size", "target", "draws", "size")]
    text = F.col(f"row.`{text_col}`")
    place = F.xxhash64(F.lit(seed), "run.block", "run.pass", text)
    rows = (
        mixed.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "size",
                     F.explode(passes).alias("run"))
        .select("row", "size", "run.words", F.col("run.shard").alias("shard"),
                place.alias("place"))
        .repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    )
    cut = F.array_join(F.slice(words(text), 1, F.col("words").cast("int")), " ")
    whole = F.when(F.col("words") == F.col("size"), text).otherwise(cut)
    return rows.select(*[
        (whole if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in columns])


def shard_rows(mixed: DataFrame, text_col: str = "text", seed: int = 7) -> DataFrame:
    """The mix itself: one row per run, its words, its shard and its place in a local shuffle.

    Rows are dealt by shard and a salt and sorted by a seeded hash; writing them partitioned by
    shard leaves every file shuffled, and no task holds more than an eighth of a shard.
    """
    salt = F.pmod(F.xxhash64(F.lit(seed), "draw.block", "draw.pass"), F.lit(8))
    rows = mixed.select("*", F.explode("draws").alias("draw"))
    text = F.array_join(F.slice(words(F.col(text_col)), (F.col("draw.start") + 1).cast("int"),
                                F.col("draw.words").cast("int")), " ")
    out = replace(rows, {text_col: F.when(F.col("draw.words") == F.col("size"), F.col(text_col))
                         .otherwise(text), "shard": F.col("draw.shard")})
    place = F.xxhash64(F.lit(seed), "draw.block", "draw.pass", "draw.start", text_col)
    return (
        out.withColumn("place", place).repartition("shard", salt)
        .sortWithinPartitions("shard", "place").drop("draws", "draw")
    )
