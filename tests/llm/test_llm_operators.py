"""Operators against plain versions over the smallest tables."""

import os
import random
import struct
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import brute
import numpy as np
import pytest
from compare import ROOT, connect, spark_rows, sql_rows

from skyledger.llm import (
    cutting_stock, graph, licenses, line_dedup, mixing, ngram_join, page_diff, pairwise_quality,
    projection_dedup, queries, sharding, weak_rules,
)
from skyledger.llm.columns import table

DIR = f"{ROOT}/{os.environ.get('TEST_SF', 'sf0.001')}"

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DIR, "documents").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    columns, found = spark_rows(queries.QUERIES[name](spark, DIR))
    sql_columns, expected = sql_rows(connect(DIR), queries.ORACLE[name])
    assert columns == sql_columns
    assert list(map(repr, found)) == list(map(repr, expected))


@pytest.mark.parametrize("name", ["op2_quality_rules", "op6_mixing", "op8_sharding"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, DIR)._jdf.queryExecution().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct"):
        assert bad not in plan


# licenses ----------------------------------------------------------------------------------


def test_licenses(spark, texts):
    found = {r[0]: r[1:] for r in rows(queries.license_scan(spark, DIR))}
    for i, text in texts.items():
        expected = brute.base_licenses(text)
        assert found[i][:5] == expected
        assert set(expected[4].split(",")) <= {*found[i][5].split(","), ""}
        assert (found[i][6] >= 0.9) if expected[1] else 0 <= found[i][6] <= 1


def test_rule_order_and_suppression():
    scanner = licenses.Scanner(licenses.build_rules())
    assert len(scanner.rules) > 200
    out = scanner.scan("Code under the GNU General Public License version 2.1 or (at your "
                       "option) any later version. Docs: CC BY-NC 4.0; SPDX-License-Identifier: MIT")
    labels = out["labels"].split(",")
    assert "cc-by-nc" in labels and "cc-by-nc-4.0" in labels and "mit" in labels
    assert "gpl" not in labels and "cc-by" not in labels
    assert scanner.scan("Released under the terms of the Apache License, Version 2.0")[
        "labels"] == "apache-2"
    # one detection inside another of an earlier rule goes; one that only overlaps stays
    assert licenses.suppress([(5, 2, 8), (1, 0, 9), (7, 8, 12)]) == [(1, 0, 9), (7, 8, 12)]


def test_suppression_equals_all_pairs():
    rng = random.Random(1)
    for _ in range(50):
        found = [(rng.randrange(6), a, a + rng.randrange(1, 9))
                 for a in (rng.randrange(30) for _ in range(25))]
        rank = sorted(set(found), key=lambda d: (d[0], d[1] - d[2], d[1]))
        expected = [
            d for k, d in enumerate(rank)
            if not any(o[1] <= d[1] and o[2] >= d[2] for o in rank[:k])
        ]
        assert sorted(set(licenses.suppress(found))) == sorted(expected)


# quality -----------------------------------------------------------------------------------


def test_rule_counters(docs, texts):
    found = {r["doc_id"]: r for r in weak_rules.score_rules(docs).collect()}
    for i, text in texts.items():
        r, expected = found[i], brute.quality_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                r["n_repeat_words"]) == expected
        assert r["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r["base_failed"] and r["kept"])


def test_rules_equal_plain_em(spark):
    """The same EM in numpy over patterns of three rules."""
    rng = np.random.default_rng(3)
    counts = Counter(tuple(rng.choice([-1, 0, 1, 1, 1], 3).tolist()) for _ in range(400))
    patterns = spark.createDataFrame([(list(v), n) for v, n in counts.items()],
                                     "v array<int>, n long")
    got = weak_rules.fit(patterns, 3, rounds=6)
    votes, n = np.array(list(counts)), np.array(list(counts.values()))
    begin = params = weak_rules.first_guess(3)
    for _ in range(6):
        joint = np.array([
            share * np.prod(np.where(votes == -1, rates, np.where(votes == 1, 1 - np.array(rates), 1)),
                            axis=1) for share, rates in params])
        mass = joint / joint.sum(axis=0) * n
        params = []
        for c, (share, guesses) in enumerate(begin):
            bad, good = (mass[c] @ (votes == v) for v in (-1, 1))
            rate = (bad + weak_rules.SMOOTHING * np.array(guesses)) / (
                bad + good + weak_rules.SMOOTHING)
            low = np.full(3, 0.0005)
            if c:
                low[c - 1] = weak_rules.OWN_ALARMS
            high = weak_rules.FALSE_ALARMS if c == 0 else 0.9995
            params.append((float((mass[c].sum() + weak_rules.SMOOTHING * share)
                                 / (n.sum() + weak_rules.SMOOTHING)),
                           np.clip(rate, low, high).tolist()))
    for (share, rates), (want, expected) in zip(got, params, strict=True):
        assert share == pytest.approx(want) and rates == pytest.approx(expected)


def test_rules_keep_good_documents(spark, docs):
    labels = table(spark, DIR, "labels")
    out = weak_rules.score_rules(docs).join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in out if r["quality"] == 1]
    assert sum(good) >= 0.98 * len(good)


def test_classifier_held_out(spark):
    sf = f"{ROOT}/sf0.01"
    out = queries.quality_classifier(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    held = [r for r in out.collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    right = sum(r["predicted"] == r["quality"] for r in held)
    assert right >= 0.95 * len(held)


def test_classifier_prefers_good():
    import pandas as pd

    rng = np.random.default_rng(1)
    values = rng.normal(size=(400, len(pairwise_quality.MEASURES)))
    data = pd.DataFrame(values, columns=pairwise_quality.MEASURES)
    data["quality"] = (values[:, 0] + values[:, 3] > -1).astype(int)
    model = pairwise_quality.learn(data, 4000, 10)
    worth = pairwise_quality._bins(values, model["edges"]) @ model["weights"]
    good, bad = worth[data["quality"] == 1], worth[data["quality"] == 0]
    assert (good[:, None] > bad[None, :]).mean() > 0.97


def test_classifier_cut_is_that_of_all_labelled_rows(spark):
    """However few rows are learned from, the cut is the exact quantile over all of them."""
    sf = f"{ROOT}/sf0.01"
    labels = table(spark, sf, "labels")
    scored = pairwise_quality.score_quality(table(spark, sf, "documents"), labels, sample=60)
    known = scored.join(labels, "doc_id").where("not held_out").collect()
    bad = sum(r["quality"] == 0 for r in known)
    assert 0 < bad < len(known)
    assert sum(r["predicted"] == 0 for r in known) in (bad - 1, bad, bad + 1)


@pytest.mark.parametrize("values", [
    [1.0], [2.0] * 50, [float(i % 7) for i in range(3000)], [i ** 0.5 for i in range(2500)],
    [1e-9 * i for i in range(500)] + [1e9]])
def test_value_of_a_rank(spark, monkeypatch, values):
    from pyspark.sql import functions as F

    monkeypatch.setattr(pairwise_quality, "RANK_VALUES", 10)
    monkeypatch.setattr(pairwise_quality, "RANK_BINS", 8)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for rank in {0, len(values) // 3, len(values) - 1}:
        assert pairwise_quality.value_at(df, F.col("x"), rank) == sorted(values)[rank]


def test_scores_equal_plain(spark):
    """Measures and the score column against Python over the same learned model."""
    sf = f"{ROOT}/sf0.001"
    docs = table(spark, sf, "documents")
    measured = pairwise_quality.measures(docs, "doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = pairwise_quality.learn(
        pairwise_quality.known_rows(measured, table(spark, sf, "labels")).toPandas(), 2000, 5)
    found = measured.select("*", pairwise_quality.worth(model).alias("w")).collect()
    for r in found:
        own = pairwise_quality.measure(texts[r["doc_id"]])
        assert [r[name] for name in pairwise_quality.MEASURES] == own
        steps = [(v > e) for v, edges in zip(own, model["edges"], strict=True) for e in edges]
        assert r["w"] == pytest.approx(sum(w for w, s in zip(
            model["weights"], steps, strict=True) if s))


# packing -----------------------------------------------------------------------------------


def test_packing_round_trip(docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in cutting_stock.pack(docs).collect():
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            part = ids[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(length for pieces in by_sequence.values() for _, length in pieces)
    assert 1 - total / 1024 / len(by_sequence) < 0.02


@pytest.mark.parametrize("demand", [
    {}, {600: 50}, {1023: 3, 1: 3}, {600: 100, 300: 7, 10: 30}, {k: k % 7 + 1 for k in range(1, 1024)},
])
def test_plan_places_every_rest_once(demand):
    plan = cutting_stock.make_plan(demand, 1024)
    filled = defaultdict(list)
    for rest, n in demand.items():
        for rank in range(n):
            pieces = plan.place(rest, rank)
            assert sum(size for _, size, _, _ in pieces) == rest
            for _, size, sequence, offset in pieces:
                filled[sequence].append((offset, size))
    for pieces in filled.values():
        pieces.sort()
        assert pieces[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in pairwise(pieces))
    tokens = sum(rest * n for rest, n in demand.items())
    assert len(filled) == plan.sequences <= tokens / 1024 * 1.009 + 1


def test_program_meets_demand_near_its_bound():
    demand = {400: 30, 330: 45, 290: 60, 120: 20, 610: 12}
    columns = cutting_stock.solve(demand, 1024)
    for rest, n in demand.items():
        assert sum(x * p.get(rest, 0) for p, x in columns) >= n - 1e-6
    assert all(sum(k * n for k, n in p.items()) <= 1024 for p, _ in columns)
    # 290 + 330 + 400 and 610 + 290 + 120 fill a sequence; the optimum is near the tokens' bound
    assert sum(x for _, x in columns) <= 1.05 * sum(k * n for k, n in demand.items()) / 1024


def test_pricing_lowers_the_number_of_sequences():
    rng = random.Random(9)
    for tries in range(5):
        demand = {rng.randrange(200, 600): rng.randrange(1, 60) for _ in range(150)}
        columns = cutting_stock.solve(demand, 1024)
        start = cutting_stock.solve(demand, 1024, price=False)
        assert sum(x for _, x in columns) < 0.998 * sum(x for _, x in start), tries
        for found in (columns, start):
            for rest, n in demand.items():
                assert sum(x * p.get(rest, 0) for p, x in found) >= n - 1e-6
    assert cutting_stock.solve({}, 1024) == []
    assert cutting_stock.solve({512: 7}, 1024)[0][0] == {512: 2}


# joins -------------------------------------------------------------------------------------


def near_copies(texts, seed=4):
    rng = random.Random(seed)
    out = dict(texts)
    number = max(out) + 1
    for text in rng.sample([t for t in texts.values() if t and len(t) > 400], 12):
        for _ in range(rng.choice([1, 2, 30])):
            own = text.split(" ")
            for _ in range(rng.randrange(len(own) // 100 + 2)):
                own[rng.randrange(len(own))] = f"new{rng.randrange(99)}"
            out[number] = " ".join(own)
            number += 1
    return out


@pytest.mark.parametrize("block", [1000, 7])
def test_join_equals_all_pairs(spark, texts, block):
    texts = near_copies(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = ngram_join.join_ngrams(df, block_texts=block).collect()
    expected = brute.joined(texts.items())
    assert {r["doc_id"]: (r["n_links"], r["class_id"]) for r in found} == expected
    assert sum(n for n, _ in expected.values()) > 300


@pytest.mark.parametrize("block_bytes", [600, 2000])
def test_join_bounds_the_bytes_of_a_group(spark, texts, monkeypatch, block_bytes):
    texts = near_copies(dict(list(texts.items())[:100]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    groups = spark.sparkContext.accumulator(0)
    plain = ngram_join._bucket_links

    def watched(group, similarity):
        held = sum(map(len, group["grams"]))
        # hashes deal texts to blocks, so some blocks are larger than the mean
        if held > 16 * block_bytes or max(map(len, group["grams"])) > 1.5 * block_bytes + 200:
            groups.add(1)
        return plain(group, similarity)

    monkeypatch.setattr(ngram_join, "_bucket_links", watched)
    found = ngram_join.join_ngrams(df, block_bytes=block_bytes).collect()
    expected = brute.joined(texts.items())
    assert {r["doc_id"]: (r["n_links"], r["class_id"]) for r in found} == expected
    assert groups.value == 0


def test_overlaps_of_ranges_add_up(monkeypatch):
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 2**64, 300, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, size)) for size in rng.integers(1, 200, 20)]
    first, second = np.triu_indices(len(sets), 1)
    whole = [len(set(sets[a].tolist()) & set(sets[b].tolist()))
             for a, b in zip(first, second, strict=True)]
    monkeypatch.setattr(ngram_join, "AT_ONCE", 50)
    assert ngram_join._overlaps(sets, first, second).tolist() == whole


def test_one_row_of_each_group(spark):
    a, b, c, d = ([f"{name}{k}" for k in range(60)] for name in "abcd")
    near = [*b[:-1], "other"]
    rows = [
        (5, a), (9, a), (2, b), (5, b),  # id 5 stands for two texts
        (7, c), (7, c), (7, c),  # loaded again
        (None, d), (None, d), (None, near),  # null ids
        (20, []), (20, []), (None, []),  # no words, no links
    ]
    df = spark.createDataFrame(
        [(i, " ".join(text), k) for k, (i, text) in enumerate(rows)],
        "doc_id long, text string, uid long").repartition(3)
    one = ngram_join.one_of_each(df)
    assert one.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in one.collect()]
    assert sorted(kept, key=repr) == sorted(
        [(i, " ".join(text)) for i, text in (
            (5, a), (2, b), (7, c), (None, d), (20, []), (20, []), (None, []))], key=repr)
    out = Counter((r["doc_id"], r["copy_id"], r["n_links"], r["class_id"])
                  for r in ngram_join.join_ngrams(df).collect())
    assert out == {
        (5, 5, 1, 5): 1, (9, 5, 1, 5): 1, (2, 2, 2, 2): 1, (5, 2, 2, 2): 1, (7, 7, 2, 7): 3,
        (None, None, 1, None): 2, (None, None, 2, 2): 1, (20, 20, 0, 20): 2,
        (None, None, 0, None): 1}


@pytest.mark.parametrize("join", [ngram_join.join_ngrams, ngram_join.one_of_each])
def test_join_makes_rows_of_all_bands_once(spark, texts, monkeypatch, join):
    plans = []
    plain = ngram_join.materialize

    def watched(df, *args, **kw):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, *args, **kw)

    monkeypatch.setattr(ngram_join, "materialize", watched)
    texts = near_copies(dict(list(texts.items())[:50]))
    join(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert sum("posexplode" in plan for plan in plans) == 1


def test_texts_that_meet_no_other_are_left_out(spark):
    rows = [(1, 8, [5, 6]), (2, 16, [5, 7]), (3, 8, [6, 5]), (4, 8, [5, 7])]
    classes = spark.createDataFrame(rows, "uid long, bytes long, bands array<long>")
    met = ngram_join._met(classes).select("band", "hash", "uid", "bytes").collect()
    met = sorted(map(tuple, met))
    assert met == [(0, 5, 1, 8), (0, 5, 2, 16), (0, 5, 4, 8), (1, 7, 2, 16), (1, 7, 4, 8)]
    buckets = ngram_join._buckets(ngram_join._met(classes), 10).collect()
    assert sorted((b["band"], b["hash"], b["n"], b["bytes"], b["most"]) for b in buckets) == [
        (0, 5, 3, 26, 16), (1, 7, 2, 18, 16)]


def test_bands_reach_recall():
    bands = ngram_join.bands_for(0.8, 0.999999, 5)
    assert 1 - (1 - 0.8**5) ** bands >= 0.999999 > 1 - (1 - 0.8**5) ** (bands - 1)


def test_grams_do_not_depend_on_slices(monkeypatch):
    own = ngram_join.split("a b c d e f g a b c d e f " * 40)
    whole = ngram_join.Grams(5).of(own)
    monkeypatch.setattr(ngram_join, "SLICE", 7)
    assert (ngram_join.Grams(5).of(own) == whole).all()
    assert len(whole) == len(brute.grams("a b c d e f g a b c d e f " * 40))


def test_components(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    nodes = {x for link in links for x in link if link[0] != link[1]}
    found = dict(rows(graph.components(spark.createDataFrame(links, "a long, b long"))))
    assert found == brute.components(nodes, [k for k in links if k[0] != k[1]])


@pytest.mark.parametrize("block", [1000, 9])
def test_vectors_equal_all_pairs(spark, block):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 16))
    x = np.concatenate([x, x[:60] + rng.normal(scale=0.25, size=(60, 16)), x[:5], 3 * x[5:9]])
    label = np.concatenate([np.arange(150) % 3, np.arange(60) % 3, np.arange(5) % 3,
                            np.arange(5, 9) % 3])
    df = spark.createDataFrame(
        [(k, v.tolist(), int(c)) for k, (v, c) in enumerate(zip(x, label, strict=True))],
        "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True)]
    number, parts = Counter(k for link in links for k in link), brute.components(
        range(len(x)), links)
    found = {r["vec_id"]: tuple(r)[1:] for r in
             projection_dedup.dedup_vectors(df, block=block).collect()}
    assert found == {k: (number[k], parts[k], parts[k] == k) for k in range(len(x))}
    assert len(links) > 40


def test_collisions_reach_recall():
    half, need = projection_dedup.calibrate(0.93, 0.999, 32, 2.0)
    rng = np.random.default_rng(8)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    directions = rng.normal(size=(64, 32))
    hits = (np.abs(a @ directions - b @ directions) <= half).sum(axis=1)
    assert (hits >= need).mean() > 0.995


# lines, mixing, shards ---------------------------------------------------------------------


@pytest.mark.parametrize("index_bytes", [1 << 26, 0])
def test_lines_equal_plain(spark, texts, index_bytes):
    common = [f"a line that many of the documents hold, number {k} of some" for k in range(9)]
    rng = random.Random(3)
    texts = {i: "\n".join([t or "", *rng.sample(common, 4), "  " + rng.choice(common).upper()])
             for i, t in texts.items()}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = line_dedup.dedup_lines(df, index_bytes=index_bytes, keys_per_shard=3)
    found = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()}
    assert found == brute.deduped(texts.items())


@pytest.mark.parametrize("index_bytes", [1 << 26, 4 * line_dedup.KEY_BYTES, 0])
def test_lines_of_any_frequency_equal_plain(spark, index_bytes):
    """One line in most documents, many in a few; ids that repeat and rows without one."""
    rng = random.Random(5)
    often = "a line that nearly every document of the table holds somewhere"
    common = [f"a line that some of the documents hold, number {k} of all" for k in range(60)]
    data = [(i // 2 if i < 40 else i, "\n".join(
        [f"own line {i} which is also longer than forty characters", *rng.sample(common, 5),
         *[often] * (i % 7 > 0)])) for i in range(200)]
    data += [(None, "\n".join([often, line])) for line in common for _ in range(3)]
    out = line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string"),
                                 index_bytes=index_bytes, keys_per_shard=7)
    lowest = -(2**63)
    held = defaultdict(list)
    for i, text in data:
        for line in set(text.split("\n")):
            held[line].append(lowest if i is None else i)
    expected = []
    for i, text in data:
        kept = [line for line in text.split("\n") if len(held[line]) < 5
                or max(held[line]) == (lowest if i is None else i)]
        expected.append((i, "\n".join(kept)))
    found = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_perfect_hash():
    rng = np.random.default_rng(4)
    first = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    first[:50] = first[50:100]
    second = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    slots = line_dedup.PerfectHash(first, second).slots(first, second)
    assert sorted(slots) == list(range(5000))
    shard = line_dedup.Shard.load(
        line_dedup.Shard(first, second, np.arange(5000) + 5, np.arange(5000)).dump())
    count, last = shard.probe(first, second)
    assert (count == np.arange(5000) + 5).all() and (last == np.arange(5000)).all()
    assert (shard.probe(second, first)[0] == 0).all()


def test_mix_draws(spark, docs):
    mixed = mixing.mix(docs, shards=5, blocks_per_shard=8).collect()
    words, blocks = Counter(), defaultdict(set)
    for r in mixed:
        seen = Counter()
        for d in r["draws"]:
            assert 0 <= d["start"] and d["start"] + d["words"] <= r["size"] and d["words"] > 0
            seen[d["pass"]] += d["words"]
            words[d["shard"]] += d["words"]
            blocks[d["shard"]].add((r["source"], d["block"]))
        assert sum(seen.values()) <= 2 * r["size"]
        assert all(n <= r["size"] for n in seen.values())
    due = {r["source"]: int(r["target"]) for r in mixed}
    taken = Counter()
    for r in mixed:
        taken[r["source"]] += sum(d["words"] for d in r["draws"])
    assert {s: taken[s] for s in due} == due
    # disjoint blocks, equally many in each shard
    sizes = [len(b) for b in blocks.values()]
    assert len(blocks) == 5 and max(sizes) == min(sizes)
    assert sum(sizes) == len(set().union(*blocks.values()))
    assert max(words.values()) < 1.25 * min(words.values())


def test_hypergeometric_draws(spark):
    from pyspark.sql import functions as F

    n = 4000
    column = mixing.hypergeometric(
        F.lit(50).cast("long"), F.lit(20).cast("long"), F.lit(15).cast("long"),
        (F.col("id") + 0.5) / n)
    found = Counter(r[0] for r in spark.range(n).select(column).collect())
    from math import comb

    for k in range(16):
        expected = n * comb(20, k) * comb(30, 15 - k) / comb(50, 15) if 15 - k <= 30 else 0
        assert abs(found[k] - expected) <= 2


def test_mixed_rows(docs):
    mixed = mixing.mix(docs)
    words = sum(len(brute.words(r["text"])) for r in mixing.mixed_documents(mixed).collect())
    assert words == mixed.selectExpr(
        "aggregate(draws, 0L, (a, d) -> a + d.words) as n").groupBy().sum("n").first()[0]
    shards = mixing.shard_rows(mixed).collect()
    assert sum(len(brute.words(r["text"])) for r in shards) == words


def test_mixed_rows_lie_by_shard(docs):
    """The order of the rows is that of the shards which the tree gave the blocks to."""
    orders = []
    for seed in (7, 8):
        mixed = mixing.mix(docs, shards=5, blocks_per_shard=8, seed=seed)
        of = defaultdict(list)
        for r in mixed.collect():
            first = {}
            for d in r["draws"]:
                first.setdefault(d["pass"], d["shard"])
            of[r["doc_id"]] = sorted(first.values())
        out = [r["doc_id"] for r in mixing.mixed_documents(mixed, seed=seed).collect()]
        assert Counter(out) == Counter({i: len(s) for i, s in of.items() if s})
        # rows of one pass have one shard; those do not descend
        once = [of[i][0] for i in out if len(of[i]) == 1]
        assert once == sorted(once) and set(once) == set(range(5))
        orders.append((out, of))
    # another seed, another shard for many documents; in a shard they are not in order of id
    assert orders[0][1] != orders[1][1]
    out, of = orders[0]
    ids = [i for i in out if of[i] == [0]]
    assert ids != sorted(ids)


def test_shards(docs, texts):
    out = sharding.shuffle_shards(docs, shards=7, bucket_bytes=20_000)
    slots = defaultdict(list)
    for r in out.collect():
        slots[r["shard"]].append(r["slot"])
        assert texts.pop(r["doc_id"]) == r["text"]
    assert not texts
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == 7 and max(sizes) - min(sizes) <= 1


# pages -------------------------------------------------------------------------------------


def test_pages_of_the_table(spark):
    import html
    import re

    for r in queries.html_extraction(spark, DIR).join(
            table(spark, DIR, "pages").select("page_id", "html"), "page_id").collect():
        body = r["html"].partition("<article>")[2].partition("</article>")[0]
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", part)).split())
                 for part in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n".join(filter(None, lines))
        assert r["n_chars"] == len(r["text"])


def test_shared_lines_without_an_article(spark):
    frame = "<div>Site name</div><div>All stories</div>{}<div>Read more here</div>"
    pages = [(k, f"http://h/news/{k}", frame.format(f"<p>Story {k}</p><p>It says {k}.</p>"))
             for k in range(4)]
    pages.append((9, "http://other/1", frame.format("<p>Alone</p>")))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in page_diff.extract_pages(df).collect()}
    assert [out[k] for k in range(4)] == [f"Story {k}\nIt says {k}." for k in range(4)]
    assert out[9].split("\n") == ["Site name", "All stories", "Alone", "Read more here"]


def test_copies_find_the_nearest_other_page(spark):
    frame = "<div>Site name</div>{}<div>Read more here</div>"
    same = frame.format("<p>Copied story</p>")
    pages = [(k, f"http://h/news/{k:02}", same) for k in range(1, 20)]
    pages += [(30 + k, "http://h/news/10", same) for k in range(5)]
    pages += [(0, "http://h/news/00", frame.format("<p>First</p>")),
              (90, "http://h/news/90", frame.format("<p>Last</p>")),
              # with no other page, copies show nothing
              (91, "http://i/1", same), (92, "http://i/1", same), (93, "http://i/2", same)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    out = {r["page_id"]: r["text"] for r in page_diff.extract_pages(df).collect()}
    assert out.pop(0) == "First" and out.pop(90) == "Last"
    assert {out.pop(k) for k in (91, 92, 93)} == {"Site name\nCopied story\nRead more here"}
    assert len(out) == 24 and set(out.values()) == {"Copied story"}


def test_alignment_in_pieces_is_the_same(monkeypatch):
    rng = random.Random(6)
    pairs = [[[rng.randrange(9) for _ in range(rng.randrange(40))] for _ in "ab"]
             for _ in range(200)]
    whole = [page_diff.shared_lines(a, b) for a, b in pairs]
    monkeypatch.setattr(page_diff, "TABLE_BITS", 10)
    monkeypatch.setattr(page_diff, "COLUMNS", 4)
    assert [page_diff.shared_lines(a, b) for a, b in pairs] == whole


def test_frames_by_markup():
    page = """<body><header><h1>Site</h1></header><main><nav>menu</nav><h1>Title</h1>
    <p>One&nbsp;two <b>three</b><p>Four<script>var p = "</p>";</script> five
    <div class="ad-box">buy</div><form>mail <input></form><ul><li>a<li>b</ul>
    <div id="comments"><p>nice</p></div></main><aside>side</aside><div class="cookie-notice">ok</div>"""
    lines = page_diff.page_lines(page)
    assert [line for state, line in lines if state == page_diff.INSIDE] == [
        "Title", "One two three", "Four five", "a", "b"]
    assert not [line for state, line in lines if state == page_diff.OUTSIDE]


def test_alignment_equals_dynamic_program():
    rng = random.Random(5)
    for _ in range(100):
        a = [rng.randrange(6) for _ in range(rng.randrange(14))]
        b = [rng.randrange(6) for _ in range(rng.randrange(14))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        flags = page_diff.shared_lines(a, b)
        shared = iter([x for x, f in zip(a, flags, strict=True) if f])
        assert sum(flags) == best[-1][-1]
        rest = iter(b)
        assert all(x in rest for x in shared)


def test_alignment_of_huge_pages(monkeypatch):
    """A table made in pieces gives the same subsequence as a whole one."""
    own, other = [1, 2, 90, 3, 3, 4, 91, 5], [1, 7, 3, 4, 3, 8, 5]
    whole = page_diff.shared_lines(own, other)
    assert [x for x, shared in zip(own, whole, strict=True) if shared] in ([1, 3, 4, 5], [1, 3, 3, 5])
    monkeypatch.setattr(page_diff, "TABLE_BITS", 10)
    assert page_diff.shared_lines(own, other) == whole


# limits and switches -----------------------------------------------------------------------


def test_few_words_are_seen_at_every_length(spark):
    """Random order of few words: bad by the share of distinct words, on both sides of a run."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    rows = [(n, " ".join(rng.choices(words, k=n))) for n in (1999, 2000, 2001, 2600, 9000)]
    rows += [(-n, " ".join(f"x{rng.randrange(10 ** 9)}" for _ in range(n))) for n in (2001, 9000)]
    out = weak_rules.score_rules(spark.createDataFrame(rows, "doc_id long, text string"))
    place = list(weak_rules.RULES).index("same_words")
    for r in out.collect():
        assert r["votes"][place] == (-1 if r["doc_id"] > 0 else 1)


def test_vectors_link_by_themselves(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, a, 0), (1, b, 0), (2, [1.0, 0.05, 0.0], 0), (3, [0.05, 1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = projection_dedup.dedup_vectors(df).select(
        "vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(tuple, out)) == [
        (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]


@pytest.mark.parametrize("size", [1e-310, 1e-200, 1.0, 1e200, 1.7e308])
def test_vectors_of_any_size(spark, size):
    rows = [(1, [size, 0.0], 0), (2, [size, size * 0.1], 0), (3, [0.0, size], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = projection_dedup.dedup_vectors(df).collect()
    assert {r["vec_id"]: r["component_id"] for r in out} == {1: 1, 2: 1, 3: 3}


def test_many_places_in_a_long_text_take_linear_time():
    import time

    scanner = licenses.Scanner(licenses.build_rules())
    text = "under the mit license and cc by nc of some more words here \n" * 20_000
    begin = time.perf_counter()
    found = scanner.scan(text)
    assert time.perf_counter() - begin < 20
    assert found["n_base"] == 40_000 and found["first_word"] == 0
    assert found["n_words"] == 13 * 20_000 and found["last_word"] == 13 * 19_999 + 5


def test_buckets_are_shuffled_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TASK_BYTES", 1000)
    df = spark.createDataFrame([(i, "x" * 90) for i in range(200)], "doc_id long, text string")
    out = sharding.shuffle_shards(df, shards=7, bucket_bytes=500).collect()
    counts = Counter(r["shard"] for r in out)
    assert sorted(counts) == list(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    assert sorted(r["doc_id"] for r in out) == list(range(200))


@pytest.mark.parametrize("source,text", [
    ("<head><meta charset=utf-8><title>T</title><body><article><p>One</p></article>", "One"),
    ("<html><head><title>T</title></head><p>Two</html>", "Two"),
    ('<main class="content with-sidebar"><nav>m</nav><article><p>Three</article></main>', "Three"),
    ('<div class="page has-sidebar"><main class="site-main no-comments">Four</main></div>', "Four"),
    ('<article><p>Five<p class="advert">Buy<p>Six<p id="comments">You<div>Seven</div></article>',
     "Five\nSix\nSeven"),
    ("<!--><article>Eight</article><!---><p>x</p><!-- y --!><p>z</p>", "Eight"),
    ('<div class="comments"><article>no</article></div><main><article class="comment">no</article>'
     "<p>Nine</main>", "Nine"),
    ('<article><p class="notice"><b>Cookies</b> here</p>Ten <!--<p>no</p>--> more</article>',
     "Ten more"),
])
def test_content_is_not_lost(spark, source, text):
    df = spark.createDataFrame([(1, "http://a.b/c", source)], "page_id long, url string, html string")
    assert page_diff.extract_pages(df).first()["text"] == text
