"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import pytest

from skyledger.llm import (
    cutting_stock, licenses, line_dedup, mixing, ngram_join, page_diff, pairwise_quality,
    projection_dedup, sharding, weak_rules,
)

# Columns that operators use inside or return.
CLASHES = ("id key row text2 size words lines label n_words n_lines shard slot draws target "
           "source_size uid part rank score kept").split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in CLASHES)
LONG = "lorem ipsum dolor sit amet " * 60_000
LINE = "a line of more than forty characters that is in many documents"
TEXTS = [
    (0, None, "a"), (1, "", "a"), (2, " \n\t\n ", None), (3, "one", None), (4, LONG, "b"),
    (5, LONG, "b"), (6, "five words are in it", "b"), (7, "five words are in it", None),
    (8, "é" * 200, "c"), (None, None, None), (None, "text without an id", "a"),
    (12, f"{LINE}\nx", "c"), (12, f"{LINE}\nx", "c"),
    *[(20 + k, f"{LINE}\nown {k}", "c") for k in range(6)],
]
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(i, text, "en", source, 0, *["clash"] * len(CLASHES)) for i, text, source in TEXTS],
        DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(3, 0, 0), (4, 1, 0), (6, 0, 0), (7, None, None), (None, 1, 0), (20, 1, 0), (20, 1, 0),
         (21, 1, 0), (22, 0, 0)], LABELS)


OPERATORS = {
    "licenses": lambda d, _: licenses.scan_licenses(d),
    "rules": lambda d, _: weak_rules.score_rules(d),
    "classifier": lambda d, labels: pairwise_quality.score_quality(d, labels),
    "mix": lambda d, _: mixing.mix(d),
    "join": lambda d, _: ngram_join.join_ngrams(d),
    "shards": lambda d, _: sharding.shuffle_shards(d, shards=4),
    "lines": lambda d, _: line_dedup.dedup_lines(d),
}


def by_id(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(docs, labels, name):
    out = by_id(OPERATORS[name](docs, labels))
    assert out == sorted(((i,) for i, _, _ in TEXTS), key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, labels, name):
    assert OPERATORS[name](spark.createDataFrame([], DOCS), labels).collect() == []


def test_other_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert cutting_stock.pack(docs).collect() == []
    assert mixing.mixed_documents(mixing.mix(docs)).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert projection_dedup.dedup_vectors(vectors).collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert page_diff.extract_pages(pages).collect() == []


def test_license_of_nothing(docs):
    out = licenses.scan_licenses(docs).where("doc_id = 1 or n_words = 0")
    assert {tuple(r) for r in out.select("n_words", "n_base", "first_word", "last_word",
                                         "base_labels", "labels", "score").collect()} == {
        (0, 0, None, None, "", "", 0.0)}


def test_rules_on_nothing_and_long(docs):
    out = {r["doc_id"]: r for r in weak_rules.score_rules(docs).collect()}
    assert (out[1]["n_words"], out[1]["base_failed"], out[1]["kept"]) == (0, True, False)
    assert (out[4]["n_words"], out[4]["n_repeat_words"]) == (300_000, 300_000)


def test_classifier_without_labels_keeps_all(spark, docs):
    none = spark.createDataFrame([], LABELS)
    out = pairwise_quality.score_quality(docs, none)
    assert {r["predicted"] for r in out.collect()} == {1}
    assert pairwise_quality.keep_good(docs, none).columns == docs.columns


def test_mix_of_nothing(docs):
    out = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    assert out[1]["draws"] == [] and out[1]["size"] == 0
    # all documents with the null source are of one source
    assert out[3]["source_size"] == out[7]["source_size"] == 6


def test_join_of_nothing_and_repeats(docs):
    out = by_id(ngram_join.join_ngrams(docs), "n_links", "class_id")
    assert {row for row in out if row[0] in (0, 1, 2)} == {(0, 0, 0), (1, 0, 1), (2, 0, 2)}
    assert {row for row in out if row[0] in (4, 5)} == {(4, 1, 4), (5, 1, 4)}
    assert out.count((12, 1, 12)) == 2
    assert (None, 0, None) in out


def test_shard_keeps_rows_whole(docs):
    out = sharding.shuffle_shards(docs, shards=4)
    assert out.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert by_id(out, "text", "key") == by_id(docs, "text", "key")


def test_lines_of_nothing_and_repeats(docs):
    out = by_id(line_dedup.dedup_lines(docs).where("doc_id < 30"), "n_lines", "n_dropped", "text")
    assert (0, 1, 0, "") in out and (1, 1, 0, "") in out and (2, 3, 0, " \n\t\n ") in out
    assert out.count((12, 2, 1, "x")) == 2
    assert (25, 2, 0, f"{LINE}\nown 5") in out and (24, 2, 1, "own 4") in out


def test_pack_of_nothing_and_long(docs):
    out = cutting_stock.pack(docs).collect()
    assert sum(r["length"] for r in out if r["doc_id"] == 1) == 1
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == len(out)
    # repeated rows have pieces each
    twelve = [r for r in out if r["doc_id"] == 12]
    assert sum(r["length"] for r in twelve) == 2 * twelve[0]["doc_tokens"]


def test_vectors(spark):
    up, near, no = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], float("nan")
    rows = [
        (5, up, 1), (3, up, 1), (9, near, 1), (1, up, 2), (2, up, None), (4, None, 1),
        (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 0.0], 1), (8, [1.0, no, 0.0], 1), (10, [], 1),
        (11, [1.0, 0.0], 1), (None, up, 1), (12, [0.0, 1.0, 0.0], 3), (12, [0.0, 1.0, 0.0], 3),
    ]
    df = spark.createDataFrame(
        [(*r, "clash", "clash") for r in rows],
        "vec_id long, embedding array<float>, label int, key string, links string")
    out = sorted((tuple(r) for r in projection_dedup.dedup_vectors(df).collect()), key=repr)
    linked = {(3, 2, 3, True), (5, 2, 3, False), (9, 2, 3, False)}
    assert linked <= set(out) and out.count((12, 1, 12, True)) == 2
    alone = {(i, 0, i, True) for i in (1, 2, 4, 6, 7, 8, 10, 11)}
    assert alone <= set(out) and (None, 0, None, True) in out and len(out) == len(rows)


def test_pages(spark):
    long = "<p>word</p>" * 50_000
    rows = [
        (1, None, None), (2, "http://a/x", ""), (3, "http://[bad", "<p>text"), (4, "http://a/x", long),
        (None, "http://a/y", "<p>&lt;b&gt; &amp &#233;<br>x</p>"), (5, "http://c/1", "<p>same</p>"),
        (5, "http://c/1", "<p>same</p>"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows],
                               "page_id long, url string, html string, text string")
    out = {(r["page_id"], r["url"]): r["text"] for r in page_diff.extract_pages(df).collect()}
    assert out[1, None] == "" and out[2, "http://a/x"] == "" and out[3, "http://[bad"] == "text"
    assert out[4, "http://a/x"].count("word") == 50_000
    assert out[None, "http://a/y"] == "<b> & é x"
    assert out[5, "http://c/1"] == "same"
