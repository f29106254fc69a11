"""The corpus pipeline, stage by stage, against plain versions on the smallest tables."""

import os
from collections import Counter

import brute
import pytest
from compare import ROOT

import corpus_pipeline
from skyledger.llm import pairwise_quality
from skyledger.llm.columns import table

DIR = f"{ROOT}/{os.environ.get('TEST_SF', 'sf0.001')}"

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """What each stage returned, written and read again, after the documents themselves."""
    out = [table(spark, DIR, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(results):
    assert all(df.columns == results[0].columns for df in results[:-1])


def test_quality(spark, results):
    scored = pairwise_quality.score_quality(results[0], table(spark, DIR, "labels"))
    good = {r["doc_id"] for r in scored.collect() if r["predicted"] == 1}
    before, after = by_id(results[0]), by_id(results[1])
    assert after == {i: r for i, r in before.items() if i in good}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, DIR, "labels").collect()}
    clean = [i for i in before if labels.get(i) == 1]
    assert sum(i in after for i in clean) >= 0.95 * len(clean)


def test_lines(results):
    expected = brute.deduped([(i, r["text"]) for i, r in by_id(results[1]).items()])
    after = by_id(results[2])
    assert {i: r["text"] for i, r in after.items()} == {i: t for i, (_, _, t) in expected.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_near_duplicates(results):
    before = by_id(results[2])
    expected = brute.joined([(i, r["text"]) for i, r in before.items()])
    assert by_id(results[3]) == {i: r for i, r in before.items() if expected[i][1] == i}


def test_mix(results):
    sizes = {i: len(brute.words(r["text"])) for i, r in by_id(results[3]).items()}
    before = by_id(results[3])
    taken = Counter()
    for r in results[4].collect():
        own, whole = brute.words(r["text"]), brute.words(before[r["doc_id"]]["text"])
        assert own == whole[:len(own)]
        taken[r["doc_id"]] += len(own)
    assert all(n <= 2 * sizes[i] for i, n in taken.items())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.01)


def test_pack_and_run(spark, results):
    count = Counter(r["doc_id"] for r in results[4].collect())
    pieces = results[5].collect()
    assert {r["doc_id"] for r in pieces} == set(count)
    once = [i for i, n in count.items() if n == 1]
    tokens = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    lengths = Counter()
    for r in pieces:
        lengths[r["doc_id"]] += r["length"]
    assert all(lengths[i] == tokens[i] for i in once)
    rerun = corpus_pipeline.run(spark, DIR)
    assert rerun.columns == results[5].columns
    keys = ("doc_id", "start", "length")
    assert rerun.selectExpr("sum(length)").first()[0] == sum(r["length"] for r in pieces)
    assert set(keys) <= set(rerun.columns)


# odd rows ----------------------------------------------------------------------------------

# Names that operators use inside or return.
CLASHES = ("id key row run p size words lines label n_words n_lines shard place slot draws target "
           "source_size uid part rank score kept class_id token").split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in CLASHES)
LINE = "a line of more than forty characters that is in many documents"
LONG = "lorem ipsum dolor sit amet " * 30_000
NEAR = " ".join(f"word{k}" for k in range(100))
ODD = [
    (0, None, "a"), (1, "", "a"), (2, " \n\t\n ", None), (3, "one", None), (4, LONG, "b"),
    (5, LONG, "b"), (6, NEAR, "b"), (7, NEAR + " more", None), (None, None, None),
    (None, "a text that has no id of its own at all", "a"),
    (None, "a text that has no id of its own at all", "a"), (12, f"{LINE}\nx", "c"),
    (12, f"{LINE}\nx", "c"), *[(20 + k, f"{LINE}\nown {k}", "c") for k in range(6)],
]


def save(spark, folder, rows, labels):
    spark.createDataFrame(
        [(i, text, "en", source, 0, *["clash"] * len(CLASHES)) for i, text, source in rows],
        SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    return str(folder)


def test_stages_on_odd_rows(spark, tmp_path):
    """No labels: the classifier rejects nothing, so all odd rows reach the other stages."""
    folder = save(spark, tmp_path / "odd", ODD, [])
    docs, kept = table(spark, folder, "documents"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(Counter((r["doc_id"], r["text"]) for r in docs.collect()))
        assert {r["row"] for r in docs.collect()} <= {"clash"}
    quality, lines, one, mix = kept
    assert quality == Counter((i, text) for i, text, _ in ODD)
    # null is one empty line; the line goes but for the largest id that has it
    assert lines[12, "x"] == 2 and lines[25, f"{LINE}\nown 5"] == 1 and lines[24, "own 4"] == 1
    assert lines[0, ""] == 1 and lines[1, ""] == 1 and lines[2, " \n\t\n "] == 1
    # one row of equal or near texts, also of those that repeat or have no id
    ids = Counter(i for i, _ in one.elements())
    assert ids[4] == 1 and ids[5] == 0 and ids[6] == 1 and ids[7] == 0 and ids[12] == 1
    assert one[None, "a text that has no id of its own at all"] == 1
    # empty texts have no words to be alike in, and none to mix
    assert {i for i, _ in one} >= {0, 1, 2}
    assert not {i for i, _ in mix} & {0, 1, 2}
    stage = corpus_pipeline.STAGES[-1][1]
    pieces = stage(spark, docs, folder).collect()
    places = {}
    for r in pieces:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 1024
    assert {r["doc_id"] for r in pieces} == {i for i, _ in mix}


def test_run_on_empty_tables(spark, tmp_path):
    folder = save(spark, tmp_path / "empty", [], [])
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_run_on_rows_without_text(spark, tmp_path):
    folder = save(spark, tmp_path / "blank", [(1, None, "a"), (None, "", None)], [(1, None, 0)])
    assert corpus_pipeline.run(spark, folder).collect() == []
