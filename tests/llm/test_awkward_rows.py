"""Every operator and every stage over nulls, empty and very long texts, ties, repeated rows, clashing columns and no rows."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from tessera.llm import byte_bpe, embedding_dedup, html_text, importance_resampling, language_id, line_dedup, packing, quality_classifier, quality_rules, secrets, suffix_dedup, weighted_minhash
from tests.llm.conftest import rows as plain_rows

#: Names that the operators use inside, and names of results.
CLASHES = ("found", "pieces", "secrets", "at", "row", "null", "gone", "rest", "left", "text_", "chunk", "docs", "part", "key", "kept", "score", "class_id", "component", "__null", "__gone", "__found", "__rows", "Label", "draw", "n")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
KEY = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567"


def rows():
    r = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "haus", "maison", "the", "und", "los"]
    long = " ".join(r.choice(words) for _ in range(220_000))  # over one batch, piece and chunk
    texts = [(r_[0], r_[1], r_[2], r_[3]) for r_ in plain_rows()]
    texts += [(100, long, "en", "src0"), (101, long[: len(long) // 2], "en", "src0"), (102, "ß" * 1_200_000, None, "src1"), (103, f'the key token = "{KEY}" of the house', "en", None)]
    texts += texts[3:6] + [texts[3]] + [(None, t, lang, source) for _, t, lang, source in texts[3:8]] + [(None, None, None, None)]
    return [(i, t, lang, source, None if t is None else len(t), *(f"{c}!" for c in CLASHES)) for i, t, lang, source in texts]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (3, 1, 0), (6, 0, 0), (7, 1, 0), (100, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")


#: Operator over documents, and the columns by which its results can be told.
BY_DOCUMENT = {
    "op1": lambda docs, labels: quality_rules.quality_rules(docs),
    "op5": lambda docs, labels: quality_classifier.classify(docs, labels),
    "op6": lambda docs, labels: suffix_dedup.repeated_bytes(docs),
    "op8": lambda docs, labels: weighted_minhash.near_documents(docs),
    "op9": lambda docs, labels: byte_bpe.byte_bpe(docs),
    "op10": lambda docs, labels: language_id.identify(docs),
    "op11": lambda docs, labels: line_dedup.dedup_lines(docs),
    "op12": lambda docs, labels: importance_resampling.resample(docs, docs.where("lang = 'en'"), percent=40),
}


def told(frame):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("name", BY_DOCUMENT)
def test_a_row_for_each_document(awkward, labels, name):
    got = told(BY_DOCUMENT[name](awkward, labels))
    assert Counter(r[0] for r in got) == Counter(r[0] for r in rows())
    # Neither partitions nor the order of rows matter.
    assert told(BY_DOCUMENT[name](awkward.repartition(2, "n_chars").sortWithinPartitions("lang"), labels)) == got


@pytest.mark.parametrize("name", BY_DOCUMENT)
def test_no_rows(awkward, labels, name):
    assert BY_DOCUMENT[name](awkward.limit(0), labels).collect() == []


def test_packing(awkward):
    got = packing.pack(awkward).collect()
    whole = Counter()
    for r in got:
        whole[r.doc_id] += r.length
    starts = Counter(r.doc_id for r in got if r.start == 0)
    assert starts == Counter(r[0] for r in rows())
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    used = Counter()
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.WINDOW and max(r.length for r in got) == packing.WINDOW
    assert packing.pack(awkward.limit(0)).collect() == []


def test_secrets(awkward):
    got = Counter((r.doc_id, r.start) for r in secrets.findings(awkward).collect())
    assert got == {(103, 17): 1}


def test_ties_and_copies_of_documents(awkward):
    got = {}
    for r in weighted_minhash.near_documents(awkward).collect():
        got.setdefault(r.doc_id, set()).add((r.class_id, r.kept))
    assert got[3] == {(3, True)} and got[4] == {(3, False)} and got[None] == {(None, True)} and got[0] == {(0, True)}
    removed = {}
    for r in suffix_dedup.repeated_bytes(awkward).collect():
        removed.setdefault(r.doc_id, set()).add(r.n_removed)
    assert removed[101] == {len(next(r[1] for r in rows() if r[0] == 101))} and removed[None] == {0}


@pytest.mark.parametrize("name", [name for name, _ in P.STAGES[:-1]])
def test_stages_keep_columns_of_any_name(spark, awkward, labels, tmp_path, name):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(P.STAGES)[name]
    before = Counter(str(tuple(r)[5:]) for r in awkward.collect())
    out = stage(spark, awkward, str(tmp_path))
    assert out.columns == awkward.columns and out.schema.simpleString() == awkward.schema.simpleString()
    after = Counter(str(tuple(r)[5:]) for r in out.collect())
    assert not after - before and (sum(after.values()) > 0 or name == "quality_classifier")
    if name in ("suffix_dedup", "secrets"):
        assert after == before
    assert stage(spark, awkward.limit(0), str(tmp_path)).collect() == []


def test_pages(spark):
    long = "<article>" + "<p>The house of the old man and the sea is a tale of the town.</p>" * 30_000 + "</article>"
    data = [(1, "u", long, "x", "y"), (1, "u", long, "x", "y"), (None, None, "<p>a</p>", "x", "y"), (2, "u", None, "x", "y"), (3, "u", "", "x", "y")]
    frame = spark.createDataFrame(data, "page_id long, url string, html string, text string, key string")
    got = sorted((r.page_id or 0, r.n_chars) for r in html_text.extract(frame).collect())
    n = 30_000 * 61 + 2 * 29_999
    assert [g[0] for g in got] == [0, 1, 1, 2, 3] and got[1][1] == got[2][1] and abs(got[1][1] - n) < 40_000 * 61 and got[3][1] == got[4][1] == 0
    assert html_text.extract(frame.limit(0)).collect() == []


def test_vectors(spark):
    r = np.random.default_rng(1)
    base = r.standard_normal(8).astype(np.float32).tolist()
    data = [(k, 0, base, "x", "y") for k in (5, 5, 7, 9)] + [(None, 0, base, "x", "y"), (8, None, base, "x", "y"), (6, 0, None, "x", "y")]
    frame = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>, component string, unit string")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embedding_dedup.near_vectors(frame).collect())
    assert got == [(0, 0, 0, True), (5, 2, 5, True), (5, 2, 5, True), (6, 0, 6, True), (7, 2, 5, False), (8, 0, 8, True), (9, 2, 5, False)]
    assert embedding_dedup.near_vectors(frame.limit(0)).collect() == []
