import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import weighted_minhash as M
from tessera.llm.common import partitions


def near(text, r, changes):
    words = text.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def planted(n_groups=12, seed=2):
    r = random.Random(seed)
    rows, group = [], []
    for g in range(n_groups):
        text = " ".join(f"w{r.randrange(3000)}" for _ in range(r.randint(80, 300)))
        for _ in range(r.randint(1, 6)):
            rows.append((len(rows), near(text, r, r.choice([0, 0, 1, 2, 3]))))
            group.append(g)
    return rows, group


def similarity(rows, n_docs):
    """Weighted Jaccard similarity of all pairs, by plain dictionaries."""
    sets = {}
    for i, t in rows:
        words = (t or "").lower().split()
        if words:
            sets[i] = Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))
    df = Counter(s for c in sets.values() for s in c)
    code = {s: M.code_of(np.array([n]))[0] for s, n in df.items()}
    weight = {i: {s: float(M.weights_of(np.array([n]), np.array([code[s]]), n_docs)[0]) for s, n in c.items()} for i, c in sets.items()}
    out = {}
    for i in weight:
        for j in weight:
            if i < j and (both := weight[i].keys() & weight[j].keys()):
                low = sum(min(weight[i][s], weight[j][s]) for s in both)
                out[i, j] = low / (sum(weight[i].values()) + sum(weight[j].values()) - low)
    return out


def test_classes_equal_brute_force(spark):
    rows, _ = planted()
    got = {r.doc_id: r.class_id for r in M.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    pairs = [p for p, s in similarity(rows, len(rows)).items() if s >= M.SIMILAR]
    root = {i: i for i, _ in rows}
    for _ in rows:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root and any(got[i] != i for i in got)


def test_samples_agree_as_often_as_the_similarity():
    r = np.random.default_rng(1)
    keys = np.sort(r.integers(0, 1 << 63, 400, dtype=np.uint64))
    a, b = slice(0, 300), slice(60, 400)
    wa, wb = r.uniform(0.5, 3, 300), r.uniform(0.5, 3, 340)
    wb[:240] = wa[60:] * r.choice([1.0, 1.0, 1.4], 240)
    sampler = M.Sampler(n=2000)
    x = sampler.samples(np.r_[keys[a], keys[b]], np.r_[wa, wb], np.array([0, 300]))
    low = np.minimum(wa[60:], wb[:240]).sum()
    assert (x[0] == x[1]).mean() == pytest.approx(low / (wa.sum() + wb.sum() - low), abs=0.04)


def test_large_group_of_near_copies_stays_one_class(spark):
    r = random.Random(9)
    base = " ".join(f"w{r.randrange(3000)}" for _ in range(300))
    rows = [(i, near(base, r, 2)) for i in range(120)] + [(500 + i, " ".join(f"v{r.randrange(9000)}" for _ in range(100))) for i in range(60)]
    got = {x.doc_id: x for x in M.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i].class_id for i in range(120)} == {0} and all(got[500 + i].kept for i in range(60))


def test_awkward_and_empty_tables(docs, no_docs):
    got = {r.doc_id: r.class_id for r in M.near_documents(docs).collect()}
    assert got[4] == 3 and all(got[i] == i for i in got if i not in (4, 5))
    assert M.near_documents(no_docs).collect() == []
    kept = M.keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if got[i] == i}


def test_a_line_repeated_in_unlike_texts_joins_nothing(spark):
    r = random.Random(4)
    rows = [(i, " ".join(f"w{r.randrange(9000)}" for _ in range(90)) + " again and again" * 300) for i in range(40)]
    assert all(x.kept for x in M.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def star(r, copies, at):
    """Copies of one text with 4 scattered edits each; the text itself at place `at` of the ids."""
    base = [f"w{r.randrange(3000)}" for _ in range(300)]
    rows = []
    for i in range(copies + 1):
        words = list(base)
        for k in range(4 if i != at else 0):
            words[k * 75 + 10 + r.randrange(55)] = f"new{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


def bucket_classes(spark, rows):
    """Classes by the pairs that share a bucket and are similar, by plain loops over the operator's own samples."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    n = 3 * partitions(spark)
    chunks = M.chunk_table(docs)
    signed = M.signatures(chunks, M.materialize(M.frequencies(chunks, n)), n, len(rows)).collect()
    keys = {x.doc_id: [tuple(x.samples[b * M.ROWS : b * M.ROWS + M.ROWS]) for b in range(M.BANDS)] for x in signed}
    root = {i: i for i, _ in rows}
    for (a, b), s in similarity(rows, len(rows)).items():
        if s >= M.SIMILAR and any(x == y for x, y in zip(keys[a], keys[b])):
            low, high = sorted((root[a], root[b]))
            root = {i: low if x == high else x for i, x in root.items()}
    return root


@pytest.mark.parametrize("small", [64, 4])
def test_original_in_the_middle_of_the_ids_meets_all_its_copies(spark, monkeypatch, small):
    monkeypatch.setattr(M, "SMALL", small, raising=False)
    monkeypatch.setattr(M, "BLOCK_ROWS", 16, raising=False)
    rows = star(random.Random(3), 60, 30)
    got = {x.doc_id: x.class_id for x in M.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == bucket_classes(spark, rows)


def test_sums_of_shared_weights_equal_single_pairs():
    r = np.random.default_rng(5)
    codes = r.integers(0, 60, 200).astype(np.uint8)
    sets = []
    for _ in range(9):
        k = np.sort(r.choice(200, 120, replace=False))
        sets.append([k.astype(np.uint64), r.integers(1, 5, 120).astype(np.uint32), codes[k]])
    whole = [M.weights_of(x[1], x[2], 500).sum() for x in sets]
    got = M.shared_weights(sets[:4], sets[4:], 500)
    for i in range(4):
        for j in range(5):
            both = got[i, j]
            assert both / (whole[i] + whole[4 + j] - both) == pytest.approx(M.weighted_jaccard(sets[i], sets[4 + j], 500))
