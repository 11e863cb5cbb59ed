import hashlib
import random

import pytest

from tessera.llm import suffix_dedup as M


def brute(rows):
    owner = {}
    for i, t in rows:
        raw = (t or "").encode()
        for s in range(len(raw) - 49):
            w = raw[s : s + 50]
            owner[w] = min(owner.get(w, i), i)
    out = {}
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 49):
            if owner[raw[s : s + 50]] < i:
                gone[s : s + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


def got(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in M.repeated_bytes(frame).collect()}


def awkward(sample):
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    r = random.Random(1)
    base = rows[3][1]
    rows += [(1000 + k, base[r.randint(0, 200) :][: r.randint(40, 900)] + str(k) * r.randint(0, 3) + rows[k % 50][1][: r.randint(0, 300)]) for k in range(60)]
    return [*rows, (2000, None), (2001, ""), (2002, "a" * 300), (2003, "a" * 120), (2004, base * 60), (999, "b" * 49), (998, "ab" * 400_000), (3000, "ab" * 60)]


def test_column_wise_equals_sorting():
    for seed in range(60):
        r = random.Random(seed)
        strings = [bytes(r.choice(b"ab" if seed % 2 else b"abcdefgh ") for _ in range(r.randint(1, 12))) for _ in range(r.randint(1, 9))]
        want = sorted(((strings[i][p:], i, p) for i in range(len(strings)) for p in range(len(strings[i]) + 1)), key=lambda x: [(b + 1, 0) for b in x[0]] + [(0, x[1])])
        string, place, prefix = M.column_wise(strings)
        assert [(i, p) for _, i, p in want] == list(zip(string.tolist(), place.tolist()))
        common = [0]
        for (a, _, _), (b, _, _) in zip(want, want[1:]):
            k = 0
            while k < min(len(a), len(b)) and a[k] == b[k]:
                k += 1
            common.append(k)
        assert common == prefix.tolist()


def test_files_hold_large_columns(monkeypatch):
    strings = [b"mississippi", b"sip", b"miss"]
    want = [x.tolist() for x in M.column_wise(strings)]
    monkeypatch.setattr(M, "IN_MEMORY", 8)
    assert [x.tolist() for x in M.column_wise(strings)] == want


@pytest.mark.parametrize("many", [1000, 2])
def test_equals_brute_force(spark, sample, monkeypatch, many):
    """many = 2 sends nearly all unlike contexts the way of hot anchors."""
    monkeypatch.setattr(M, "MANY", many)
    rows = awkward(sample)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_awkward_table(docs):
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_repeated_rows_and_empty_table(spark, no_docs):
    text = "the same passage of more than fifty bytes stands here twice, word for word"
    rows = M.repeated_bytes(spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 0), (2, len(text))]
    assert M.repeated_bytes(no_docs).collect() == []
    null = M.repeated_bytes(spark.createDataFrame([(None, text), (-5, text)], "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in null) == [("-5", len(text)), ("None", 0)]


def test_strip_keeps_columns_and_characters(spark):
    shared = "é" * 40
    frame = spark.createDataFrame([(1, shared + "x", "a", 9, None), (2, "y" + shared + "z", None, 9, "k"), (3, None, "c", 0, "k")], "doc_id long, text string, __null2 string, n_chars long, chunk string")
    rows = {r.doc_id: r for r in M.strip_repeats(frame).collect()}
    assert rows[2].text == "yz" and rows[2].n_chars == 2 and rows[2]["__null2"] is None and rows[2].chunk == "k"
    times = frame.selectExpr("doc_id", "text", "timestamp'2024-01-02 03:04:05.123456' AS at", "array(doc_id) AS ids")
    assert {(r.at.microsecond, tuple(r.ids) == (r.doc_id,)) for r in M.strip_repeats(times).collect()} == {(123456, True)}
    assert rows[1].text == shared + "x" and rows[3].text is None and M.strip_repeats(frame).columns == frame.columns
