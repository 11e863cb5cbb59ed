"""Quality classifier and language ID: held-out accuracy on driver tables, defined results."""

import numpy as np

from tessera.llm import language_id as L
from tessera.llm import quality_classifier as Q
from tessera.llm.common import crc_mod4
from tessera.llm.ngrams import Batch, mix, pieces

FOLDER = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = Q.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 and crc_mod4(r.doc_id) == 2 for r in rows)


def test_quality_defined_results(docs, no_docs, spark):
    labels = spark.createDataFrame([(3, 1, 0), (6, 0, 0), (7, 1, 0), (0, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    assert len(got) == docs.count() and got[0].score == got[1].score
    none = Q.classify(docs, labels.limit(0)).collect()
    assert {round(r.score, 9) for r in none} == {0.5}
    assert Q.classify(no_docs, labels).collect() == []
    assert Q.keep_good(docs, labels).columns == docs.columns


def test_pieces_change_no_score():
    table = np.random.default_rng(0).normal(size=1 << Q.BITS).astype(np.float32)
    text = ("some words of a text " * 40).encode()
    whole = Q.logits([text], table, 0.1)[0]
    counted = sum(len(b) for b, _ in Q.buckets(Batch([text])))
    assert abs(whole - (sum(table[b].sum(dtype=np.float64) for b, _ in Q.buckets(Batch([text]))) / counted + 0.1)) < 1e-4
    cut = list(pieces([text], 100))
    assert b"".join(x for _, group in cut for x in group) == text and all(sum(map(len, g)) <= 100 for _, g in cut)


def plain_features(text):
    """Word, word-pair and character n-gram features of a text by plain Python, hashed as the operator does."""
    one = lambda x: np.array([x % (1 << 64)], np.uint64)
    bucket = lambda key: int((key >> np.uint64(64 - Q.BITS))[0])
    out = []
    for n in Q.SIZES:
        for k in range(len(text) - n + 1):
            key = 0
            for c in text[k : k + n]:
                key = (key * 0xD6E8FEB86659FD93 + int.from_bytes(c.encode(), "little")) % (1 << 64)
            out.append(bucket(mix(one(key + (n << 56)))))
    hashes = []
    for word in text.encode().split():
        value = 0
        for k, b in enumerate(word):
            value += (b + 1) * pow(0x100000001B3, (k & 255) + 1, 1 << 64)
        hashes.append(mix(one(value)))
    out += [bucket(h) for h in hashes]
    out += [bucket(np.array([Q.TWICE], np.uint64) if a == b else mix(a * np.uint64(31) + b)) for a, b in zip(hashes, hashes[1:])]
    return out


def test_features_equal_plain_ones():
    texts = ["the cat the cat cat sat", "é ñandú 日本語 x 𝄞𝄞𝄞 ok", "a", "wörter und wörter und"]
    table = np.random.default_rng(0).normal(size=1 << Q.BITS).astype(np.float32)
    got = Q.logits([t.encode() for t in texts], table, 0.25)
    for k, text in enumerate(texts):
        want = plain_features(text)
        found = [int(x) for b, owner in Q.buckets(Batch([t.encode() for t in texts])) for x, o in zip(b, owner) if o == k]
        assert sorted(found) == sorted(want)
        assert abs(got[k] - (np.mean(table[want]) + 0.25)) < 1e-5


def test_the_sample_does_not_depend_on_partitions(spark, monkeypatch):
    docs = spark.createDataFrame([(k % 150, f"text {k} " * (1 + k % 7)) for k in range(300)] + [(1000, "same")] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(150)] * 2 + [(1000, 1, 0)] * 200, "doc_id long, quality int, toxic int")
    monkeypatch.setattr(Q, "TRAIN_CHARACTERS", 30)
    samples = [Q.training_rows(docs.repartition(n), labels.repartition(m), 40) for n, m in ((1, 3), (7, 1))]
    assert samples[0] == samples[1] and {y for _, y in samples[0]} == {0, 1} and max(len(t) for t, _ in samples[0]) <= 30
    assert all(sum(y == label for _, y in samples[0]) <= 40 for label in (0, 1))


def plain_hits(filters, text):
    """Hits of each language by sets of the slots, without numpy's batches."""
    raw, hits = b"  " + text + b"  ", [0] * len(filters.languages)
    for k in range(len(raw) - L.N + 1):
        at = [int(s[0]) for s in L.slots(np.array([int.from_bytes(raw[k : k + L.N], "big")], np.uint64))]
        for i in range(len(hits)):
            hits[i] += all(int(filters.table[i // 64][a]) >> (i % 64) & 1 for a in at)
    return hits, len(raw) - L.N + 1


def test_languages_equal_plain_counts():
    train = {"en": ["the cat is on the mat", "the dog is in the house"], "de": ["der hund ist in dem haus", "die katze ist auf der matte"], "one": ["zwölf boxkämpfer jagen viktor"]}
    filters = L.Filters({k: [L.prepared(t) for t in v] for k, v in train.items()})
    texts = ["the mat is in the house", "der boxkämpfer jagen viktor", "die matte", "qqqq", "x"]
    names, scores = filters.decide([L.prepared(t) for t in texts])
    for text, name, score in zip(texts, names, scores):
        hits, total = plain_hits(filters, L.prepared(text))
        fair = [max((h - total * f) / (1 - f), 0) + 1e-6 for h, f in zip(hits, filters.false)]
        assert name == filters.languages[int(np.argmax(fair))] and abs(score - max(fair) / sum(fair)) < 1e-9
    assert names[:2] == ["en", "one"]


def test_a_language_of_one_text_and_long_texts_are_learned(spark, monkeypatch):
    german = "der hund ist in dem haus und die katze ist auf der matte " * 30
    rows = [(k, f"the cat number {k} is on the mat in the house " * 5, "en") for k in range(50)] + [(None, german, "de"), (None, german, "de"), (700, "xylophon quiz jambon " * 3000, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {(r.doc_id, r.lang_pred) for r in L.identify(docs).collect() if r.doc_id is None or r.doc_id == 700}
    assert got == {(None, "de"), (700, "xx")}
    monkeypatch.setattr(L, "ALL_PIECES", 6)
    assert L.fit(docs.repartition(5)).table.tolist() == L.fit(docs.repartition(1)).table.tolist()


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_language_defined_results(docs, no_docs):
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (0, 1, 2)) and got[3].lang_pred != "und"
    assert L.identify(no_docs).collect() == []
    assert {r.lang_pred for r in L.identify(docs, L.Filters({})).collect()} == {"und"}


def test_more_languages_than_a_word_has_bits():
    texts = {f"l{i:03d}": [L.prepared(f"{chr(97 + i % 26)}{chr(97 + i // 26)}zq " * 30)] * 3 for i in range(100)}
    filters = L.Filters(texts)
    names, _ = filters.decide([texts[k][0] for k in ("l003", "l070", "l099")])
    assert names == ["l003", "l070", "l099"] and filters.table.shape[0] == 2
