import math
import random
import re
import zlib
from hashlib import sha256

import pytest

from tessera.llm import importance_resampling as R

CAPS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, most=1):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(CAPS))
    return words, [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, most=1, percent=10, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode("utf-8", "surrogatepass")) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in features(text, most)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t)]
    rows = []
    for i, text in docs:
        words, found = features(text, most)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(words), len(found), weight, score, None])
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=str)


def got(frame, target, **options):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank")) for r in R.resample(frame, target, **options).collect()), key=str)


def plain(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def target(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


def test_equals_brute_force(docs, sample, target):
    texts = [r.text for r in target.collect()]
    for frame in (sample, docs):
        assert got(frame, target) == brute(plain(frame), texts)


def test_longer_runs_of_words(sample, target, monkeypatch):
    texts = [r.text for r in target.collect()]
    assert got(sample, target, max_run=3, buckets=5000, percent=30) == brute(plain(sample), texts, 3, 30, 5000)


@pytest.mark.parametrize("most", [1, 2, 4])
def test_slices_of_a_long_text_lose_no_run(most):
    r = random.Random(1)
    text = " ".join(r.choice(["a", "Bé", "c-d", "x" * 50]) for _ in range(3000))
    whole = sorted(zlib.crc32(f.encode()) % 97 for f in features(text, most)[1])
    for size in (1, 7, 100, 1 << 20):
        found = list(R.text_buckets(text, R.Memo(97), most, size))
        assert sorted(int(b) for part, _ in found for b in part) == whole and sum(n for _, n in found) == len(features(text)[0])


def test_ties_repeated_rows_and_null_ids(spark):
    """Equal scores by doc_id; a third of the rows are one row."""
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(7, text)] * 40 + [(i, text) for i in range(100, 140)] + [(None, text)] * 40 + [(1, "short"), (2, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    none = spark.createDataFrame([(None,)], "text string")
    for percent in (0, 1, 10, 33, 50, 90, 100):
        assert got(frame, none, percent=percent) == brute(rows, [], percent=percent)


def test_kth_key_is_exact(spark):
    r = random.Random(5)
    data = [(r.choice([-(1 << 40), -7, 0, 3, 3, 3, 1 << 45]) + r.choice([0, 0, 1]), r.choice([None, -5, 0, 1, 2, 1 << 50])) for _ in range(300)]
    rows = spark.createDataFrame(data, "score long, doc_id long").cache()
    order = sorted(data, key=lambda x: (-x[0], x[1] is None, x[1] or 0))
    columns = R.composite_key(rows)
    for k in (1, 2, 17, 100, 150, 299, 300):
        taken = rows.where(R.at_most(columns, R.kth_key(rows, k))).collect()
        last = order[k - 1]
        want = [x for x in order if x in order[:k] or x == last]
        assert sorted(map(tuple, taken), key=str) == sorted(want, key=str)
    assert R.kth_key(rows, 301) is None


def test_ranks_run_through_many_ranges(spark):
    rows = [(i, i % 50, 25, 25, i % 50) for i in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, weight long, n_words long, n_features long, score long").repartition(5)
    found = {r["rank"]: (-r["score"], r["doc_id"]) for r in R.ranked(frame, 900, 13).collect() if r["rank"]}
    assert sorted(found) == list(range(1, 901)) and [found[i] for i in range(1, 901)] == sorted(found.values())


def test_no_rows(no_docs, target):
    assert R.resample(no_docs, target).collect() == []
