"""Sequence ratios of batches against difflib."""

import random
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.functions import names, ratio
from tessera.plans import catalog


def word(r, alphabet, most, least=0):
    return "".join(r.choice(alphabet) for _ in range(r.randint(least, most)))


def edited(r, text, alphabet, edits):
    out = list(text)
    for _ in range(r.randint(0, edits)):
        k = r.randrange(len(out) + 1)
        out[k : k + r.randint(0, 1)] = [r.choice(alphabet)] * r.randint(0, 1)
    return "".join(out)


def pairs(seed, n, alphabets, most, edits, least=0):
    r, out = random.Random(seed), []
    for _ in range(n):
        alphabet = r.choice(alphabets)
        a = word(r, alphabet, most, least)
        out.append((a, edited(r, a, alphabet, edits) if r.random() < 0.6 else word(r, alphabet, most, least)))
    return out


def exact(found):
    got = ratio.ratios(pa.array([a for a, _ in found]), pa.array([b for _, b in found]))
    want = np.array([SequenceMatcher(None, a, b).ratio() for a, b in found])
    assert (got == want).all(), [p for p, g, w in zip(found, got, want) if g != w][:3]


def test_a_hundred_thousand_random_pairs():
    found = pairs(1, 100_000, ["ab", "abc ", "абвгдежз икл", "aé😀́ "], 22, 4)
    for start in range(0, len(found), 10_000):
        exact(found[start : start + 10_000])


def test_popular_symbols_of_long_texts():
    exact(pairs(2, 250, ["ab", "abcdefghijklmnopqrstuvwxyz ", "".join(map(chr, range(0x410, 0x44F)))], 420, 40, 150))
    exact([("a" * n, "a" * m) for n in (0, 1, 199, 200, 201, 300) for m in (0, 1, 199, 200, 201, 300)] + [("b" + "a" * 250, "a" * 250 + "b"), ("xay", "a" * 300 + "x"), ("a b " * 60, "b a " * 60)])


@pytest.mark.parametrize("cells", [1, 50, 1 << 12])
def test_blocks_of_any_size(monkeypatch, cells):
    monkeypatch.setattr(ratio, "CELLS", cells)
    exact(pairs(3, 400, ["abc ", "абв"], 30, 5))


def test_nulls_and_no_pairs():
    got = ratio.ratios(pa.array(["a", None, None, "", "ab"]), pa.array([None, "a", None, "", "ab"]))
    assert np.isnan(got[:3]).all() and list(got[3:]) == [1.0, 1.0]
    assert len(ratio.ratios(pa.array([], pa.string()), pa.array([], pa.string()))) == 0


def test_column_function_keeps_nulls_and_the_order_of_arguments(spark):
    rows = [("tide", "diet"), ("diet", "tide"), (None, "a"), ("", "")]
    frame = spark.createDataFrame(rows, "a string, b string")
    assert [r.s for r in frame.select(names.sequence_ratio(F.col("a"), F.col("b")).alias("s")).collect()] == [0.25, 0.5, None, 1.0]


def test_the_margin_query_has_every_kind_of_decision(spark):
    rows = catalog.match_margin(spark, "/root/testdata/sf0.01").collect()
    assert {r.ambiguous for r in rows} == {True, False} and any(r.notes for r in rows) and any("," in r.record_ids for r in rows)
    assert all(0.84 <= r.match_score <= 0.99 for r in rows) and sum(r.match_score < 0.99 for r in rows) > 500 and len(rows) < spark.read.parquet("/root/testdata/sf0.01/customer.parquet").count()
