"""Pairs that meet once, their counts without expanding them, and a lookup that makes no exact pairs."""

import random

from pyspark.sql import functions as F

from tessera.operators import matching
from tests.test_matching import PERSON, found


def sides(spark, seed):
    """Rows whose keys are partly held by most rows, and some rows without keys."""
    r = random.Random(seed)
    pool = ["h1", "h2", "h3"] * 6 + [f"k{i}" for i in range(25)]
    keys = lambda: [r.choice(pool) for _ in range(r.randint(0, 5))]
    left = {f"e{i}": keys() for i in range(60)}
    right = {f"r{i}": (r.choice("xy"), keys()) for i in range(50)}
    one = spark.createDataFrame(list(left.items()), "cache_key string, keys array<string>")
    two = spark.createDataFrame([(i, kind, k) for i, (kind, k) in right.items()], "record_id string, kind string, keys array<string>")
    return left, right, one, two


def test_each_pair_meets_once(spark, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK", 3)
    left, right, one, two = sides(spark, 1)
    got = sorted((r.cache_key, r.record_id) for r in matching.meet(one, two).collect())
    assert got == sorted((e, r) for e, a in left.items() for r, (_, b) in right.items() if set(a) & set(b)) and got


def test_a_hot_key_sends_its_rows_a_few_times(spark, monkeypatch):
    """A key of 60 rows a side is dealt into 3 blocks a side, not into 30: a row is sent to each of the other side's, right ones as lists."""
    monkeypatch.setattr(matching, "BLOCK", 2)
    monkeypatch.setattr(matching, "DEALT", 3, raising=False)
    frame = lambda side: spark.createDataFrame([(f"{side}{i}", ["hot"]) for i in range(60)], "id string, keys array<string>")
    sides = []
    join = type(frame("e")).join
    monkeypatch.setattr(type(frame("e")), "join", lambda self, other, *more: (sides.append((self, other)), join(self, other, *more))[1])
    met = matching.meet(frame("e").withColumnRenamed("id", "cache_key"), frame("r").withColumnRenamed("id", "record_id"))
    left, right = sides[-1]
    assert (left.count(), right.count()) == (180, 9)
    assert met.distinct().count() == met.count() == 3600


def test_more_rows_make_more_blocks(spark, monkeypatch):
    monkeypatch.setattr(matching, "MOST", 1 << 13)
    made = spark.createDataFrame([(1,), (1024,), (1025,), (32768,), (32769,), (100_000,)], "n long").select("n", matching.blocks(F.col("n")).alias("b"))
    assert [r.b for r in made.orderBy("n").collect()] == [1, 1, 2, 4, 5, 13]


def test_what_is_found_ahead_is_that_of_each_pair(spark, monkeypatch):
    """Rows alike in a column meet as one list; a null found for it leaves them out."""
    monkeypatch.setattr(matching, "BLOCK", 3)
    left, right, one, two = sides(spark, 5)
    met = matching.meet(one, two, ("kind",), {"said": F.when(~((F.col("kind") == "x") & F.col("cache_key").endswith("1")), F.concat("cache_key", "kind"))})
    got = sorted((r.cache_key, r.record_id, r.said) for r in met.collect())
    want = sorted((e, r, e + kind) for e, a in left.items() for r, (kind, b) in right.items() if set(a) & set(b) and not (kind == "x" and e.endswith("1")))
    assert got == want and got


def test_counts_equal_expanded_pairs(spark, monkeypatch):
    monkeypatch.setattr(matching, "HOT", 8)
    left, right, one, two = sides(spark, 2)
    got = {(r.cache_key, r.kind): r.n for r in matching.pair_counts(one, two, "kind").collect()}
    want = {(e, kind): sum(1 for k, b in right.values() if k == kind and set(a) & set(b)) for e, a in left.items() for kind in "xy"}
    assert got == {k: n for k, n in want.items() if n}


def test_a_hot_given_name_makes_no_pairs(spark, monkeypatch):
    """All share a surname and a given name: the lookup settles them by the names of that key, not by 40 times 40 pairs."""
    monkeypatch.setattr(matching, "meet", None)
    records = [(f"r{i}", i + 1, f"Лугов Иван код{i}", PERSON, "") for i in range(40)]
    got = found(spark, [(f"Лугов Иван код{i}", "person") for i in range(20, 60)], records)
    assert {name: v[1:] for name, v in got.items()} == {f"Лугов Иван код{i}": (False, [f"r{i}"]) if i < 40 else (True, []) for i in range(20, 60)}


def test_hot_tokens_of_unlike_names_are_no_keys(spark):
    """Names that share two tokens of three would need a sequence ratio of 1: they do not meet in the lookup's fuzzy tier."""
    frame = lambda side, n: spark.createDataFrame([(f"{side}{i}", f"лугов иван {side}{i}") for i in range(n)], "id string, name string").select("id", F.lit("person").alias("kind"), F.split("name", " ").alias("t"))
    left = frame("e", 30).select(F.col("id").alias("cache_key"), "kind", F.col("t").alias("a"))
    right = frame("r", 30).select(F.col("id").alias("record_id"), F.lit(0).alias("name_no"), "kind", F.col("t").alias("b"))
    assert matching.near_pairs(left, right, 0.8).count() == 900
    x, y = matching.near_keys(left, right, 0.8, scored=True)
    assert x.join(y, ["kind", "form", "token"]).count() == 0
