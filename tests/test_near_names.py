"""The fuzzy tier's candidates and decisions: against plain loops over all pairs, for names of few and of very many tokens."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import matching


def frames(spark, left, right, kinds=("organization",)):
    entities = spark.createDataFrame([(f"e{i}", n, r) for i, (n, r) in enumerate(left)], "cache_key string, normalized_name string, entity_type string")
    records = spark.createDataFrame([(f"r{i}", n, r) for i, (n, r) in enumerate(right)], "record_id string, search_names array<string>, entity_type string")
    return entities, records


def plain_bound(a, b):
    k = len(a & b)
    if not k:
        return None
    j, c = k / len(a | b), k / min(len(a), len(b))
    return max(0.45 + 0.35 * j + 0.20 * c, 0.55 + 0.30 * j + 0.15 * c)


def plain_pairs(left, right, least):
    found = set()
    for i, (name, kind) in enumerate(left):
        for k, (others, other_kind) in enumerate(right):
            for other in others:
                bound = plain_bound(set(name.split()), set(other.split()))
                if (kind == "unknown" or kind == other_kind) and bound is not None and bound >= least - 1e-9:
                    found.add((f"e{i}", f"r{k}", other))
    return found


def got(spark, left, right, least):
    rows = matching.near_rows(*frames(spark, left, right), least)
    return {(r.cache_key, r.record_id, r.search_name) for r in rows.collect()}


@pytest.mark.parametrize(("least", "seed"), [(0.80, 1), (0.80, 2), (0.9, 3), (0.72, 4), (0.6, 5), (0.97, 6)])
def test_candidates_equal_a_plain_loop(spark, least, seed):
    """Names of 1 to 14 tokens of a pool with some that most names hold, some with repeats, some empty."""
    r = random.Random(seed)
    pool = ["всех", "дом", "a", "b"] * 3 + [f"t{i}" for i in range(18)]
    name = lambda: " ".join(r.choice(pool) for _ in range(r.choice([0, 1, 1, 2, 3, 3, 4, 5, 7, 8, 9, 10, 14])))
    left = [(name(), r.choice(["person", "organization", "unknown"])) for _ in range(70)]
    right = [([name() for _ in range(r.randint(0, 3))], r.choice(["person", "organization"])) for _ in range(60)]
    for i in range(0, 40):  # near copies
        tokens = left[i][0].split()
        for _ in range(r.randint(0, 3)):
            if tokens:
                tokens[r.randrange(len(tokens))] = r.choice(pool)
        right[i][0].append(" ".join(tokens))
    right = [(list(dict.fromkeys(n)), kind) for n, kind in right]
    want = plain_pairs(left, right, least)
    assert got(spark, left, right, least) == want and want


def test_names_of_a_hundred_tokens(spark):
    """Rows stay linear in the tokens, and near names are found among short ones."""
    r = random.Random(9)
    long = [f"w{i}" for i in range(100)]
    changed = [w if r.random() < 0.8 else w + "x" for w in long]
    left = [(" ".join(long), "organization"), (" ".join(long[:6]), "organization"), ("w1 w2", "organization")]
    right = [([" ".join(changed), " ".join(long[50:]), " ".join(long[:40])], "organization"), ([" ".join(long[:8])], "organization"), ([" ".join(long[:9])], "organization")]
    assert got(spark, left, right, 0.8) == plain_pairs(left, right, 0.8)


def test_keys_are_linear_in_tokens(spark, monkeypatch):
    for n, most in ((2, 12), (8, 60), (10, 25), (50, 110), (100, 210)):
        name = " ".join(f"w{i}" for i in range(n))
        entities, records = frames(spark, [(name, "organization")], [([name], "organization")])
        left = entities.select("cache_key", F.col("entity_type").alias("kind"), F.split("normalized_name", " ").alias("a"))
        right = records.select("record_id", F.lit(0).alias("name_no"), F.col("entity_type").alias("kind"), F.split(F.col("search_names")[0], " ").alias("b"))
        sides = []
        join = type(left).join
        monkeypatch.setattr(type(left), "join", lambda self, other, *more: (sides.append((self, other)), join(self, other, *more))[1])
        assert matching.near_pairs(left, right, 0.8).count() == 1
        monkeypatch.undo()
        one, other = sides[-1]
        assert one.count() <= most and other.count() <= most, (n, one.count(), other.count())


def test_hot_tokens_of_short_names_are_no_keys(spark):
    """All names share two tokens of three: no more rows meet than there are near pairs."""
    left = [(f"общее слово x{i}", "organization") for i in range(300)]
    right = [([f"общее слово x{i}"], "organization") for i in range(0, 300, 10)] + [([f"общее другое y{i}"], "organization") for i in range(300)]
    rows = matching.near_rows(*frames(spark, left, right), 0.85)
    assert {(r.cache_key, r.record_id) for r in rows.collect()} == {(f"e{i}", f"r{i // 10}") for i in range(0, 300, 10)}


@pytest.mark.parametrize(("least", "hot"), [(0.80, 4), (0.6, 2), (0.9, 1000)])
def test_bounds_equal_a_plain_loop(spark, monkeypatch, least, hot):
    """Pairs that share common tokens, rare ones, both; whatever counts as common."""
    monkeypatch.setattr(matching, "HOT", hot)
    r = random.Random(11)
    pool = ["всех", "дом", "a"] * 4 + [f"t{i}" for i in range(14)]
    name = lambda: " ".join(r.choice(pool) for _ in range(r.choice([0, 1, 2, 3, 3, 4, 5, 9])))
    left = [(name(), r.choice(["person", "organization", "unknown"])) for _ in range(50)]
    right = [(list(dict.fromkeys(name() for _ in range(r.randint(0, 3)))), r.choice(["person", "organization"])) for _ in range(50)]
    want = {}
    for e, o, n in plain_pairs(left, right, least):
        bound = plain_bound(set(left[int(e[1:])][0].split()), set(n.split()))
        want[e, o] = max(bound, want.get((e, o), 0))
    rows = matching.near_bounds(*frames(spark, left, right), least, digits=6).collect()
    assert len(rows) == len(want) and {(x.cache_key, x.record_id): x.bound for x in rows} == {k: pytest.approx(v, abs=1e-6) for k, v in want.items()}


def test_alike_pairs_are_not_compared_one_by_one(spark, monkeypatch):
    """All names share two tokens of three, each with a rare third: 400 pairs have one bound, the 20 that share all another."""
    monkeypatch.setattr(matching, "HOT", 8)
    compared = []
    meet = matching.meet

    def recorded(left, right, alike=(), ahead=None):
        met = meet(left, right, alike, ahead) if ahead else meet(left, right)
        if not ahead:
            compared.append(met)
        return met

    monkeypatch.setattr(matching, "meet", recorded)
    left, right = [(f"лугов иван x{i}", "person") for i in range(20)], [([f"лугов иван x{i}"], "person") for i in range(20)]
    rows = matching.near_bounds(*frames(spark, left, right), 0.8).collect()
    assert sorted({round(r.bound, 6) for r in rows}) == [0.8, 1.0] and len(rows) == 400
    assert sum(met.count() for met in compared) <= 20
