"""The match cascade against a plain loop over all records."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import entities as E
from tessera.operators import matching, registry
from tests.test_functions import plain_score


def registry_rows(spark, rows):
    """rows: (id, number, name, category, excluded)."""
    names = [c.split()[0] for c in registry.RAW.split(", ")]
    raw = spark.createDataFrame([(i, str(n), name, "", excluded, "", f"https://r.example.org/{i}", kind, "", "", "", "", "") for i, n, name, kind, excluded in rows], ", ".join(f"{c} string" for c in names))
    return registry.parse(raw)


def people(spark, rows):
    frame = spark.createDataFrame([(str(k), name, kind, k) for k, (name, kind) in enumerate(rows, 1)], "entity_id string, name string, entity_type string, row_no long")
    return matching.with_search_names(E.first_of_each(E.keyed(frame)))


PERSON = registry.PERSON_CATEGORY


def found(spark, entities, records):
    rows = matching.lookup(people(spark, entities), registry_rows(spark, records)).join(E.keyed(people(spark, entities).select("entity_id", "name", "entity_type", "row_no")).select("cache_key", "name"), "cache_key")
    return {r["name"]: (round(r["match_score"], 6), r["ambiguous"], [x["record_id"] for x in r["records"]]) for r in rows.collect()}


def test_tiers_and_ambiguity(spark):
    records = [
        ("a1", 1, "Тестов Пётр Ильич", PERSON, "2020"),
        ("a2", 2, "Тестов Пётр Ильич", PERSON, ""),
        ("b1", 3, "Лугов Иван Олегович", PERSON, "2020"),
        ("b2", 7, "Лугов Иван Олегович", PERSON, "2021"),
        ("c1", 4, "Полев Олег Иванович", PERSON, ""),
        ("c2", 5, "Полев Олег Петрович", PERSON, ""),
        ("d1", 6, 'Фонд "Ромашка Медиа"', "Организации", ""),
        ("e1", 8, "Северный Ветер Медиа Групп Дом Юг Один", "Организации", ""),
        ("e2", 9, "Северный Ветер Медиа Групп Дом Юг Два", "Организации", ""),
    ]
    entities = [
        ("Пётр Тестов Ильич", "person"), ("Лугов Иван Олегович", "unknown"), ("Полев Олег", "person"), ("ООО «Ромашка Медиа»", "organization"), ("Ромашка Медиа", "person"), ("Северный Ветер Медиа Групп Дом Юг Три", "organization"), ("Никто Никогда", "person"), ("", "person"),
    ]
    got = found(spark, entities, records)
    assert got["Пётр Тестов Ильич"] == (0.99, False, ["a2"])
    assert got["Лугов Иван Олегович"] == (1.0, False, ["b2"])
    assert got["Полев Олег"] == (0.99, True, [])
    assert got["ООО «Ромашка Медиа»"][1:] == (False, ["d1"])
    assert "Ромашка Медиа" not in got and "Никто Никогда" not in got and "" not in got
    assert got["Северный Ветер Медиа Групп Дом Юг Три"][1:] == (True, [])


@pytest.mark.parametrize("seed", [1, 2])
def test_pruned_matching_equals_a_plain_loop(spark, seed):
    """Decisions (score, ambiguity) of organizations with near names, without and with the bound."""
    r = random.Random(seed)
    pool = ["ромашка", "медиа", "север", "луг", "ветер", "река", "поле", "групп", "acme", "one"]
    records = [(f"r{k}", k + 1, " ".join(r.sample(pool, r.randint(2, 5))), "Организации", "") for k in range(30)]
    entities = list({(" ".join(w if r.random() < 0.8 else w + "a" for w in r.sample(pool, r.randint(2, 5))), "organization") for _ in range(60)})
    got = found(spark, entities, records)
    names = {i: name for i, _, name, _, _ in records}
    for name, _ in entities:
        tokens = set(name.split())
        exact = [i for i in names if sorted(names[i].split()) == sorted(name.split())]
        if exact:
            assert got[name][0] >= 0.99
            continue
        scores = sorted(((plain_score(name, " ".join(sorted(names[i].split())), "organization"), plain_score(name, names[i], "organization"), names[i]) for i in names if tokens & set(names[i].split())), key=lambda s: -max(s[:2]))
        best = max(scores[0][:2]) if scores else 0.0
        if best < 0.84:
            assert name not in got
            continue
        second = max((max(s[:2]) for s in scores if s[2] != scores[0][2]), default=0.0)
        assert got[name][0] == pytest.approx(best, abs=1e-6)
        assert got[name][1] == (best < 0.99 and best - second < 0.04)


def test_one_python_node_for_scores(spark):
    records = registry_rows(spark, [("a", 1, "Ромашка Медиа", "Организации", "")]).cache()
    entities = people(spark, [("Ромашка Медио", "organization")]).cache()
    pairs = matching.candidates(entities, records)
    plan = matching.scored(entities, records, pairs, 0.84, 0.04)._jdf.queryExecution().executedPlan().toString()
    assert sum("ArrowEvalPython" in line and "sequence_ratio" in line for line in plan.split("\n")) == 1


def test_index_rows(spark):
    records = registry_rows(spark, [("a", 1, 'Фонд "Луг"', "Организации", ""), ("", 2, "x", PERSON, ""), ("c", 3, " ", PERSON, "")])
    assert [r["record_id"] for r in records.collect()] == ["a"]
    assert {r["search_name"] for r in registry.name_index(records).collect()} == {"фонд луг", "луг", "фонд"}
    assert {r["token"] for r in registry.token_index(records).select(F.col("token")).collect()} == {"фонд", "луг"}
