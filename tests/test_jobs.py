"""The jobs: growing input, runs again, stops between, parts of the output, awkward rows, and the registered queries against SQL."""

import json
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import catalog, page_links, resolve_entities
from jobs.common import settings

FOLDER = "/root/testdata/sf0.001"


def put_pages(spark, folder, rows):
    spark.createDataFrame(rows, page_links.SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def page(site, *hrefs, more=""):
    return f"<html><!-- <a href='https://t.me/hidden'> -->{more}" + "".join(f'<p><a class="x" href="{h}">t</a></p>' for h in hrefs) + "</html>"


def told(frame):
    return sorted((r.site, r.url, r.platform, r.profile, r.first_page, r.batch) for r in frame.collect())


@pytest.fixture
def places(tmp_path):
    return {k: str(tmp_path / k) for k in ("pages", "output", "checkpoint")}


FIRST = [
    (1, "https://www.one.example.org/a/b?x=1", page("one", "/c", "d/../e", "https://T.me/s/one/", "#top", "mailto:x@y.example", "//vk.com/one", "http://[bad")),
    (2, "https://one.example.org/", page("one", "/c", "https://x.com/one/status/1", more='<script type="application/ld+json">{"a": [{"sameAs": ["https://ok.ru/one", 7]}]}</script>')),
    (None, "https://two.example.org/", page("two", "/c?q=1&amp;r=2")),
    (3, None, page("x", "/c")), (4, "", page("x", "/c")), (5, "https://three.example.org", None), (6, "no host", page("x", "/c")), (7, "https://four.example.org/", "<p>no links</p>"), (1, "https://www.one.example.org/a/b?x=1", page("one", "/c")),
]
SECOND = [(8, "https://one.example.org/z", page("one", "/c", "https://t.me/one", "https://t.me/one2")), (9, "https://five.example.org/", page("five", "https://t.me/one"))]


def test_links_of_growing_pages(spark, places):
    put_pages(spark, places["pages"], FIRST)
    first = told(page_links.run(spark, **places))
    assert [(r[0], r[1], r[2], r[3]) for r in first] == [
        ("one.example.org", "https://ok.ru/one", "ok", True),
        ("one.example.org", "https://one.example.org/a/b?x=1", "website", True),
        ("one.example.org", "https://one.example.org/a/e", "website", True),
        ("one.example.org", "https://one.example.org/c", "website", True),
        ("one.example.org", "https://t.me/one", "telegram", True),
        ("one.example.org", "https://vk.com/one", "vk", True),
        ("one.example.org", "https://x.com/one/status/1", "x", False),
        ("two.example.org", "https://two.example.org/c?q=1&r=2", "website", True),
    ]
    assert {r[5] for r in first} == {0} and dict((r[1], r[4]) for r in first)["https://one.example.org/c"] == 1
    assert told(page_links.run(spark, **places)) == first  # nothing new

    put_pages(spark, places["pages"], SECOND)
    second = told(page_links.run(spark, **places))
    assert sorted(set(second) - set(first)) == [("five.example.org", "https://t.me/one", "telegram", True, 9, 1), ("one.example.org", "https://t.me/one2", "telegram", True, 8, 1)]
    assert set(first) <= set(second) and len(second) == len(first) + 2
    assert told(page_links.run(spark, **places)) == second


def test_a_batch_run_again_after_a_stop(spark, places, tmp_path):
    """The commit of the second batch is lost, as after a stop between writing and committing: it is run again into its own partition."""
    put_pages(spark, places["pages"], FIRST)
    page_links.run(spark, **places)
    put_pages(spark, places["pages"], SECOND)
    want = told(page_links.run(spark, **places))
    for name in ("1", ".1.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    assert told(page_links.run(spark, **places)) == want
    put_pages(spark, places["pages"], [(10, "https://six.example.org/", page("six", "/a"))])
    assert len(told(page_links.run(spark, **places))) == len(want) + 1


def test_one_file_at_a_time_gives_the_same_links(spark, places, tmp_path):
    rows = [(i, f"https://s{i % 3}.example.org/p{i}", page("s", f"/l{i % 5}", "https://t.me/all")) for i in range(12)]
    for i in range(0, 12, 4):
        put_pages(spark, places["pages"], rows[i : i + 4])
    many = told(page_links.run(spark, **places, files_per_batch=1))
    whole = told(page_links.run(spark, places["pages"], str(tmp_path / "whole"), str(tmp_path / "whole_checkpoint")))
    assert [r[:4] for r in many] == [r[:4] for r in whole] and {r[5] for r in many} == {0, 1, 2}
    platforms = {p.name for p in (tmp_path / "output" / "batch=0").iterdir() if p.is_dir()}
    assert platforms == {"platform=website", "platform=telegram"}


def test_profiles_only_and_no_pages(spark, places, tmp_path):
    put_pages(spark, places["pages"], FIRST)
    got = told(page_links.run(spark, **places, profiles_only=True))
    assert {r[2] for r in got} == {"ok", "telegram", "vk"}
    empty = str(tmp_path / "empty")
    put_pages(spark, empty, [])
    assert told(page_links.run(spark, empty, str(tmp_path / "none"), str(tmp_path / "none_checkpoint"))) == []


ENTITIES = [("a", "Ромашка Медиа", "organization", 1), ("b", "ромашка  медиа!", "organization", 2), ("c", "Никто Никогда", "person", 3), ("d", "  ", "person", 4), ("e", None, None, 5), ("f", "Тестов Пётр Ильич", "no such type", 6), ("a", "Ромашка Медиа", "organization", 1), (None, "Луг Север", None, None)]
REGISTRY = [
    ("r1", "1", 'Фонд "Ромашка Медиа"', "https://www.romashka.example.org/; https://t.me/s/romashka", "Организации"),
    ("r2", "2", "Тестов Пётр Ильич", "https://vk.com/testov", "Физические лица"),
    ("r3", None, "Без Ссылок", None, None),
    (None, None, None, None, None),
]


@pytest.fixture
def tables(spark, tmp_path):
    data = tmp_path / "data"
    spark.createDataFrame(ENTITIES, "entity_id string, name string, entity_type string, row_no long").write.parquet(str(data / "entities.parquet"))
    spark.createDataFrame(REGISTRY, "id string, field_1_i string, field_2_s string, field_6_s string, field_7_s string").write.parquet(str(data / "registry.parquet"))
    return str(data)


def results(frame):
    return Counter((r.entity_id, r.name, r.status, tuple(x.url for x in r.result.links), r.shard) for r in frame.collect())


def test_entities_resolved_and_run_again(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    got = results(resolve_entities.run(spark, tables, out, shards=3))
    by_id = {k[0]: k for k in got}
    assert by_id["a"][3] == by_id["b"][3] == ("https://romashka.example.org/", "https://t.me/romashka")
    assert got[by_id["a"]] == 2 and by_id["f"][3] == ("https://vk.com/testov",) and by_id["c"][2] == by_id[None][2] == "unresolved" and set(by_id) == {"a", "b", "c", "f", None}
    missing = spark.read.option("header", True).csv(f"{out}/unresolved").collect()
    assert {r.name for r in missing} == {"Никто Никогда", "Луг Север"}
    assert results(resolve_entities.run(spark, tables, out, shards=3)) == got


def test_some_shards_leave_the_others(spark, tables, tmp_path):
    whole = results(resolve_entities.run(spark, tables, str(tmp_path / "whole"), shards=3))
    out = str(tmp_path / "out")
    for only in ([0], [2, 1], [0]):
        got = results(resolve_entities.run(spark, tables, out, only, shards=3))
    assert got == whole
    spark.createDataFrame([("z", "Тестов Пётр Ильич", "person", 9)], "entity_id string, name string, entity_type string, row_no long").write.mode("append").parquet(f"{tables}/entities.parquet")
    grown = results(resolve_entities.run(spark, tables, out, shards=3))
    assert set(grown) - set(whole) == {k for k in grown if k[0] == "z"} and len(grown) == len(whole) + 1


def test_nothing_to_resolve(spark, tables, tmp_path):
    none = resolve_entities.run(spark, tables, str(tmp_path / "none"), entities="SELECT * FROM {entities} WHERE false")
    assert none.count() == 0
    bare = resolve_entities.run(spark, tables, str(tmp_path / "bare"), registry="SELECT * FROM {registry} WHERE false")
    assert {r.status for r in bare.collect()} == {"unresolved"}


def test_command_lines_and_settings(spark, tables, tmp_path, monkeypatch):
    put_pages(spark, str(tmp_path / "pages"), FIRST)
    monkeypatch.setattr(page_links, "session", lambda name: spark)
    monkeypatch.setattr(resolve_entities, "session", lambda name: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"profiles_only": True}))
    assert page_links.main(["--config", str(config), "--pages", str(tmp_path / "pages"), "--output", str(tmp_path / "l"), "--checkpoint", str(tmp_path / "k")]) == 0
    assert {r.platform for r in page_links.read_links(spark, str(tmp_path / "l")).collect()} == {"ok", "telegram", "vk"}
    assert resolve_entities.main(["--config", "jobs/resolve_entities.json", "--data", tables, "--output", str(tmp_path / "r"), "--only", "0,1,2"]) == 0
    config.write_text(json.dumps({"profile_only": True}))
    with pytest.raises(ValueError, match="profile_only"):
        settings(spark, str(config), page_links.DEFAULTS)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_registered_queries_equal_sql(spark, name):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.sources.partitionOverwriteMode")}
    frame = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    db = duckdb.connect()
    for table in ("part", "customer", "supplier", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(str(tuple(r[names.index(c)] for c in columns)) for r in cursor.fetchall())
    assert sorted(str(tuple(r)) for r in frame.select(*(F.col(c) for c in columns)).collect()) == want
    assert before == {k: spark.conf.get(k) for k in before}
