"""Link merging against a plain loop, sites, streaming."""

import random

from pyspark.sql import functions as F

from tessera.config import Config
from tessera.operators import links as L
from tessera.operators import results
from tessera.schemas import LINKS, RESULT


def plain_merge(links):
    kept = {}
    for link in links:
        link = dict(link)
        old = kept.get(link["url"])
        if old is None:
            kept[link["url"]] = link
            continue
        sources = list(dict.fromkeys([*old["source_urls"], *link["source_urls"]]))
        high, low = (link, old) if link["confidence"] > old["confidence"] else (old, link)
        if low["evidence"] and low["evidence"] not in high["evidence"]:
            high["evidence"] += L.MORE_EVIDENCE + low["evidence"]
        high["source_urls"] = sources
        kept[link["url"]] = high
    return list(kept.values())


def test_merge_equals_a_plain_loop(spark):
    r = random.Random(3)
    rows = []
    for k in range(300):
        links = [
            {"platform": "x", "url": f"https://x.com/{r.choice('ab')}", "confidence": r.choice([0.5, 0.7, 0.9]), "evidence": r.choice(["", "a", "ab", "c"]), "source": r.choice("st"), "source_urls": r.choices(["https://p.example.org/", "https://q.example.org/"], k=2)}
            for _ in range(r.randint(0, 6))
        ]
        rows.append((k, links))
    frame = spark.createDataFrame(rows, f"k int, links {LINKS}")
    want = dict(rows)
    for row in frame.select("k", L.merge_links(L.empty_links(), F.col("links")).alias("m")).collect():
        merged = [x.asDict() for x in row["m"]]
        for x, y in zip(merged, plain_merge(want[row["k"]])):
            y["source_urls"] = y["source_urls"] if sum(z["url"] == y["url"] for z in want[row["k"]]) == 1 else list(dict.fromkeys(y["source_urls"]))
            assert x == y
        assert len(merged) == len(plain_merge(want[row["k"]]))


def test_sites_are_visited(spark):
    link = {"platform": "website", "url": "https://site.example.org/", "confidence": 0.9, "evidence": "e", "source": "s", "source_urls": []}
    frame = spark.createDataFrame([("k", [link])], f"cache_key string, links {LINKS}")
    fields = [f.split(":")[0].strip() for f in "entity_id: s, input_name: s, canonical_name: s, entity_type: s".split(",")]
    other = [x.split(":")[0].strip() for x in RESULT[len("struct<") : -1].replace(LINKS, "L").split(",")]
    empty = {n: F.lit(None) for n in other} | {n: F.lit("x") for n in fields} | {"links": F.col("links"), "ambiguous": F.lit(False), "resolution_sources": F.array(F.lit("registry"))}
    rows = frame.select("cache_key", F.struct(*(v.alias(n) for n, v in empty.items())).cast(RESULT).alias("result"))
    pages = spark.createDataFrame([("https://site.example.org/", '<a href="https://t.me/s/chan">t</a><a href="/about">a</a>')], "url string, html string")
    config = Config(llm_key="k", crawler_enabled=True)
    got = results.finalized(rows, config, pages).first()["result"]
    assert [(x["url"], x["confidence"], x["source"]) for x in got["links"]] == [("https://t.me/chan", 0.97, "official_site"), ("https://site.example.org/", 0.9, "s")]
    assert got["resolution_sources"] == ["registry", "official_site_crawler"] and got["needs_human_review"] is False


def test_arriving_lists(spark, tmp_path):
    from tessera.streaming.arrivals import watch
    from tests.test_bulk import answer, engine, item

    made = engine(spark, tmp_path, [lambda e: answer(item(e[0]["id"], "https://x.com/a"))])
    spark.createDataFrame([("1", "Никто", "person", 1)], "entity_id string, name string, entity_type string, row_no long").write.parquet(str(tmp_path / "arriving"))
    watch(spark, str(tmp_path / "arriving"), str(tmp_path / "cp"), made).awaitTermination()
    assert made.stored().first()["status"] == "success"


def test_sites_are_fetched_under_a_guard(spark, tmp_path):
    import pytest

    from tessera.operators.search import UnsafeUrl
    from tessera.sources import web
    from tests.test_bulk import engine

    public = lambda host, port: [(0, 0, 0, "", ("93.184.216.34", 0))]
    private = lambda host, port: [(0, 0, 0, "", ("93.184.216.34", 0)), (0, 0, 0, "", ("10.0.0.1", 0))]
    assert web.is_public_url("https://a.example.org/", public) and not web.is_public_url("https://a.example.org/", private)
    assert not web.is_public_url("ftp://a.example.org/", public) and not web.is_public_url("http://[abc", public)
    with pytest.raises(UnsafeUrl):
        web.fetch_html("http://127.0.0.1/")
    assert web.read_body([b"ab", b"cd", b"e"], 4) == b"abcd"

    made = engine(spark, tmp_path, [], crawler_enabled=True, resolution_mode="economy")
    made.fetch = lambda url, timeout, most: '<a href="https://vk.com/club">v</a>' if "test" in url else 1 / 0
    stats, rows = made.run(spark.createDataFrame([("1", "Тестов Пётр Ильич", "person", 1)], "entity_id string, name string, entity_type string, row_no long"))
    result = rows.first()["result"]
    assert "https://vk.com/club" in [x["url"] for x in result["links"]] and "official_site_crawler" in result["resolution_sources"]
