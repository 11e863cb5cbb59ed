"""Bulk runs with recorded registry and search: states, attempts, quota, replay, output files."""

import csv
import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tessera.__main__ import main
from tessera.config import Config, ConfigError
from tessera.operators import registry
from tessera.operators.answers import ANSWER
from tessera.operators.search import Answer, EngineError, InvalidResponse, RateLimiter, RegistryError, ReplayProvider, check_items, is_transient, read_object, with_retry
from tessera.plans.bulk import Engine
from tessera.schemas import RESULT
from tessera.sources import files, registry_api, search_api
from tessera.sources.store import Ledger, Store


def raw_rows(spark):
    rows = [
        {"id": "1", "field_1_i": "10", "field_2_s": "Тестов Пётр Ильич", "field_7_s": registry.PERSON_CATEGORY, "field_6_s": "https://t.me/s/test; https://www.test.example.org/"},
        {"id": "2", "field_1_i": "11", "field_2_s": "Лугов Иван Олегович", "field_7_s": registry.PERSON_CATEGORY, "field_6_s": "нет"},
        {"id": "2", "field_1_i": "12", "field_2_s": "Лугов Иван Олегович", "field_7_s": registry.PERSON_CATEGORY, "field_6_s": ""},
    ]
    config = Config(llm_key="k", registry_page_size=2, registry_page_delay=0)
    return registry_api.download(spark, config, rows=json.dumps(rows))


def item(entity, url=None, **more):
    links = [{"platform": "x", "url": url, "confidence": 0.9, "evidence": "e", "source_urls": ["https://s.example.org/"]}] if url else []
    return {"entity_id": entity, "canonical_name": "N", "links": links, **more}


def answer(*items):
    return Answer(json.dumps({"results": list(items)}), queries=["q"], uris=["https://s.example.org/"])


def engine(spark, folder, answers, **more):
    settings = {"llm_key": "k", "store_dir": str(folder / "store"), "output_jsonl": str(folder / "out.jsonl"), "unresolved_csv": str(folder / "out.csv"), "registry_min_expected": 1, "llm_batch_size": 1, "llm_base_delay": 0.0} | more
    config = Config(**settings)
    ledger = Ledger(str(folder / "usage.db"), config.llm_timezone)
    return Engine(spark, config, registry_rows=lambda: raw_rows(spark), provider=ReplayProvider(answers), ledger=ledger, sleep=lambda s: None)


@pytest.fixture
def entities(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('﻿name,type,id\n"Тестов Пётр Ильич",Person,\n,person,x\n"Кто ""То""",robot,k2\nЛугов Иван Олегович,person,k3\nЛУГОВ Иван Олегович,person,k4\nНикто,person,k5\n', encoding="utf-8")
    return files.read_entities(spark, str(path))


def test_csv(entities):
    rows = [tuple(r) for r in entities.orderBy("row_no").collect()]
    assert rows == [("1", "Тестов Пётр Ильич", "person", 1), ("k2", 'Кто "То"', "unknown", 3), ("k3", "Лугов Иван Олегович", "person", 4), ("k4", "ЛУГОВ Иван Олегович", "person", 5), ("k5", "Никто", "person", 6)]


def test_csv_without_name(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("title\nx\n")
    with pytest.raises(ValueError, match="name"):
        files.read_entities(spark, str(tmp_path / "bad.csv"))


def test_states_quota_and_second_run(spark, tmp_path, entities):
    # In order of rows: an item with links, a missing item, a bad answer twice.
    first = engine(spark, tmp_path, [lambda e: answer(item(e[0]["id"], "https://x.com/kto")), lambda e: answer(item("other")), Answer("no json", entry_point=True)])
    stats, rows = first.run(entities)
    got = {r["id"]: r for r in rows.collect()}
    assert {k: (r["status"], r["attempts"]) for k, r in got.items()} == {"1": ("success", 0), "k2": ("success", 0), "k3": ("unresolved", 1), "k4": ("unresolved", 1), "k5": ("unresolved", 1)}
    assert [x["url"] for x in got["1"]["result"]["links"]] == ["https://t.me/test", "https://test.example.org/"]
    assert got["k2"]["result"]["resolution_sources"] == ["search"] and got["k2"]["result"]["search_queries"] == ["q"]
    assert got["k3"]["result"]["registry_record_ids"] == ["2"] and got["k4"]["result"]["entity_id"] == "k3"
    assert (stats.listed, stats.worked, stats.reused, stats.success, stats.unresolved, stats.pending, stats.answered) == (5, 4, 1, 2, 2, 3, 2)
    usage = first.searcher.ledger.usage(first.config.llm_model)
    assert (usage["requests"], usage["entities_sent"], usage["successful_entities"], usage["failed_requests"]) == (3, 3, 1, 1)

    # The budget of one more call: the first pending entity is answered, the other is deferred without an attempt.
    again = engine(spark, tmp_path, [lambda e: answer(item(e[0]["id"]))], llm_daily_budget=4)
    stats, rows = again.run(entities)
    got = {r["id"]: (r["status"], r["attempts"], r["error"]) for r in rows.collect()}
    assert got["1"][0] == got["k2"][0] == "success" and got["k3"][:2] == ("unresolved", 2) and got["k5"][:2] == ("unresolved", 1)
    assert stats.answered == 1 and stats.reused == 3

    # All that stands is reused; the entity with an attempt left fails without an answer.
    third = engine(spark, tmp_path, [], llm_daily_budget=4)
    stats, rows = third.run(entities)
    assert stats.reused == 4 and {r["id"]: r["attempts"] for r in rows.collect()}["k5"] == 1
    lines = [json.loads(x) for x in sorted(spark.read.text(third.config.output_jsonl).toPandas()["value"])]
    assert len(lines) == 5 and all(list(x) == ["id", "name", "entity_type", "status", "attempts", "error", "result"] for x in lines)
    printed = {r["value"] for r in files.link_lines(files.read_results(spark, third.config.output_jsonl)).collect()}
    assert 'Тестов Пётр Ильич: ["https://t.me/test","https://test.example.org/"]' in printed


def test_stored_answers_give_what_the_loop_gives(spark, tmp_path, entities):
    """The same answers asked one by one, and taken in as a table."""
    texts = [lambda e: answer(item(e["id"], "https://x.com/kto"), item("other")), lambda e: answer(item("other")), lambda e: Answer("no json", entry_point=True)]
    asked = []
    (tmp_path / "loop").mkdir()
    (tmp_path / "table").mkdir()
    loop = engine(spark, tmp_path / "loop", [lambda e, t=t: (asked.append((e[0]["id"], t(e[0]))), t(e[0]))[1] for t in texts])
    want_stats, want = loop.run(entities)
    table = spark.createDataFrame([([i], a.text, a.entry_point, a.queries, a.uris) for i, a in asked] + [(["no such key"], "x", True, [], [])], ANSWER)
    config = Config(store_dir=str(tmp_path / "table" / "store"), output_jsonl=str(tmp_path / "table" / "o.jsonl"), unresolved_csv=str(tmp_path / "table" / "o.csv"), registry_min_expected=1, llm_key="k")
    stats, got = Engine(spark, config, registry_rows=lambda: raw_rows(spark)).run(entities, table)
    told = lambda rows: sorted((r["id"], r["status"], r["attempts"], r["error"] or "", str(r["result"])) for r in rows.collect())
    assert told(got) == told(want) and stats == want_stats
    # Entities that no answer was asked for are deferred without an attempt.
    (tmp_path / "none").mkdir()
    stats, got = Engine(spark, Config(store_dir=str(tmp_path / "none" / "s"), output_jsonl=str(tmp_path / "none" / "o"), unresolved_csv=str(tmp_path / "none" / "u"), registry_min_expected=1, llm_key="k"), registry_rows=lambda: raw_rows(spark)).run(entities, table.limit(0))
    assert stats.answered == 0 and {(r["id"], r["attempts"]) for r in got.collect()} == {(i, 0) for i in ("1", "k2", "k3", "k4", "k5")}


def test_answers_outlive_a_stopped_run(spark, tmp_path):
    def stop(batch):
        raise KeyboardInterrupt

    rows = spark.createDataFrame([(str(i), name, "person", i) for i, name in enumerate(["Никто", "Некто", "Кто"])], "entity_id string, name string, entity_type string, row_no long")
    first = engine(spark, tmp_path, [lambda e: answer(item(e[0]["id"], "https://x.com/n")), stop])
    with pytest.raises(KeyboardInterrupt):
        first.run(rows)
    asked = []
    again = engine(spark, tmp_path, [lambda e: asked.append(e[0]["name"]) or answer(item(e[0]["id"], "https://x.com/m"))] * 2)
    stats, out = again.run(rows)
    got = {r["name"]: r for r in out.collect()}
    assert {r["status"] for r in got.values()} == {"success"} and sorted(asked) == ["Кто", "Некто"] and stats.answered == 2
    assert [x["url"] for x in got["Никто"]["result"]["links"]] == ["https://x.com/n"] and again.store.logged("asked") == {}


def test_transient_errors_are_tried_again(spark, tmp_path):
    rows = [("1", "Никто", "person", 1)]
    made = engine(spark, tmp_path, [TimeoutError(), lambda e: answer(item(e[0]["id"], "https://x.com/n"))])
    stats, rows = made.run(spark.createDataFrame(rows, "entity_id string, name string, entity_type string, row_no long"))
    assert rows.first()["status"] == "success" and made.searcher.ledger.usage(made.config.llm_model)["requests"] == 2
    assert made.resolve_one("Тестов Пётр Ильич", "person")["canonical_name"] == "Тестов Пётр Ильич"


def test_registry_checks(spark, tmp_path):
    made = engine(spark, tmp_path, [], registry_min_expected=5)
    with pytest.raises(EngineError):
        made.ensure_registry()
    assert engine(spark, tmp_path, [], registry_min_expected=5, registry_required=False).ensure_registry().count() == 0
    assert engine(spark, tmp_path, []).ensure_registry().count() == 2
    # An old copy serves where a forced download fails.
    assert engine(spark, tmp_path, [], registry_min_expected=5).ensure_registry(force=True).count() == 2
    with pytest.raises(Exception, match="more than"):
        registry_api.download(spark, Config(llm_key="k", registry_page_delay=0), rows="[]", size="99999").count()
    with pytest.raises(Exception, match="empty page"):
        registry_api.download(spark, Config(llm_key="k", registry_page_delay=0), rows="[]", size="3").count()


def test_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.load("t", "a long").count() == 0 and not store.is_fresh("t", 24)
    store.replace("t", spark.range(3).withColumnRenamed("id", "a"))
    store.replace("t", store.load("t", "a long").where("a > 0"))
    assert store.count("t") == store.load("t", "a long").count() == 2 and store.is_fresh("t", 24)
    for k in range(4):  # a reader of the snapshot before is not disturbed; older ones go
        before = store.load("t", "a long")
        store.replace("t", spark.range(k + 1).withColumnRenamed("id", "a"))
        assert before.count() == (k or 2)
    assert len(list((tmp_path / "s").glob("t-*"))) == 2 and len(list((tmp_path / "s").glob("t.pointer-*"))) == 2
    with pytest.raises(RegistryError):
        store.replace("t", spark.range(9), check=lambda n: (_ for _ in ()).throw(RegistryError(str(n))))
    assert store.count("t") == 4
    store.replace("t", spark.range(2).withColumnRenamed("id", "a"))
    store.expire("t")
    assert not store.is_fresh("t", 24) and store.count("t") == 2


@pytest.fixture
def server():
    """A local interface: respond(path, body) -> (status, answer); its address and the requests it got."""
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append((self.path, asked))
            status, answer = made.respond(self.path, asked)
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps(answer).encode())

        def log_message(self, *args):
            pass

    made = HTTPServer(("127.0.0.1", 0), Handler)
    made.seen, made.address = seen, f"http://127.0.0.1:{made.server_port}"
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield made
    made.shutdown()


def pages_of(total):
    return lambda asked: {"size": total, "values": [{"id": str(k), "field_1_i": str(k), "field_2_s": f"Фонд номер {k}"} for k in range(asked["offset"], min(total, asked["offset"] + asked["limit"]))]}


def test_registry_pages_are_asked_again(server):
    """Pages over HTTP, after two errors of passing trouble."""
    server.respond = lambda path, asked: (503 if len(server.seen) < 3 else 200, pages_of(5)(asked))
    options = {"url": f"{server.address}/", "attempts": "3", "base_delay": "0", "page_size": "2"}
    rows = [registry_api.page(options, k)["values"] for k in (0, 2, 4)]
    assert [len(r) for r in rows] == [2, 2, 1] and [asked["offset"] for _, asked in server.seen] == [0, 0, 0, 2, 4]


def test_entry_points(spark, tmp_path, server, capsys):
    found = {"results": [{"entity_id": None, "links": [{"platform": "x", "url": "https://x.com/kto", "confidence": 0.9, "evidence": "e"}]}]}

    def respond(path, asked):
        if path == "/registry":
            return 200, pages_of(3)(asked)
        prompt = asked["contents"][0]["parts"][0]["text"]
        found["results"][0]["entity_id"] = json.loads(prompt[prompt.rindex("\n[") :])[0]["id"]
        return 200, {"candidates": [{"content": {"parts": [{"text": "```json " + json.dumps(found) + " ```"}]}, "groundingMetadata": {"webSearchQueries": ["q"], "groundingChunks": [{"web": {"uri": "https://s.example.org/"}}, {}]}}]}

    server.respond = respond
    (tmp_path / "in.csv").write_text("name,type\nКто Там,person\nФонд номер 2,organization\n")
    settings = {
        "INPUT_CSV": str(tmp_path / "in.csv"), "OUTPUT_JSONL": str(tmp_path / "out.jsonl"), "UNRESOLVED_CSV": str(tmp_path / "un.csv"), "STORE_DIR": str(tmp_path / "store"), "LEDGER_PATH": str(tmp_path / "usage.db"), "REGISTRY_URL": f"{server.address}/registry",
        "REGISTRY_MIN_EXPECTED": "1", "REGISTRY_PAGE_DELAY": "0", "LLM_URL": server.address, "LLM_KEY": "k", "LLM_REQUESTS_PER_MINUTE": "100",
    }
    run = lambda *a: (main(list(a), settings, spark), capsys.readouterr().out)[1]
    assert run("registry").strip() == "3"
    counts = json.loads(run("bulk"))
    assert counts["listed"] == counts["worked"] == counts["pending"] == 2 and counts["answered"] == 1
    lines = {x["name"]: x for x in map(json.loads, open(tmp_path / "out.jsonl", encoding="utf-8"))}
    assert [x["url"] for x in lines["Кто Там"]["result"]["links"]] == ["https://x.com/kto"] and lines["Кто Там"]["result"]["grounding_sources"] == ["https://s.example.org/"]
    assert lines["Фонд номер 2"]["result"]["registry_record_ids"] == ["2"]
    assert json.loads(run("one", "Фонд номер 1", "--type", "organization"))["canonical_name"] == "Фонд номер 1"
    assert ": 2/480 requests" in run("usage")
    with pytest.raises(InvalidResponse):
        search_api.answer_of({"candidates": []})


def test_results_are_single_files(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), f'n "{i}", x', "person", "failed", 1, "e", i) for i in range(9, 0, -1)], "id string, name string, entity_type string, status string, attempts long, error string, row_no long").repartition(4).withColumn("result", F.lit(None).cast(RESULT))
    out, csv_path = str(tmp_path / "r.jsonl"), str(tmp_path / "u.csv")
    for _ in range(2):  # also over an earlier file
        files.write_results(rows, out)
        files.write_unresolved(rows, csv_path)
    assert [json.loads(x)["id"] for x in open(out, encoding="utf-8")] == [str(i) for i in range(1, 10)]
    text = open(csv_path, encoding="utf-8").read()
    assert text.startswith("\ufeffid,name,entity_type,status,attempts,error\n") and text.count("\ufeff") == 1
    assert [r[0] for r in csv.reader(text.splitlines()[1:])] == [str(i) for i in range(1, 10)]


def test_config():
    assert Config.from_mapping({"LLM_KEY": "k", "CRAWLER_ENABLED": "Yes", "SHARD_COUNT": "2", "SHARD_INDEX": " ", "MIN_CONFIDENCE": "0.5"}).crawler_enabled
    assert Config(llm_key="k", shard_count=2, shard_index=1).sharded("a/b.jsonl") == "a/b.shard-1-of-2.jsonl"
    for bad in ({}, {"llm_key": "k", "llm_batch_size": 11}, {"llm_key": "k", "shard_index": 1}, {"llm_key": "k", "llm_timezone": "Nowhere/X"}, {"llm_key": "k", "resolution_mode": "x"}):
        with pytest.raises(ConfigError):
            Config(**bad)


def test_search_pieces():
    assert read_object('```json\n{"a": 1}\n``` x') == {"a": 1}
    with pytest.raises(InvalidResponse):
        read_object("[1]")
    for bad in ({"entity_id": 1}, item("1") | {"links": [{"platform": "x", "url": "u", "evidence": "e", "confidence": 1.5}]}, item("1") | {"ambiguous": "yes"}):
        with pytest.raises(InvalidResponse):
            check_items({"results": [item("2"), bad]})
    error = RuntimeError()
    error.__cause__ = OSError()
    error.__cause__.status_code = 503
    chained = RuntimeError()
    chained.__cause__ = ConnectionError()
    assert is_transient(error) and is_transient(ConnectionError()) and not is_transient(chained) and not is_transient(ValueError())
    refused = RuntimeError()
    refused.status_code, refused.__cause__ = 400, error.__cause__
    assert not is_transient(refused)  # the first status decides
    calls = []
    with pytest.raises(TimeoutError):
        with_retry(lambda: calls.append(1) or (_ for _ in ()).throw(TimeoutError()), 3, 1.0, lambda s: None)
    assert len(calls) == 3
    now, slept = [0.0], []
    limiter = RateLimiter(2, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    for _ in range(3):
        limiter.acquire()
    assert slept == [60.0]
