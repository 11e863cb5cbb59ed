"""Stored answers as a table against the search loop on the same answers."""

import json
import random

import pytest

from tessera.config import Config
from tessera.operators import answers as A
from tessera.operators.search import Answer, ReplayProvider, Searcher, spend

LINK = {"platform": "x", "url": "https://x.com/a", "confidence": 0.5, "evidence": "e"}
ITEM = {"entity_id": "k1", "canonical_name": "Имя", "ambiguous": True, "ambiguity_notes": ["n"], "aliases_used": [], "links": [LINK, LINK | {"confidence": 1, "source_urls": ["https://a.example.org"]}]}
GOOD = {"results": [ITEM, {"entity_id": "k2"}, ITEM | {"canonical_name": "second"}, {"entity_id": "foreign", "links": []}]}


def with_item(**changes):
    return {"results": [{"entity_id": "k2"}, ITEM | changes]}


def with_link(**changes):
    return with_item(links=[LINK, LINK | changes])


PAYLOADS = [
    GOOD, {}, {"results": []}, {"results": None}, {"results": {}}, {"results": [None]}, {"results": [[]]}, {"results": [{"entity_id": 5}]}, {"results": "x"}, {"other": 1},
    with_item(entity_id=None), with_item(canonical_name=None), with_item(canonical_name=7), with_item(ambiguous=None), with_item(ambiguous="yes"), with_item(ambiguous=1), with_item(links=None), with_item(links={}), with_item(links=[5]),
    with_item(ambiguity_notes=None), with_item(ambiguity_notes=[1]), with_item(ambiguity_notes=[None]), with_item(aliases_used="a"), with_item(aliases_used=["a", "b"]),
    with_link(confidence=1.5), with_link(confidence=-0.1), with_link(confidence="0.5"), with_link(confidence=True), with_link(confidence=None), with_link(confidence=1), with_link(confidence=0), with_link(confidence=1e-3),
    with_link(url=None), with_link(platform=3), with_link(evidence=[]), with_link(source_urls=None), with_link(source_urls=["a", 1]), with_link(source_urls=[]), with_link(source_urls=["u"]), {"results": [ITEM | {"links": [{"platform": "x"}], "ambiguity_notes": 5}]},
]
TEXTS = [json.dumps(p, ensure_ascii=False) for p in PAYLOADS] + ["", "  \n", "no object", "} {", "{bad", '{"results": [}', '```json\n{"results": []}\n``` done', 'before {"results": [{"entity_id": "k2"}]} behind', "[1]", None]
GROUNDINGS = [(True, [], []), (False, [" q ", "q", " "], []), (False, [], ["ftp://x", "https://a", "https://a"]), (False, [], []), (False, [" "], ["x"])]


class FreeLedger:
    def reserve(self, *_):
        return 1

    def complete(self, *_, **__):
        pass


def by_loop(rows, require):
    """The outcomes of the search loop, batch by batch."""
    config = Config(llm_key="k", llm_require_grounding=require, llm_requests_per_minute=10**6, llm_max_calls_per_run=0, llm_attempts=1)
    provider = ReplayProvider([Answer(text, entry, queries, uris) for _, text, entry, queries, uris in rows])
    out = []
    spend([[{"id": i, "name": "n", "type": "person"} for i in ids] for ids, *_ in rows], Searcher(provider, FreeLedger(), config, sleep=lambda s: None), out.extend)
    return out


def told(outcome):
    o = dict(outcome)
    return json.dumps([o["cache_key"], o["event"], o["item"], o["error"], o["search_used"], o["search_queries"], o["grounding_sources"]], sort_keys=True, ensure_ascii=False)


@pytest.mark.parametrize("require", [True, False])
def test_outcomes_equal_the_loop(spark, require):
    r = random.Random(1)
    rows = [(["k1", "k2", "k3"], text, *(GROUNDINGS[0] if k % 2 else r.choice(GROUNDINGS))) for k, text in enumerate(TEXTS * 2)]
    got = A.outcomes(spark.createDataFrame(rows, A.ANSWER), require).collect()
    assert sorted(told(o.asDict(True)) for o in got) == sorted(map(told, by_loop([(a, b or "", *c) for a, b, *c in rows], require)))
    assert {o.event for o in got} == {"item", "missing", "error"}


def test_nulls_repeats_and_no_answers(spark):
    rows = [(["k1", "k1"], TEXTS[0], None, None, [None, "https://a"]), (None, TEXTS[0], True, [], []), ([], TEXTS[0], True, [], []), (["k2"], '{"a": 1, "a": 2}', True, [], [])]
    got = A.outcomes(spark.createDataFrame(rows, A.ANSWER)).collect()
    assert [(o.cache_key, o.event) for o in got] == [("k1", "item"), ("k2", "error")]
    assert A.outcomes(spark.createDataFrame([], A.ANSWER)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = A.outcomes(spark.createDataFrame([], A.ANSWER))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
