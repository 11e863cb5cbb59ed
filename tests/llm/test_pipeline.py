import corpus_pipeline as P
from tessera.llm.common import read
from tests.llm.test_packing import ids_of

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    assert [name for name, _ in P.STAGES] == ["quality_classifier", "weighted_minhash", "suffix_dedup", "secrets", "packing"]
    docs = read(spark, FOLDER, "documents").cache()
    columns, n = docs.columns, docs.count()
    for name, stage in P.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, FOLDER).cache()
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before)
        if name in ("quality_classifier", "weighted_minhash"):
            assert all(after[i] == before[i] for i in after) and len(after) < len(before)
        else:
            assert len(after) == len(before)
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces = P.run(spark, FOLDER).collect()
    assert {p.doc_id for p in pieces} == set(texts) and len(texts) < n
    totals = {}
    for p in pieces:
        totals[p.doc_id] = totals.get(p.doc_id, 0) + p.length
    for i in list(texts)[:40]:
        assert totals[i] == len(ids_of(texts[i]))
