import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tessera.llm import line_dedup as L

CAPS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\v\f\r").translate(CAPS)


def brute(rows):
    """(doc_id, n_lines, n_dropped, kept text) of each row, counted by doc_id; rows without one keep all."""
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                held[key(line)].add(i)
    owner = {k: max(ids) for k, ids in held.items() if len(ids) >= 3}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if i is None or owner.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return Counter(out)


def got(frame, **options):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in L.dedup_lines(frame, **options).collect())


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_equals_brute_force(spark, sample, docs):
    for frame in (sample, docs):
        assert got(frame) == brute(pairs(frame))


def test_any_number_of_batches(spark):
    r = random.Random(7)
    lines = [f"{'Éa' if i % 3 else 'EA'} line number {i} of the passages" for i in range(60)] + ["short", "", "\t EA LINE NUMBER 3 of the PASSAGES \r"]
    rows = [(r.randrange(150), "\n".join(r.choice(lines) for _ in range(r.randrange(6)))) for _ in range(200)] + [(None, lines[3])] * 4
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    for batches in (1, 2, 3, 5, 8):
        assert got(frame, batches=batches) == want


def test_batches_in_any_order_and_hot_lines(spark):
    """A line of all documents, and one of three only; the owner may come first, last or between."""
    rows = [(i, f"the line that all of them hold\n{'a line of three documents' if i in (5, 50, 95) else i}") for i in range(100)]
    lines = L.long_lines(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    for order in ([0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1]):
        runs = L.LineRuns(spark)
        for k in order:
            runs.add(lines.where((F.col("doc_id") >= 25 * k) & (F.col("doc_id") < 25 * k + 25)).select("doc_id", "line"))
        assert sorted(r.owner for r in runs.repeated().collect()) == [95, 99]


def test_settled_lines_are_not_added_again_and_runs_are_not_shuffled(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, f"the line that all of them hold\nthe one line of document {i}") for i in range(40)]
        lines = L.long_lines(spark.createDataFrame(rows, "doc_id long, text string")).cache()
        runs = L.LineRuns(spark)
        runs.add(lines.where("doc_id >= 20").select("doc_id", "line"))
        new = runs.unsettled(lines.where("doc_id < 20").select("doc_id", "line"))
        assert new.count() == 20
        # One exchange for each of the two steps of the batch's distinct counts, none for the run.
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == plan.split("SortMergeJoin")[1].split("FileScan")[0].count("Exchange hashpartitioning") > 0
        first = runs.levels[0]
        second = runs._store(new)
        plan = runs.merged(first, second)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert runs.merged(first, second).count() == 41
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_of_runs_are_dropped(spark, docs):
    before = {t.name for t in spark.catalog.listTables()}
    L.dedup_lines(docs).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_very_long_text_and_code_points(spark):
    long = "\n".join(f"line {i % 5000} of a long document" for i in range(60_000))
    rows = [(1, long), (2, long + "\nx"), (3, long), (4, "é" * 19), (5, "é" * 19), (6, "é" * 19), (7, "é" * 20), (8, " " + "é" * 20), (9, "é" * 20 + "\v")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(frame) == brute(rows)
    assert L.line_hashes("é" * 19) == [None] and L.line_hashes(None) == [None]
    assert L.line_hashes("A" * 20 + "\n" + "a" * 20)[0] == hashlib.blake2b(b"a" * 20, digest_size=16).digest() == L.line_hashes("a" * 20)[0]


def test_nothing_to_do(spark, no_docs):
    assert L.dedup_lines(no_docs).collect() == []
    assert got(spark.createDataFrame([(None, None), (None, "a")], "doc_id long, text string")) == Counter([(None, 1, 0, ""), (None, 1, 0, "a")])
