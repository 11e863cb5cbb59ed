"""Chunks are bounded in rows and in all their bytes; exchanges have buckets by the size of the table; tables can be dropped."""

from pyspark.sql import functions as F

from tessera.llm import common, exchange, suffix_dedup, weighted_minhash


def chunk_rows(table):
    return [(len(exchange.unpack_docs(bytes(r["docs"]))[0]), sum(len(exchange.expand(bytes(r[c]))) for c in ("docs", "rest") if c in table.columns)) for r in table.collect()]


def test_many_empty_texts(spark):
    docs = spark.range(300_000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    found = chunk_rows(exchange.chunk_table(docs))
    assert sum(n for n, _ in found) == 300_000 and max(n for n, _ in found) <= exchange.CHUNK // exchange.ROW < 1 << 16


def test_large_other_columns(spark):
    docs = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.expr("repeat('x', 20000)").alias("more"))
    found = chunk_rows(exchange.chunk_table(docs, carry="null"))
    assert sum(n for n, _ in found) == 3000 and max(size for _, size in found) < 1.1 * exchange.CHUNK


def test_buckets_follow_the_table(spark, sample, monkeypatch):
    chunks = exchange.chunk_table(sample)
    few = exchange.exchange_buckets(chunks)
    assert few == 3 * common.partitions(spark)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 5000)
    assert exchange.exchange_buckets(chunks) > 2 * few


def test_results_do_not_depend_on_the_number_of_buckets(spark, sample, monkeypatch):
    told = lambda: (sorted(map(tuple, suffix_dedup.repeated_bytes(sample).collect())), sorted(map(tuple, weighted_minhash.near_documents(sample).collect())))
    few = told()
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 5000)
    assert told() == few


def test_frequency_codes_do_not_saturate():
    import numpy as np

    codes = weighted_minhash.code_of(np.array([1, 2, 1 << 32, 1 << 50, 1 << 60]))
    assert len(set(codes.tolist())) == 5


def test_tables_of_this_application_are_dropped_alone(spark, sample):
    exchange.chunk_table(sample)
    common.materialize(sample)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(common.shared_dir(spark))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    other = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{common.shared_dir(spark)}/tessera-other-app")
    fs.mkdirs(other)
    common.drop_tables(spark)
    left = [s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("tessera-")]
    assert left == ["tessera-other-app"] and not [t for t in spark.catalog.listTables() if t.name.startswith("tessera_")]
