"""What the operators of this subpackage share: tables on shared storage, Arrow batches, text helpers."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch handed to Python; long documents make batches short.
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20
#: Bytes in memory of a file of a compact table.
FILE_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder, through Spark's reader (any file system that Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: spark.checkpoint.dir; a folder of our own only where that is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("/tmp/checkpoints")
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def own_path(spark: SparkSession, name: str = "") -> str:
    """A new path of this application in the shared folder."""
    return f"{shared_dir(spark)}/tessera-{spark.sparkContext.applicationId}-{name or uuid.uuid4().hex}"


def own_table(spark: SparkSession) -> str:
    """A new name for a table of this application; its files go to own_path(spark, name)."""
    return f"{own_prefix(spark)}{uuid.uuid4().hex}"


def own_prefix(spark: SparkSession) -> str:
    return "tessera_" + re.sub(r"\W", "_", spark.sparkContext.applicationId).lower() + "_"


def materialize(df: DataFrame, codec: str = "zstd", compact: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, and a lost executor costs a reread only.

    compact is for tables that may be small: they are measured first and written as few files as their size asks for.
    """
    spark = df.sparkSession
    path = own_path(spark)
    if not compact:
        df.write.option("compression", codec).parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    held = df.persist(StorageLevel.DISK_ONLY)
    held.count()
    size = int(str(held._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    held.coalesce(max(1, -(-size // FILE_BYTES))).write.option("compression", codec).parquet(path)
    held.unpersist()
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> None:
    """Delete every table that this application left in the shared folder and in the catalog; those of others stay."""
    for table in spark.catalog.listTables():
        if table.name.startswith(own_prefix(spark)):
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(own_path(spark, "*"))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(path) or []:
        fs.delete(found.getPath(), True)


def free_names(columns: list[str], *names: str) -> list[str]:
    """The names, each made unlike every one of the columns (Spark's names differ by more than case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod4(doc_id) -> int:
    """crc32 of the id as text, modulo 4: remainder 2 marks held-out rows."""
    return zlib.crc32(str(doc_id).encode()) % 4


def held_out_column(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def map_texts(df: DataFrame, schema, row_function_factory, key: str = "doc_id", text: str = "text", limit: int = 4 << 20) -> DataFrame:
    """Apply a function to whole texts, batch by batch, in Python.

    row_function_factory() is called once for each task and returns f(keys, texts) -> pyarrow.RecordBatch columns;
    keys and texts are Python lists, a null text is None.
    """
    small_batches(df.sparkSession)
    names = [x.strip().split()[0] for x in schema.split(",")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = row_function_factory()
        for batch in batches:
            for keys, texts in slices(batch.column(0), batch.column(1), limit):
                columns = function(keys, texts)
                yield pa.RecordBatch.from_arrays(columns, names)
        release()

    return df.select(key, F.col(text).cast("string").alias("text")).mapInArrow(apply, schema)


def worker_cache(key, make):
    """What make() gave first for this key in this Python worker: functions are sent by value, so their globals do not last."""
    import sys
    import types

    store = sys.modules.setdefault("_tessera_worker_cache", types.ModuleType("_tessera_worker_cache")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def release() -> None:
    """Give memory that is free in this Python worker back to the system: workers outlive their tasks."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(keys: pa.Array, texts: pa.Array, limit: int = 4 << 20):
    """Lists of keys and texts of some limit bytes; a longer text comes alone."""
    if not len(texts):
        return
    texts = texts.cast(pa.large_string())
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield keys[start:i].to_pylist(), texts[start:i].to_pylist()
            start, size = i, 0
        size += int(n)
    yield keys[start:].to_pylist(), texts[start:].to_pylist()
