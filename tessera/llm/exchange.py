"""Chunks of documents and an exchange of packed keys among them.

Documents are packed once, without a shuffle, into chunks of some megabytes that lie compressed in a bucketed table
of the shared folder. An exchange then sends the distinct hashed keys of each chunk to the buckets of the keys and
brings one small answer for each key back to the chunk. A key that a third of all documents hold is sent once for
each chunk at most, so no bucket grows with the number of documents that hold it. Chunks and answers meet by a join
on the chunk; the chunk table is bucketed by it, so texts are never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import own_path, own_table, partitions, release, small_batches

#: Bytes of a chunk: texts, other columns that are carried along, and ROW for each row; a longer row makes a chunk of its own.
#: So a chunk has CHUNK / ROW rows at most, under 2**16.
CHUNK, ROW = 1 << 20, 24
#: Bytes of packed chunks for each bucket of an exchange, at most: what a bucket is sent grows with them.
BUCKET_BYTES = 32 << 20
#: What stands for a null id inside chunks: less than any other.
NULL_ID = -(1 << 63)
#: How JSON holds times, to the microsecond.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Bits of a chunk's number within its part.
SEQUENCE = 20
CHUNK_SCHEMA = "chunk long, docs binary"
PACKED_SCHEMA = "bucket int, chunk long, packed binary"


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def expand(raw: bytes) -> bytes:
    return pa.Codec("zstd").decompress(raw[8:], int.from_bytes(raw[:8], "little"), asbytes=True)


def pack_docs(ids: list[int], texts: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return squeeze(len(ids).to_bytes(8, "little") + np.array(ids, np.int64).tobytes() + sizes.tobytes() + b"".join(texts))


def unpack_docs(packed: bytes) -> tuple[np.ndarray, list[bytes]]:
    raw = expand(packed)
    n = int.from_bytes(raw[:8], "little")
    ids, sizes = np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, np.int64, n, 8 + 8 * n)
    ends = np.cumsum(sizes) + 8 + 16 * n
    return ids, [raw[end - size : end] for end, size in zip(ends.tolist(), sizes.tolist())]


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of one-byte planes of integers: alike bytes lie together, which compresses."""
    head = [len(arrays)]
    body = []
    for a in arrays:
        width = a.dtype.itemsize
        head += [len(a), ord(a.dtype.kind), width]
        body.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), width).T.tobytes() if len(a) else b"")
    return squeeze(np.array(head, np.int64).tobytes() + b"".join(body))


def unpack_arrays(packed: bytes) -> list[np.ndarray]:
    raw = expand(packed)
    count = int.from_bytes(raw[:8], "little")
    head = np.frombuffer(raw, np.int64, 3 * count, 8).reshape(count, 3)
    at, out = 8 + 24 * count, []
    for n, kind, width in head.tolist():
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(f"{chr(kind)}{width}").reshape(n))
        at += n * width
    return out


def chunk_table(docs: DataFrame, limit: int = CHUNK, carry: str = "") -> DataFrame:
    """The chunks of docs (doc_id, text), bucketed by chunk. Null texts are empty; null ids are NULL_ID.

    With carry, a third column holds each row's other columns as JSON, and by that name whether its text is null.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n_buckets = buckets(spark)
    names = ["chunk", "docs", *(["rest"] if carry else [])]

    def apply(batches):
        from pyspark import TaskContext

        number = part_key(TaskContext.get().partitionId(), n_buckets) << SEQUENCE
        ids: list[int] = []
        texts: list[bytes] = []
        rest: list[bytes] = []
        size = 0

        def row():
            packed = [pack_docs(ids, texts), *([pack_docs(ids, rest)] if carry else [])]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([p], pa.binary()) for p in packed)], names)

        for batch in batches:
            others = batch.column(2).to_pylist() if carry else [b""] * batch.num_rows
            for key, text, other in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), others):
                text = text or b""
                more = len(text) + len(other) + ROW
                if ids and size + more > limit:
                    yield row()
                    number, ids, texts, rest, size = number + 1, [], [], [], 0
                ids.append(NULL_ID if key is None else key)
                texts.append(text)
                rest.append(other)
                size += more
        if ids:
            yield row()
        release()

    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"), F.col("text").isNull().alias(carry or "null"))
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"), *([F.to_json(others, TIMES).cast("binary").alias("rest")] if carry else [])]
    rows = docs.select(*columns).mapInArrow(apply, CHUNK_SCHEMA + (", rest binary" if carry else ""))
    name = own_table(spark)
    path = own_path(spark, name)
    rows = rows.select(part_of("chunk"), "*")
    rows.write.format("parquet").option("compression", "none").option("path", path).bucketBy(n_buckets, "part").saveAsTable(name)
    return spark.table(name)


def part_of(chunk: str):
    """The part of a chunk: all chunks that one task packed."""
    return F.shiftright(chunk, SEQUENCE).alias("part")


def _bucket(key: int, n: int) -> int:
    """The bucket that Spark gives a long key (Murmur3, seed 42)."""
    mask = 0xFFFFFFFF

    def turn(x: int, by: int) -> int:
        return ((x << by) | (x >> (32 - by))) & mask

    h = 42
    for word in (key & mask, (key >> 32) & mask):
        word = (turn((word * 0xCC9E2D51) & mask, 15) * 0x1B873593) & mask
        h = (turn(h ^ word, 13) * 5 + 0xE6546B64) & mask
    h ^= 8
    h = ((h ^ (h >> 16)) * 0x85EBCA6B) & mask
    h = ((h ^ (h >> 13)) * 0xC2B2AE35) & mask
    h ^= h >> 16
    return (h - (1 << 32) if h >> 31 else h) % n


def part_key(task: int, n: int) -> int:
    """A key of the task's own that falls into bucket task modulo n, so that parts lie evenly in the buckets."""
    key = task << 16
    while _bucket(key, n) != task % n and key - (task << 16) < 65535:
        key += 1
    return key


def buckets(spark) -> int:
    return max(1, partitions(spark))


def exchange_buckets(chunks: DataFrame) -> int:
    """How many buckets an exchange among the chunks has: some for each shuffle partition, more if the table asks for it.

    A bucket is reduced in one task's memory, so its share of the table is bounded whatever the session's settings.
    """
    size = int(str(chunks._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(3 * partitions(chunks.sparkSession), -(-size // BUCKET_BYTES))


def each_chunk(rows: DataFrame, function, schema: str) -> DataFrame:
    """function(chunk, ids, texts, *rest) over each chunk row (chunk, docs, rest...), giving record batches."""
    rows = rows.drop("part")
    names = rows.columns[2:]

    def apply(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, texts = unpack_docs(batch.column("docs")[i].as_py())
                yield from function(batch.column("chunk")[i].as_py(), ids, texts, *(batch.column(n)[i].as_py() for n in names))
        release()

    return rows.mapInArrow(apply, schema)


def send(chunk: int, bucket: np.ndarray, *columns: np.ndarray):
    """Packed rows of a chunk whose entries are in order of bucket."""
    if not len(bucket):
        return
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.r_[starts[1:], len(bucket)]
    packed = [pack_arrays(*(c[s:e] for c in columns)) for s, e in zip(starts, ends)]
    yield pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), pa.array(np.full(len(starts), chunk, np.int64)), pa.array(packed, pa.binary())], ["bucket", "chunk", "packed"])


def answers(sent: DataFrame, reduce) -> DataFrame:
    """One row for each part: its chunks' answers (chunk, bucket, packed), from reduce(list of packed) -> list of packed."""

    def apply(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        made = reduce(table.column("packed").to_pylist())
        release()
        return pa.table({"bucket": table.column("bucket").combine_chunks(), "chunk": table.column("chunk").combine_chunks(), "packed": pa.array(made, pa.binary())})

    replied = sent.groupBy("bucket").applyInArrow(apply, PACKED_SCHEMA)
    return replied.groupBy(part_of("chunk")).agg(F.collect_list(F.struct("chunk", "bucket", "packed")).alias("answers"))


def joined(chunks: DataFrame, *replies: DataFrame) -> DataFrame:
    """Chunks with one column of answers for each exchange; a chunk without answers has null."""
    out = chunks
    for k, reply in enumerate(replies):
        out = out.join(reply.withColumnRenamed("answers", f"answers{k}").hint("shuffle_hash"), "part", "left")
    own = [F.filter(f"answers{k}", lambda x: x["chunk"] == F.col("chunk")).alias(f"answers{k}") for k in range(len(replies))]
    return out.select("chunk", "docs", *own, *(c for c in chunks.columns if c == "rest"))


def received(found) -> list[np.ndarray]:
    """The answers of a chunk, in order of bucket, each column joined."""
    parts = [unpack_arrays(x["packed"]) for x in sorted(found or [], key=lambda x: x["bucket"])]
    return [np.concatenate(c) for c in zip(*parts)] if parts else []
