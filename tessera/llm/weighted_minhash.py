"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

Shingles of five words weigh tf * idf; document frequencies are counted over all documents by an exchange of packed
hashes. Consistent weighted samples (with a pool of gamma and uniform variates addressed by the hash of the shingle)
agree for two documents with the probability of their weighted Jaccard similarity. Bands of samples give
candidate buckets; in each bucket every document is paired with two leaders first. Then all pairs of a bucket that are
not in one component yet are compared, save those whose whole weights differ too much to be similar; large buckets are
compared in blocks. Pairs are verified by exact weighted Jaccard similarity >= 0.8 and united to components. Equal word
sequences are joined before, so copies cost nothing.

The idf is damped: 1 + 0.25 * log((n + 1) / (df + 1)) / log(n + 1). A rare shingle then weighs up to a quarter more than
one found everywhere, so the copies of a large group, whose common shingles are frequent, stay similar. The tf is damped
alike, 1 + 0.25 * log(count), so that one line repeated hundreds of times does not make two texts alike.

Defined results: null texts, and texts without a word, are each a class of their own; a text of fewer than five words
is one shingle; texts of any length are compared whole; words are compared in lower case without ASCII punctuation; rows that repeat
a doc_id are one document (their texts may unite classes) and get one result row each; rows without a doc_id are not compared: each
is kept, with a null class_id; an empty table gives an empty result; other columns of the input are ignored (kept by keep_one).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import free_names, materialize, read, release
from tessera.llm.components import components
from tessera.llm.embedding_dedup import local_roots
from tessera.llm.exchange import answers, chunk_table, each_chunk, exchange_buckets, joined, part_of, received, send, unpack_arrays, pack_arrays
from tessera.llm.ngrams import Batch, mix, pieces

WIDTH = 5
SIMILAR = 0.8
BANDS, ROWS = 10, 3
DAMPING = 0.25
#: Codes of a document frequency for each doubling.
STEPS = 4.0
#: Buckets of more documents are compared in blocks, of at most about so many rows and so much weight.
SMALL = 64
BLOCK_ROWS, BLOCK_WEIGHT = 512, 250_000
POOL_BITS = 16
_SPACES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_hashes(text: bytes) -> np.ndarray:
    plain = text.decode("utf-8", "replace").lower().encode().translate(_SPACES)
    found = [Batch(group).words()[0] for _, group in pieces([plain])]
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingles(words: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles and how often each occurs."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    size = max(1, n - width + 1)
    key = np.zeros(size, np.uint64)
    for k in range(min(width, n)):
        key = key * np.uint64(0xD6E8FEB86659FD93) + words[k : k + size]
        key ^= key >> np.uint64(31)
    return np.unique(mix(key), return_counts=True)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


def chunk_shingles(texts: list[bytes], n_buckets: int):
    """Each text's (words, shingles, counts), and the chunk's distinct shingles in order of bucket and hash with their frequency."""
    rows = []
    for text in texts:
        words = word_hashes(text)
        rows.append((words, *shingles(words)))
    keys, held = np.unique(np.concatenate([r[1] for r in rows] or [np.empty(0, np.uint64)]), return_counts=True)
    order = np.argsort(bucket_of(keys, n_buckets), kind="stable")
    return rows, keys, held, order


def low_bytes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """40 bits of each key, as 32 and 8 bits."""
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), ((keys >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8)


def code_of(df: np.ndarray) -> np.ndarray:
    """A frequency in steps of a quarter of a doubling, which one byte holds for any number of documents."""
    return np.rint(STEPS * np.log2(np.maximum(df, 1))).astype(np.uint8)


def sum_frequencies(packed: list[bytes]) -> list[bytes]:
    parts = [unpack_arrays(p) for p in packed]
    low, high = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    held = np.concatenate([p[2] for p in parts]).astype(np.int64)
    _, at = np.unique(low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)), return_inverse=True)
    code = code_of(np.bincount(at, held)[at])
    ends = np.cumsum([len(p[0]) for p in parts])
    return [pack_arrays(c) for c in np.split(code, ends[:-1])]


def frequencies(chunks: DataFrame, n_buckets: int) -> DataFrame:
    """Answers with the document frequency code of each distinct shingle of each chunk."""

    def emit(chunk, ids, texts):
        _, keys, held, order = chunk_shingles(texts, n_buckets)
        keys, held = keys[order], held[order]
        yield from send(chunk, bucket_of(keys, n_buckets), *low_bytes(keys), held.astype(np.uint16))  # a chunk has fewer rows

    return answers(each_chunk(chunks, emit, "bucket int, chunk long, packed binary"), sum_frequencies)


class Sampler:
    """Consistent weighted samples with pooled variates."""

    def __init__(self, n: int = BANDS * ROWS, seed: int = 23):
        chance = np.random.default_rng(seed)
        size = 1 << POOL_BITS
        self.n = n
        self.r = chance.gamma(2.0, 1.0, size).astype(np.float32)
        self.log_c = np.log(chance.gamma(2.0, 1.0, size)).astype(np.float32)
        self.beta = chance.uniform(0, 1, size).astype(np.float32)
        self.odd = chance.integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def samples(self, keys: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(texts, n) sample values; text i has the keys from starts[i] on, and one at least."""
        out = np.empty((len(starts), self.n), np.uint64)
        log_w = np.log(weights).astype(np.float32)
        sizes = np.diff(np.r_[starts, len(keys)])
        for k in range(self.n):
            at = (keys * self.odd[k]) >> np.uint64(64 - POOL_BITS)
            r = self.r[at]
            beta = self.beta[at]
            t = np.floor(log_w / r + beta)
            log_a = self.log_c[at] - r * (t - beta + 1)
            least = np.repeat(np.minimum.reduceat(log_a, starts), sizes)
            value = mix(keys + t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            value[log_a > least] = np.uint64(0xFFFFFFFFFFFFFFFF)  # ties go to the least value
            out[:, k] = np.minimum.reduceat(value, starts)
        return out


def weights_of(count: np.ndarray, code: np.ndarray, n_docs: int, damping: float = DAMPING) -> np.ndarray:
    df = np.exp2(code / STEPS)
    tf = 1 + damping * np.log(count)
    return tf * (1 + damping * np.maximum(np.log((n_docs + 1) / (df + 1)), 0) / np.log(n_docs + 1.5))


def coded(texts, found, n_buckets):
    """Each text's words, shingles, counts and frequency codes."""
    rows, keys, _, order = chunk_shingles(texts, n_buckets)
    codes = np.empty(len(keys), np.uint8)
    if len(keys):
        codes[order] = received(found)[0]
    return [(words, s, c, codes[np.searchsorted(keys, s)]) for words, s, c in rows]


def signatures(chunks: DataFrame, found: DataFrame, n_buckets: int, n_docs: int) -> DataFrame:
    """doc_id, chunk, a digest of the word sequence, the samples and the whole weight of each document with words."""

    def emit(chunk, ids, texts, found):
        sampler = worker_sampler()
        rows = coded(texts, found, n_buckets)
        some = [i for i, r in enumerate(rows) if len(r[1])]
        # Some texts at a time: bounded arrays whatever the chunk holds.
        start = 0
        while start < len(some):
            end, size = start, 0
            while end < len(some) and (end == start or size + len(rows[some[end]][1]) < 200_000):
                size += len(rows[some[end]][1])
                end += 1
            part = some[start:end]
            start = end
            keys = np.concatenate([rows[i][1] for i in part])
            weights = np.concatenate([weights_of(rows[i][2], rows[i][3], n_docs) for i in part])
            starts = np.cumsum([0, *(len(rows[i][1]) for i in part[:-1])])
            values = sampler.samples(keys, weights, starts)
            digests = [hashlib.blake2b(rows[i][0].tobytes(), digest_size=16).digest() for i in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[part]), pa.array(np.full(len(part), chunk, np.int64)), pa.array(digests, pa.binary()), pa.array(values.view(np.int64).tolist(), pa.list_(pa.int64())), pa.array(np.add.reduceat(weights, starts))],
                ["doc_id", "chunk", "digest", "samples", "weight"],
            )

    return each_chunk(joined(chunks, found), emit, "doc_id long, chunk long, digest binary, samples array<long>, weight double")


def worker_sampler() -> Sampler:
    import sys
    import types

    store = sys.modules.setdefault("_tessera_worker_cache", types.ModuleType("_tessera_worker_cache")).__dict__
    if "sampler" not in store:
        store["sampler"] = Sampler()
    return store["sampler"]


def band_keys():
    """The bucket key of each band, as a column."""
    return F.array(*(F.xxhash64(*(F.element_at("samples", b * ROWS + k + 1) for k in range(ROWS))) for b in range(BANDS)))


def bucket_rows(documents: DataFrame) -> DataFrame:
    """band, key, doc_id and weight of each document and band, of buckets with two documents at least."""
    rows = documents.select("doc_id", "weight", F.posexplode(band_keys()).alias("band", "key"))
    return rows.join(rows.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1"), ["band", "key"])


def leader_pairs(rows: DataFrame) -> DataFrame:
    """a, b: each document of a bucket with the bucket's least id and with its least hash of an id."""
    leaders = rows.groupBy("band", "key").agg(F.min("doc_id").alias("first"), F.min(F.struct(F.xxhash64("doc_id", "band").alias("h"), "doc_id"))["doc_id"].alias("second"))
    paired = rows.join(leaders, ["band", "key"])
    return paired.select(F.col("doc_id").alias("a"), F.explode(F.array_distinct(F.array("first", "second"))).alias("b")).where("a <> b").distinct()


def groups(links: DataFrame, hops: int = 2) -> DataFrame:
    """doc_id and group, the least document within some hops: documents of a group are linked, if not all linked ones are in it."""
    ends = links.select(F.col("a").alias("doc_id"), F.col("b").alias("other")).union(links.select("b", "a"))
    found = ends.groupBy("doc_id").agg(F.least(F.min("other"), F.col("doc_id")).alias("group"))
    for _ in range(hops - 1):
        further = ends.join(found.select(F.col("doc_id").alias("other"), "group"), "other").groupBy("doc_id").agg(F.min("group").alias("further"))
        found = found.join(further, "doc_id").select("doc_id", F.least("group", "further").alias("group"))
    return found


def mixed_rows(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of buckets that hold documents of two groups at least, with their group as component."""
    placed = rows.join(groups(links).withColumnRenamed("group", "component"), "doc_id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "doc_id"))
    mixed = placed.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return placed.join(mixed.select("band", "key"), ["band", "key"])


def hub_pairs(rows: DataFrame, links: DataFrame) -> DataFrame:
    """a, b: each document of a bucket outside the component of the bucket's most linked document, with that document."""
    degrees = links.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("degree"))
    known = rows.join(degrees, "doc_id", "left")
    hubs = known.groupBy("band", "key").agg(F.max(F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), F.xxhash64("doc_id").alias("h"), "doc_id", "component")).alias("hub"))
    return rows.join(hubs, ["band", "key"]).where("component <> hub.component").select(F.col("doc_id").alias("a"), F.col("hub.doc_id").alias("b")).distinct()


def can_be(x, y, similar: float):
    """Sets of weights x and y may have the similarity, which is at most the lesser weight over the greater."""
    return F.least(x, y) >= F.lit(similar * (1 - 1e-9)) * F.greatest(x, y)


def small_pairs(rows: DataFrame, similar: float) -> DataFrame:
    """a, b: all pairs of buckets whose components are unlike and whose weights allow the similarity."""
    x = rows.select("band", "key", F.col("doc_id").alias("a"), F.col("component").alias("ca"), F.col("weight").alias("wa"))
    y = rows.select("band", "key", F.col("doc_id").alias("b"), F.col("component").alias("cb"), F.col("weight").alias("wb"))
    return x.join(y, ["band", "key"]).where("a > b AND ca <> cb").where(can_be("wa", "wb", similar)).select("a", "b").distinct()


def shared_weights(left: list, right: list, n_docs: int) -> np.ndarray:
    """Sums of the lesser weights of the shared shingles, of each set of left with each of right."""
    sets = left + right
    owner = np.repeat(np.arange(len(sets)), [len(x[0]) for x in sets])
    keys, counts, codes = (np.concatenate([x[k] for x in sets]) for k in range(3))
    order = np.lexsort((counts, keys))
    owner, keys, counts, codes = owner[order], keys[order], counts[order].astype(np.int64), codes[order]
    # A step is a distinct count of a shingle; its weight is what it adds to the step below.
    new_key = np.r_[True, keys[1:] != keys[:-1]]
    new = new_key | np.r_[True, counts[1:] != counts[:-1]]
    step = np.cumsum(new) - 1
    total = weights_of(counts[new], codes[new], n_docs)
    gain = np.where(new_key[new], total, total - np.r_[0.0, total[:-1]])
    first = np.maximum.accumulate(np.where(new_key[new], np.arange(len(total)), 0))
    spans = step - first[step] + 1
    entry = np.repeat(np.arange(len(step)), spans)
    column = np.repeat(first[step], spans) + np.arange(len(entry)) - np.repeat(np.cumsum(spans) - spans, spans)
    row = owner[entry]
    both = (np.bincount(column[row < len(left)], minlength=len(total)) > 0) & (np.bincount(column[row >= len(left)], minlength=len(total)) > 0)
    place = np.cumsum(both) - 1
    row, column = row[both[column]], column[both[column]]
    column, value = place[column], np.sqrt(gain[column])
    order = np.argsort(column, kind="stable")
    row, column, value = row[order], column[order], value[order]
    out = np.zeros((len(left), len(right)))
    for start in range(0, int(both.sum()), 2048):
        part = slice(*np.searchsorted(column, [start, start + 2048]))
        dense = np.zeros((len(sets), 2048))
        dense[row[part], column[part] - start] = value[part]
        out += dense[: len(left)] @ dense[len(left) :].T
    return out


def block_links(rows: DataFrame, documents: DataFrame, sets: DataFrame, n_docs: int, similar: float) -> DataFrame:
    """Links a, b among all pairs of unlike components in the buckets, block by block.

    Rows outside a bucket's largest component meet all others; blocks are levels of weight (similar texts lie in one
    level or in two adjacent ones), salted so that each is bounded in rows and shingles. A pair of documents is compared in
    the first band that they share only.
    """
    largest = rows.groupBy("band", "key", "component").agg(F.count("*").alias("n")).groupBy("band", "key").agg(F.max(F.struct("n", "component"))["component"].alias("main"))
    level = F.floor(F.log("weight") / F.lit(-np.log(similar) * (1 + 1e-9))).cast("int")
    placed = rows.drop("n").join(largest, ["band", "key"]).withColumn("rest", F.col("component") != F.col("main")).withColumn("level", level).drop("main")
    place = ["band", "key", "level", "rest"]
    sizes = placed.groupBy(*place).agg(F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("weight") / BLOCK_WEIGHT)).alias("blocks"))
    placed = placed.join(sizes, place).withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks")).drop("blocks")
    blocks = sizes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    one = blocks.where("rest").select("band", "key", F.col("level").alias("l1"), F.col("block").alias("b1"))
    two = blocks.select("band", "key", F.col("level").alias("l2"), F.col("block").alias("b2"), F.col("rest").alias("r2"))
    met = one.join(two, ["band", "key"]).where("abs(l1 - l2) <= 1 AND (NOT r2 OR l1 < l2 OR (l1 = l2 AND b1 <= b2))")
    met = met.withColumn("pair", F.struct("band", "key", "l1", "b1", "l2", "b2", "r2"))
    same = F.expr("r2 AND l1 = l2 AND b1 = b2")
    lefts = met.select("pair", "band", "key", F.col("l1").alias("level"), F.lit(True).alias("rest"), F.col("b1").alias("block"), F.when(same, 2).otherwise(0).alias("side"))
    rights = met.where(~same).select("pair", "band", "key", F.col("l2").alias("level"), F.col("r2").alias("rest"), F.col("b2").alias("block"), F.lit(1).alias("side"))
    rows = placed.join(lefts.union(rights), [*place, "block"]).select(F.xxhash64("pair").alias("pair"), "side", "band", "doc_id", "component", "weight")
    rows = rows.join(documents.select("doc_id", band_keys().alias("keys")), "doc_id").join(sets, "doc_id")

    def compare(table: pa.Table) -> pa.Table:
        side, ids, component, weight = (table.column(c).to_numpy() for c in ("side", "doc_id", "component", "weight"))
        band = table.column("band")[0].as_py()
        keys = np.array(table.column("keys").to_pylist(), np.int64).reshape(len(ids), BANDS)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        need = component[left][:, None] != component[right]
        x, y = weight[left][:, None], weight[right]
        need &= np.minimum(x, y) >= similar * (1 - 1e-9) * np.maximum(x, y)
        if len(side) and side[0] == 2:
            need &= left[:, None] < right
        for k in range(band):
            need &= keys[left, k][:, None] != keys[right, k]
        i, j = np.flatnonzero(need.any(1)), np.flatnonzero(need.any(0))
        left, right, need = left[i], right[j], need[np.ix_(i, j)]
        packed = table.column("packed")
        held = {k: unpack_arrays(packed[k].as_py()) for k in np.union1d(left, right).tolist()}
        close = np.zeros(need.shape, bool)
        if need.sum() * 32 < need.size:
            unsure = need
        elif need.size:
            both = shared_weights([held[k] for k in left.tolist()], [held[k] for k in right.tolist()], n_docs)
            ratio = both / (weight[left][:, None] + weight[right] - both)
            close, unsure = need & (ratio >= similar), need & (np.abs(ratio - similar) < 1e-6)
        else:
            unsure = need
        for i, j in np.argwhere(unsure).tolist():
            close[i, j] = weighted_jaccard(held[int(left[i])], held[int(right[j])], n_docs) >= similar
        i, j = np.nonzero(close)
        root = local_roots(len(ids), left[i], right[j])
        child = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"a": ids[child], "b": ids[root[child]]})

    return rows.groupBy("pair").applyInArrow(compare, "a long, b long")


def weighted_sets(chunks: DataFrame, found: DataFrame, wanted: DataFrame, n_buckets: int) -> DataFrame:
    """doc_id and the packed (shingle, count, code) arrays of the wanted documents (doc_id, chunk)."""
    lists = wanted.groupBy(part_of("chunk")).agg(F.collect_set(F.struct("chunk", "doc_id")).alias("answers"))

    def emit(chunk, ids, texts, found, wanted):
        wanted = {x["doc_id"] for x in wanted or ()}
        part = [i for i, key in enumerate(ids.tolist()) if key in wanted]
        if not part:
            return
        rows, keys, _, order = chunk_shingles(texts, n_buckets)
        codes = np.empty(len(keys), np.uint8)
        codes[order] = received(found)[0]
        made = [pack_arrays(rows[i][1], rows[i][2].astype(np.uint32), codes[np.searchsorted(keys, rows[i][1])]) for i in part]
        yield pa.RecordBatch.from_arrays([pa.array(ids[part]), pa.array(made, pa.binary())], ["doc_id", "packed"])

    return each_chunk(joined(chunks, found, lists), emit, "doc_id long, packed binary")


def weighted_jaccard(x: list[np.ndarray], y: list[np.ndarray], n_docs: int) -> float:
    wx, wy = weights_of(x[1], x[2], n_docs), weights_of(y[1], y[2], n_docs)
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = np.minimum(wx[i], wy[j]).sum()
    return float(both / (wx.sum() + wy.sum() - both))


def verified(pairs: DataFrame, sets: DataFrame, n_docs: int, similar: float = SIMILAR) -> DataFrame:
    """The distinct pairs a, b with weighted Jaccard similarity >= similar."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("packed").alias("x"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("packed").alias("y"))

    def apply(batches):
        last, right = None, None
        for batch in batches:
            a, b, keep = batch.column("a"), batch.column("b"), []
            for key, x, y in zip(b.to_pylist(), batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                if key != last:
                    last, right = key, unpack_arrays(y)
                keep.append(weighted_jaccard(unpack_arrays(x), right, n_docs) >= similar)
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(apply, "a long, b long")


def near_documents(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class) and kept (the document of that id) of each document."""
    sound = docs.where(F.col("doc_id").isNotNull())
    chunks = chunk_table(sound)
    n_buckets = exchange_buckets(chunks)
    n_docs = sound.count()
    found = materialize(frequencies(chunks, n_buckets), codec="none", compact=True)
    signed = materialize(signatures(chunks, found, n_buckets, n_docs))
    # Equal word sequences: one of them goes on.
    firsts = materialize(signed.groupBy("digest").agg(F.min(F.struct("doc_id", "chunk", "samples", "weight")).alias("r")).select("digest", "r.*"), compact=True)
    copies = signed.select("doc_id", "digest").join(firsts.select("digest", F.col("doc_id").alias("first")), "digest").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))

    rows = materialize(bucket_rows(firsts), compact=True)
    wanted = firsts.select("doc_id", "chunk").join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = materialize(weighted_sets(chunks, found, wanted, n_buckets), codec="none", compact=True)
    tried = leader_pairs(rows)
    links = materialize(verified(tried, sets, n_docs, similar), compact=True)
    mixed = materialize(mixed_rows(rows, links), compact=True)
    large = F.col("n") > SMALL
    if mixed.where(large).head(1):
        # Large buckets: the most linked document is a third leader, so that most rows of a group are united.
        links = links.union(materialize(verified(hub_pairs(mixed.where(large), links), sets, n_docs, similar), compact=True))
        mixed = materialize(mixed_rows(rows, links), compact=True)
        links = links.union(materialize(block_links(mixed.where(large), firsts, sets, n_docs, similar), compact=True))
    pairs = materialize(small_pairs(mixed.where(~large), similar).join(tried, ["a", "b"], "left_anti"), compact=True)
    if pairs.head(1):
        links = links.union(verified(pairs, sets, n_docs, similar))
    found_classes = components(links.union(copies))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found_classes, F.col("doc_id") == F.col("vertex"), "left")
    return out.select("doc_id", F.coalesce("component", "doc_id").alias("class_id"), F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One document of each class, with all columns; of rows that repeat a kept doc_id all stay."""
    (name,) = free_names(docs.columns, "gone")
    gone = near_documents(docs, similar).where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(read(spark, sf_dir, "documents"))
