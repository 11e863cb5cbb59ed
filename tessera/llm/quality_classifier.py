"""Supervised subword embeddings for quality.

A document is the mean of the learned vectors of its hashed words, word pairs and character n-grams; a softmax layer
on that mean gives the classes. numpy stochastic gradient descent trains both on the driver, from a bounded
sample of labelled rows. As the layer is linear in the mean, a trained model scores with one number for each
bucket (vector times layer), so whole texts are scored by table lookups.

The sample is drawn by hashes, so it depends neither on partitions nor on the order of rows: distinct labelled documents
first, then pieces of TRAIN_CHARACTERS of their texts, so that a long text is learned from too.

Defined results: null and empty texts have the mean 0 and score by the layer's bias; texts of any length are scored whole;
null labels and null ids are not learned from; a label repeated for one document counts once, unlike labels of it once each;
rows that repeat a doc_id are learned from and scored each; with no labelled row of either class all scores are the smoothed
share of label 1 (0.5 without labels); a null doc_id stays null and is not held out; an empty table gives an empty result; other
columns of the input are ignored (kept by keep_good).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod4, held_out_column, map_texts, read, release, small_batches
from tessera.llm.ngrams import Batch, Characters, mix, pieces, raw_bytes

#: The training sample: pieces of labelled texts of each class, at most, and the characters of a piece.
TRAIN_ROWS, TRAIN_CHARACTERS = 1500, 20_000
BITS = 18
DIM = 16
EPOCHS = 6
RATE = 0.6
SIZES = (3, 5)
THRESHOLD = 0.7
#: Hash of the pair of a word with itself.
TWICE = 0x5EED << 48


def buckets(batch: Batch) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text of each feature, by kind."""
    shift, out = np.uint64(64 - BITS), []
    characters = Characters(batch)
    for n in SIZES:
        key, cross = characters.windows(n)
        key = (mix(key + np.uint64(n << 56)) >> shift).astype(np.int32)
        owner = np.repeat(np.arange(len(characters.sizes)), characters.sizes)[: len(key)]
        out.append((np.delete(key, cross), np.delete(owner, cross)))
    words, owner = batch.words()
    out.append(((words >> shift).astype(np.int32), owner))
    pairs, owner = word_pairs(words, owner)
    out.append(((pairs >> shift).astype(np.int32), owner))
    return out


def word_pairs(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each pair of neighbouring words of one text, and the text; a word said twice is one feature for all words."""
    same = owner[1:] == owner[:-1]
    pairs = np.where(words[:-1] == words[1:], np.uint64(TWICE), mix(words[:-1] * np.uint64(31) + words[1:]))
    return pairs[same], owner[1:][same]


class Model:
    """Vectors of all buckets, output layer and bias."""

    def __init__(self, classes: int = 2, seed: int = 7):
        chance = np.random.default_rng(seed)
        self.vectors = chance.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
        self.layer = np.zeros((DIM, classes), np.float32)
        self.bias = np.zeros(classes, np.float32)

    def train(self, texts: list[bytes], labels: np.ndarray, seed: int = 11) -> "Model":
        rows = []
        for raw in texts:
            found = [b for _, group in pieces([raw]) for b, _ in buckets(Batch(group))]
            ids, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int32), np.empty(0))
            rows.append((ids.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)))
        chance, step, steps = np.random.default_rng(seed), 0, EPOCHS * len(rows)
        for _ in range(EPOCHS):
            for i in chance.permutation(len(rows)):
                rate = RATE * (1 - step / steps)
                step += 1
                ids, share = rows[i]
                mean = share @ self.vectors[ids]
                logits = mean @ self.layer + self.bias
                p = np.exp(logits - logits.max())
                p /= p.sum()
                p[labels[i]] -= 1
                change = (self.layer @ p) * rate
                self.layer -= rate * np.outer(mean, p)
                self.bias -= 0.1 * rate * p
                # The share of a bucket is small, so its step is scaled by the number of buckets, held to keep steps stable.
                self.vectors[ids] -= np.outer(share * min(len(ids), 200), change)
        return self

    def table(self) -> tuple[np.ndarray, float]:
        """One number for each bucket, and the bias: the logit of class 1 against class 0."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def logits(texts: list[bytes], table: np.ndarray, bias: float) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for rows, group in pieces(texts):
        batch = Batch(group)
        shift = np.uint64(64 - BITS)
        sums, n = np.zeros(len(rows)), np.zeros(len(rows))
        characters = Characters(batch)
        for size in SIZES:
            key, cross = characters.windows(size)
            value = table[mix(key + np.uint64(size << 56)) >> shift]
            value[cross] = 0
            sums += characters.sums(value.astype(np.float64))
            n += np.maximum(characters.sizes - size + 1, 0)
        words, owner = batch.words()
        sums += np.bincount(owner, table[words >> shift], len(rows))
        n += np.bincount(owner, minlength=len(rows))
        pairs, owner = word_pairs(words, owner)
        sums += np.bincount(owner, table[pairs >> shift], len(rows))
        n += np.bincount(owner, minlength=len(rows))
        np.add.at(total, rows, sums)
        np.add.at(count, rows, n)
    return total / np.maximum(count, 1) + bias


def share_of(counts: dict[int, int], most: int):
    """A column of label: how many millionths of its rows to draw, so that a little over `most` are."""
    share = F.lit(0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, int(1_000_000 * min(1.0, 1.1 * most / max(n, 1)))).otherwise(share)
    return share


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple[bytes, int]]:
    """At most `rows` pieces of texts of each class, those of the least draws; held-out rows are left out."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out_column()).select("doc_id", F.col("quality").cast("int").alias("label")).distinct()
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < share_of(totals, rows))
    # The drawn labels have a fixed size (about 1.1 * rows for each class); they are broadcast, so no text is shuffled.
    size = F.lit(TRAIN_CHARACTERS)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(drawn), "doc_id").withColumn("pieces", F.greatest(F.ceil(F.length("text") / size), F.lit(1)).cast("int"))
    texts = texts.withColumn("mark", F.xxhash64("text"))  # once for each text, however many its pieces
    counts = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.sum("pieces").alias("n")).collect()}
    numbered = texts.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("draw", F.xxhash64("doc_id", "piece", "mark", F.lit(6)))
    some = numbered.where(F.pmod("draw", F.lit(1_000_000)) < share_of(counts, rows)).select("label", "draw", F.substring("text", F.col("piece") * size + 1, size).alias("text"))
    # Equal rows are drawn together and come as one with their number.
    found: dict[int, list[bytes]] = {label: [] for label in sorted(counts)}
    for r in sorted(some.groupBy("label", "draw", "text").agg(F.count("*").alias("n")).collect(), key=lambda r: (r["label"], r["draw"], r["text"])):
        held = found[r["label"]]
        held += [raw_bytes(r["text"])] * min(r["n"], rows - len(held))
    return [(text, label) for label, texts in found.items() for text in texts]


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    found = training_rows(docs, labels)
    marks = np.array([label for _, label in found], np.int64)
    if len(set(marks.tolist())) < 2:
        share = (marks.sum() + 1) / (len(marks) + 2)
        return np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share)))
    made = Model().train([text for text, _ in found], marks).table()
    del found
    release()  # the driver is done with the texts
    return made


def score(docs: DataFrame, table: np.ndarray, bias: float) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""

    def factory():
        def apply(keys, texts):
            z = logits([raw_bytes(t) for t in texts], table, bias)
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            held = [k is not None and crc_mod4(k) == 2 for k in keys]
            return [pa.array(keys, pa.int64()), pa.array(held, pa.bool_()), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))]

        return apply

    return map_texts(docs, "doc_id long, held_out boolean, score double, predicted int", factory)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, *fit(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with all their columns; texts pass through Python once, unshuffled.

    Null texts are scored as empty ones, repeated rows alike; columns of any name stay as they are; no documents give none.
    """
    table, bias = fit(docs, labels)
    columns = docs.columns

    def apply(batches):
        for batch in batches:
            texts = batch.column(columns.index("text")).cast(pa.large_string()).to_pylist()
            keep = logits([raw_bytes(t) for t in texts], table, bias) >= np.log(THRESHOLD / (1 - THRESHOLD))
            yield batch.filter(pa.array(keep))
        release()

    small_batches(docs.sparkSession)
    return docs.mapInArrow(apply, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
