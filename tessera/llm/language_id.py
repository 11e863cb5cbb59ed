"""Language identification by bit-sliced Bloom filters.

Each language has a Bloom filter of the n-grams that several of its training documents hold. The filters share
their hash functions, so they are stored sliced: one word of language bits for each slot. The AND of an n-gram's
slots names all languages that contain it. The hits of a language over a text, less the share that a filter of
its fill gives by chance, decide.

Learning reads every labelled text that is not held out, cut to pieces of TRAIN_CHARACTERS, and draws at most TRAIN_PIECES
of them for each language, so a long text is learned from too and the driver holds a bounded sample.

Defined results: `und` with score 0 for null texts and texts without a letter; ties go to the first language in
order; with nothing to learn from all texts are `und`; a language of a single text is learned from it; texts of any length are
scored whole; rows that repeat a doc_id are learned from and scored each; a null doc_id stays null and is not held out; an
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod4, held_out_column, map_texts, read
from tessera.llm.ngrams import Batch, mix, pieces, raw_bytes

#: The training sample: pieces of each language and of all languages, at most, and the characters of a piece.
TRAIN_PIECES, ALL_PIECES, TRAIN_CHARACTERS = 1000, 20_000, 5000
#: An n-gram belongs to a language if this share of the language's training pieces hold it, two at least where there are COMMON pieces.
LEAST_SHARE, COMMON = 0.004, 20
N = 5
BITS = 20
HASHES = 2


def letters(raw: bytes) -> bytes:
    """Bytes that are no part of a letter become spaces."""
    return raw.translate(_LETTERS)


_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def prepared(text: str | None) -> bytes:
    return letters(raw_bytes(text.lower())) if text else b""


def slots(key: np.ndarray) -> list[np.ndarray]:
    """HASHES slots of each key."""
    key = mix(key)
    return [((key << np.uint64(k * BITS)) >> np.uint64(64 - BITS)).astype(np.int64) for k in range(HASHES)]


class Filters:
    """languages, one 64-bit word of language bits for each slot and each 64 languages, and each filter's false positives."""

    def __init__(self, texts_by_language: dict[str, list[bytes]]):
        self.languages = sorted(texts_by_language)
        words = max(1, -(-len(self.languages) // 64))
        self.table = np.zeros((words, 1 << BITS), np.uint64)
        for i, language in enumerate(self.languages):
            texts = texts_by_language[language]
            distinct = [np.unique(np.delete(*Batch([t]).windows(N))) for t in texts if t]
            if not distinct:
                continue
            keys, held = np.unique(np.concatenate(distinct), return_counts=True)
            keys = keys[held >= max(2 if len(texts) >= COMMON else 1, LEAST_SHARE * len(texts))]
            for slot in slots(keys):
                self.table[i // 64, slot] |= np.uint64(1 << (i % 64))
        fill = [((self.table[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(self.languages))]
        self.false = np.array(fill) ** HASHES
        if words == 1 and len(self.languages) <= 8:
            self.table = self.table.astype(np.uint8)

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hits of each language in each text, and the number of n-grams."""
        hits, total = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for rows, group in pieces(texts):
            batch = Batch(group)
            key, cross = batch.windows(N)
            if not len(key):
                continue
            at = slots(key)
            for word in range(len(self.table)):
                mask = self.table[word][at[0]]
                for slot in at[1:]:
                    mask &= self.table[word][slot]
                mask[cross] = 0
                for i in range(64 * word, min(len(self.languages), 64 * word + 64)):
                    bit = ((mask >> mask.dtype.type(i % 64)) & mask.dtype.type(1)).astype(np.int32)
                    np.add.at(hits[:, i], rows, batch.sums(bit))
            np.add.at(total, rows, np.maximum(batch.sizes - N + 1, 0))
        return hits, total

    def decide(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The language and the score of each text: its share of the corrected hits of all languages."""
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        # A space at either end, so that a word of a short text has n-grams too.
        hits, total = self.hits([b"  " + t + b"  " for t in texts])
        fair = np.maximum((hits - total[:, None] * self.false) / (1 - np.minimum(self.false, 0.999)), 0) + 1e-6
        best = fair.argmax(1)
        return [self.languages[i] for i in best], fair[np.arange(len(texts)), best] / fair.sum(1)


def fit(docs: DataFrame, most: int = TRAIN_PIECES) -> Filters:
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out_column()).select("doc_id", "lang", "text")
    size = F.lit(TRAIN_CHARACTERS)
    known = known.withColumn("pieces", F.greatest(F.ceil(F.length("text") / size), F.lit(1)).cast("int"))
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.sum("pieces").alias("n")).collect()}  # one row for each language
    # Numbers are drawn before the text is cut, so only the drawn pieces are made.
    numbered = known.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("draw", F.xxhash64("doc_id", "piece", F.left("text", F.lit(200)), F.lit(9)))
    most = min(most, max(1, ALL_PIECES // max(1, len(totals))))
    share = F.lit(0)
    for lang, n in totals.items():
        share = F.when(F.col("lang") == lang, int(1_000_000 * min(1.0, 1.1 * most / n))).otherwise(share)
    drawn = numbered.where(F.pmod("draw", F.lit(1_000_000)) < share).select("lang", "draw", F.substring("text", F.col("piece") * size + 1, size).alias("text"))
    by_language: dict[str, list[bytes]] = {lang: [] for lang in totals}
    # Equal rows are drawn together: the least draws stay, whatever the order in which they come.
    for r in sorted(drawn.groupBy("lang", "draw", "text").agg(F.count("*").alias("n")).collect(), key=lambda r: (r["lang"], r["draw"], r["text"])):
        held = by_language[r["lang"]]
        held += [prepared(r["text"])] * min(r["n"], most - len(held))
    return Filters(by_language)


def identify(docs: DataFrame, filters: Filters | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    filters = filters or fit(docs)

    def factory():
        import regex

        letter = regex.compile(r"\p{L}").search

        def apply(keys, texts):
            names, scores = filters.decide([prepared(t) for t in texts])
            some = [bool(t and letter(t)) for t in texts]
            held = [k is not None and crc_mod4(k) == 2 for k in keys]
            return [
                pa.array(keys, pa.int64()),
                pa.array(held, pa.bool_()),
                pa.array([n if s else "und" for n, s in zip(names, some)], pa.string()),
                pa.array(np.where(some, scores, 0.0), pa.float64()),
            ]

        return apply

    return map_texts(docs, "doc_id long, held_out boolean, lang_pred string, score double", factory)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
