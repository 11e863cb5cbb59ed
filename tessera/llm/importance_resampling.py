"""Target-distribution importance resampling with an exact distributed draw.

Runs of words are hashed into BUCKETS buckets. Counts of the buckets over all documents (raw) and over the target texts give an array
of gains, floor(1000 ln of the ratio of the smoothed shares); a document's weight is the sum of the gains of its features, looked
up in that array. The score adds Gumbel noise that follows from the doc_id alone, so the highest scores are a draw without
replacement by weight that any run repeats.

The draw is exact at any size: the k-th of the composite keys (score falling, doc_id rising) is found by radix selection. Each pass
counts one digit of DIGIT bits of the rows that still share the digits so far (2**DIGIT counts at most come to the driver), so 11
passes at most over a narrow table settle it, whatever ties there are. Only the selected rows are sorted by range and ranked:
their place is the place within their range plus the counts of the ranges before.

Defined results: a null text has no words, so no features, and weight 0; a null doc_id stands as an empty id in the noise and comes
last among equal scores; repeated rows are scored and drawn each, equal ones in any order; words of any number and length count, in
slices of bounded size; an empty table gives an empty result, an empty target (or one of nulls) has T = 0; extra columns are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, materialize, partitions, read

BUCKETS = 10_000
MAX_RUN = 1
SEED = "2024"
MIN_WORDS = 20
PERCENT = 10
DIGIT = 12
#: Bytes of a text whose words are held at once, and remembered words of a worker.
SLICE = 4 << 20
MEMO = 400_000
#: Letters A-Z in lower case, all other ASCII but digits and a-z to blanks.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Memo(dict):
    """Bucket of each feature seen."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        from zlib import crc32

        if len(self) > MEMO:
            self.clear()
        found = crc32(feature) % self.buckets
        if len(feature) < 64:
            self[feature] = found
        return found


def text_buckets(text: str | None, memo: Memo, max_run: int = MAX_RUN, slice_bytes: int = SLICE):
    """Arrays of the buckets of all features of a text, and the number of words of each slice."""
    import numpy as np

    raw = (text or "").encode("utf-8", "surrogatepass").translate(WORDS)
    at, tail = 0, []
    while at < len(raw):
        end = raw.find(b" ", at + slice_bytes)
        end = len(raw) if end < 0 else end
        words = raw[at:end].split()
        at = end
        features = words
        if max_run > 1:
            # Runs that end in this slice; up to max_run - 1 words of the last one stand before it.
            line, old = tail + words, len(tail)
            features = [b" ".join(line[i - n + 1 : i + 1]) for i in range(old, len(line)) for n in range(1, min(max_run, i + 1) + 1)]
            tail = line[len(line) - max_run + 1 :] if len(line) >= max_run else line
        yield np.fromiter(map(memo.__getitem__, features), np.int64, len(features)), len(words)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_run: int = MAX_RUN) -> list[int]:
    """The number of features in each bucket over all texts: partial arrays of the tasks, summed by bucket in Spark."""

    def factory():
        import numpy as np

        memo = Memo(buckets)

        def apply(keys, texts):
            held = np.zeros(buckets, np.int64)
            for text in texts:
                for found, _ in text_buckets(text, memo, max_run):
                    held += np.bincount(found, minlength=buckets)
            at = np.flatnonzero(held)
            return [pa.array(at, pa.int32()), pa.array(held[at], pa.int64())]

        return apply

    rows = map_texts(texts.select(F.lit(0).alias("key"), "text"), "bucket int, n long", factory, key="key")
    counts = [0] * buckets
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        counts[r["bucket"]] = r["n"]
    return counts


def gains(raw: list[int], target: list[int]) -> list[int]:
    """The gain of each bucket, in thousandths."""
    b, s_all, t_all = len(raw), sum(raw), sum(target)
    return [math.floor(1000 * math.log((t + 1) * (s_all + b) / ((s + 1) * (t_all + b)))) for s, t in zip(raw, target)]


def weights(docs: DataFrame, gain: list[int], max_run: int = MAX_RUN) -> DataFrame:
    """doc_id, n_words, n_features and weight of each row."""

    def factory():
        import numpy as np

        memo, of = Memo(len(gain)), np.array(gain, np.int64)

        def apply(keys, texts):
            words, features, sums = [], [], []
            for text in texts:
                n = k = w = 0
                for found, count in text_buckets(text, memo, max_run):
                    n, k, w = n + count, k + len(found), w + int(of[found].sum())
                words.append(n)
                features.append(k)
                sums.append(w)
            return [pa.array([k["doc_id"] for k in keys], pa.int64()), *(pa.array(x, pa.int64()) for x in (words, features, sums))]

        return apply

    keyed = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id")).alias("key"), "text")
    return map_texts(keyed, "doc_id long, n_words long, n_features long, weight long", factory, key="key")


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def digits(value: Column, high: int) -> list[Column]:
    """A long, read as unsigned, in digits of DIGIT bits from the highest of `high` bits on."""
    tops = range((high - 1) // DIGIT * DIGIT, -1, -DIGIT)
    return [F.shiftrightunsigned(value, s).bitwiseAND(F.lit((1 << DIGIT) - 1)) for s in tops]


def kth_key(rows: DataFrame, k: int) -> list[int] | None:
    """The first digits (of composite_key) of the k-th smallest key, as many as tell it from all others; None if there are under k rows.

    Rows whose first digits are at most these are the k smallest, and all rows that tie with the k-th.
    """
    columns = composite_key(rows)
    prefix: list[int] = []
    while len(prefix) < len(columns):
        at = columns[len(prefix)]
        counts = sorted(rows.groupBy(at.alias("digit")).count().collect())  # at most 2**DIGIT rows
        before = 0
        for digit, n in counts:
            if before + n >= k:
                break
            before += n
        else:
            return None
        prefix.append(digit)
        k -= before
        if k == n:
            break
        rows = rows.where(at == digit)
    return prefix


def composite_key(rows: DataFrame) -> list[Column]:
    """Digits of (score falling, doc_id rising, nulls last): unsigned longs that rise in that order."""
    flip = F.lit(-(1 << 63))
    score = F.bitwise_not(F.col("score").bitwiseXOR(flip))
    doc = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)).bitwiseXOR(flip)
    return [*digits(score, 64), *digits(doc, 64), F.when(F.col("doc_id").isNull(), 1).otherwise(0).cast("long")]


def at_most(columns: list[Column], prefix: list[int]) -> Column:
    """Whether the first digits are at most the prefix, in lexicographic order."""
    found = F.lit(True)
    for column, digit in reversed(list(zip(columns, prefix))):
        found = (column < digit) | ((column == digit) & found)
    return found


def ranked(selected: DataFrame, k: int, ranges: int) -> DataFrame:
    """selected with rank 1, 2, ... by score and doc_id, null beyond k: places within sorted ranges, plus the ranges before.

    What is equal in score and doc_id is dealt out by its other columns and row numbers, so ties do not fill one range.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "n_words", "row_no"]
    sorted_rows = selected.withColumn("row_no", F.monotonically_increasing_id()).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # The id holds the number of the range in its upper 31 bits and the place in it in the lower 33.
    placed = materialize(sorted_rows.drop("row_no").withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    counts = sorted(placed.groupBy(part.alias("part")).count().collect())  # one row for each range
    starts, total = [], 0
    for number, n in counts:
        starts.append((number, total))
        total += n
    if not starts:
        return placed.withColumn("rank", F.lit(None).cast("long")).drop("place")
    before = F.broadcast(selected.sparkSession.createDataFrame(starts, "part long, before long"))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(before, part == F.col("part")).withColumn("rank", F.when(rank <= k, rank)).drop("place", "part", "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, max_run: int = MAX_RUN, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of each row; rank is null where the row is not drawn."""
    gain = gains(bucket_counts(docs, buckets, max_run), bucket_counts(target, buckets, max_run))
    rows = materialize(weights(docs, gain, max_run).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    fit = rows.where(F.col("n_words") >= min_words)
    k = percent * fit.count() // 100
    prefix = kth_key(fit, k) if k else None
    none = F.lit(None).cast("long")
    if prefix is None:
        return rows.withColumn("rank", none)
    drawn = (F.col("n_words") >= min_words) & at_most(composite_key(rows), prefix)
    chosen = ranked(rows.where(drawn), k, max(1, min(partitions(docs.sparkSession), k // 1000 + 1)))
    return chosen.unionByName(rows.where(~drawn).withColumn("rank", none))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


_CAPS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOUND = f"regexp_extract_all(translate(coalesce(text, ''), '{_CAPS}', '{_CAPS.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
#: DuckDB has no crc32: its table follows from the polynomial by eight shifts, and the sum is folded over the UTF-8 bytes of each word.
_STEP = "list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, {x}::BIGINT)"
ORACLE = f"""
WITH ct AS (
  SELECT list({_STEP.format(x="b")} ORDER BY b) AS t FROM (SELECT unnest(range(256)) AS b)
), dw AS (
  SELECT doc_id, unnest({_FOUND}) AS w FROM documents
), bw AS (
  SELECT unnest({_FOUND}) AS w FROM benchmark
), words AS (
  SELECT w, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT) AS bytes FROM (SELECT w FROM dw UNION SELECT w FROM bw)
), crc AS (
  SELECT w, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295::BIGINT), 4294967295) % {BUCKETS} AS bucket FROM words, ct
), s AS (
  SELECT bucket, count(*) AS s FROM dw JOIN crc USING (w) GROUP BY 1
), t AS (
  SELECT bucket, count(*) AS t FROM bw JOIN crc USING (w) GROUP BY 1
), n AS (
  SELECT (SELECT count(*) FROM dw) AS s_all, (SELECT count(*) FROM bw) AS t_all
), g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {BUCKETS}) / ((s + 1)::DOUBLE * (t_all + {BUCKETS}))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), n
), f AS (
  SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM dw JOIN crc USING (w) JOIN g USING (bucket) GROUP BY 1
), d AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256(concat('{SEED}:', doc_id)), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN f USING (doc_id)
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM d WHERE n_features >= {MIN_WORDS}
)
SELECT d.doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * n // 100 THEN rank END AS rank FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""
