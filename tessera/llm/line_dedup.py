"""Line dedup over levelled sorted runs of line hashes.

Documents are taken in BATCHES batches, from the largest doc_ids on. Python cuts each text once and hands over the 128-bit hashes of
its long line keys; a batch is summed to one row for each line (documents, largest doc_id), is merge-anti-joined with the runs so far
(lines that a run has settled, by enough documents and an owner not below the batch's, add nothing), and the rest becomes a sorted
run of its own. Runs are bucketed and sorted by hash, so that neither the joins nor the compaction shuffle a run again; whenever a
level holds two runs they are compacted into one of the next level by a merge join, and all that are left at the end. So a line is
written about log2(BATCHES) times. Lines whose sums reach MIN_DOCS are repeated: their hashes meet the documents' hashes in a join
(Spark splits hot lines, since each has one row on the other side), are gathered for each text, and the texts are cut again without them.

A run has as many buckets as spark.sql.shuffle.partitions has partitions, as any shuffle of the table.

Defined results: a null or empty text is one empty line; a document is a doc_id, so repeated rows of one count once for a line and
lose or keep it alike; rows with a null doc_id count for no line and keep all of theirs; a line within one text any number of times is
kept or dropped as a whole; a text of any length is cut whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, materialize, own_path, own_table, partitions, read

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 8
SPACE = b"\t\n\v\f\r "
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def line_hashes(text: str | None, least: int = MIN_CHARS) -> list[bytes | None]:
    """The hash of the key of each line; None for keys of under `least` code points."""
    from hashlib import blake2b

    found: list[bytes | None] = []
    for line in (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split(b"\n"):
        key = line.strip(SPACE)
        # A code point has four bytes at most, and no other bytes than continuations in 0x80 ... 0xBF.
        long = len(key) >= 4 * least or (len(key) >= least and len(key) - sum(0x80 <= x < 0xC0 for x in key) >= least)
        found.append(blake2b(key, digest_size=16).digest() if long else None)
    return found


def long_lines(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_key and hash of the long lines of each text, each line of a text once."""

    def factory():
        def apply(keys, texts):
            ids, names, lines = [], [], []
            for k, text in zip(keys, texts):
                held = set(line_hashes(text, least)) - {None}
                ids += [k["doc_id"]] * len(held)
                names += [k["text_key"]] * len(held)
                lines += held
            return [pa.array(ids, pa.int64()), pa.array(names, pa.int64()), pa.array(lines, pa.binary())]

        return apply

    keyed = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(text_id().alias("key"), "text")
    return map_texts(keyed, "doc_id long, text_key long, line binary", factory, key="key")


def text_id():
    """What tells texts apart where rows share a doc_id."""
    return F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))


class LineRuns:
    """Levelled sorted runs: (line, n_docs, owner), a line once in each run.

    Batches must not share a doc_id; they may come in any order.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = min(partitions(spark), 100_000)
        #: The run of each level, None where it is empty.
        self.levels: list[str | None] = []

    def _store(self, rows: DataFrame) -> str:
        """rows as a run: a table of the session over files of the shared folder."""
        name = own_table(self.spark)
        rows.write.bucketBy(self.buckets, "line").sortBy("line").option("path", own_path(self.spark, name)).saveAsTable(name)
        return name

    def add(self, lines: DataFrame) -> None:
        """A batch of (doc_id, line): what the runs do not know for sure becomes a run."""
        carried, level = self._store(self.unsettled(lines)), 0
        while level < len(self.levels) and self.levels[level]:
            carried = self._compact(self.levels[level], carried)
            self.levels[level] = None
            level += 1
        self.levels[level : level + 1] = [carried]

    def unsettled(self, lines: DataFrame) -> DataFrame:
        """The sums of a batch, without lines of which a run holds enough documents and an owner not below the batch's."""
        new = lines.groupBy("line").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("owner")).alias("new")
        for name in filter(None, self.levels):
            run = self.spark.table(name).where(F.col("n_docs") >= self.min_docs).alias("run")
            new = new.join(run.hint("merge"), (F.col("new.line") == F.col("run.line")) & (F.col("run.owner") >= F.col("new.owner")), "left_anti").alias("new")
        return new

    def merged(self, one: str, other: str) -> DataFrame:
        """The sums of each line of two runs: a merge join of their buckets, without a shuffle."""
        a, b = self.spark.table(one).alias("a"), self.spark.table(other).alias("b").hint("merge")
        n_docs = F.coalesce("a.n_docs", F.lit(0)) + F.coalesce("b.n_docs", F.lit(0))
        both = a.join(b, F.col("a.line") == F.col("b.line"), "full_outer")
        return both.select(F.coalesce("a.line", "b.line").alias("line"), n_docs.alias("n_docs"), F.greatest("a.owner", "b.owner").alias("owner"))

    def _compact(self, one: str, other: str) -> str:
        whole = self._store(self.merged(one, other))
        self._forget(one, other)
        return whole

    def _forget(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def repeated(self) -> DataFrame:
        """line and owner of the lines of min_docs documents and more, as a table of its own; ends the runs."""
        names, self.levels = [n for n in self.levels if n], []
        if not names:
            return self.spark.createDataFrame([], "line binary, owner long")
        whole = names[0]
        for name in names[1:]:
            whole = self._compact(whole, name)
        found = materialize(self.spark.table(whole).where(F.col("n_docs") >= self.min_docs).select("line", "owner"))
        self._forget(whole)
        return found


def repeated_lines(lines: DataFrame, batches: int = BATCHES, min_docs: int = MIN_DOCS) -> DataFrame:
    """line and owner (the largest doc_id) of all lines of (doc_id, line) held by min_docs documents and more."""
    runs = LineRuns(lines.sparkSession, min_docs)
    cuts = lines.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0] if batches > 1 else None
    edges = [None, *sorted(set(cuts or [])), None]
    for low, high in reversed(list(zip(edges, edges[1:]))):
        part = lines
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        runs.add(part.select("doc_id", "line"))
    return runs.repeated()


def dedup_lines(docs: DataFrame, least: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text of each row."""
    lines = materialize(long_lines(docs, least))
    repeated = repeated_lines(lines, batches, min_docs)
    lost = lines.join(repeated, "line").where("doc_id <> owner")
    gone = lost.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("gone"))
    keyed = docs.select(text_id().alias("k"), F.col("text").cast("string").alias("text")).select("k.doc_id", "k.text_key", "text")
    met = keyed.join(gone, ["doc_id", "text_key"], "left").select(F.struct("doc_id", "gone").alias("key"), "text")

    def factory():
        def apply(keys, texts):
            counts, cut, kept = [], [], []
            for k, text in zip(keys, texts):
                text, drop = text or "", set(k["gone"] or ())
                rows = text.split("\n")
                if drop:
                    stay = [row for row, h in zip(rows, line_hashes(text, least)) if h not in drop]
                    cut.append(len(rows) - len(stay))
                    text = "\n".join(stay)
                else:
                    cut.append(0)
                counts.append(len(rows))
                kept.append(text)
            return [pa.array([k["doc_id"] for k in keys], pa.int64()), pa.array(counts, pa.int64()), pa.array(cut, pa.int64()), pa.array(kept, pa.large_string()).cast(pa.string())]

        return apply

    return map_texts(met, "doc_id long, n_lines long, n_dropped long, kept_text string", factory, key="key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


_CAPS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = f"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT doc_id, i, ls[i] AS line, translate(regexp_replace(ls[i], '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{_CAPS}', '{_CAPS.lower()}') AS k
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)
), r AS (
  SELECT k, max(doc_id) AS owner FROM l WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), m AS (
  SELECT l.doc_id, i, line, r.k IS NOT NULL AND l.doc_id <> owner AS gone FROM l LEFT JOIN r USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
