"""Host-level quality rules.

Each document gets base counts and a base verdict. Failures are then summed by host (the source column), the
host's failure rate is shrunk towards an empirical beta prior fitted to all hosts by moments, and a host whose
posterior mean is over the limit loses its documents.

Verdicts of hosts with very many documents, of which there are HOT_HOSTS at most, are broadcast; those of all others meet their
documents in a shuffle, in which no host is large.

Defined results: a null or blank text has no words and fails the base rule; a null host is a host of its own; a null doc_id stays
null; repeated rows count each; a text of any length is counted whole; an empty table gives an empty result; extra columns of
the input are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, materialize, read

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
#: A host goes when its shrunk failure rate is over this.
HOST_LIMIT = 0.5
#: A host is hot if it has more documents than so many, and than one HOT_HOSTS-th of all: there are no more than HOT_HOSTS of them.
HOT_ROWS, HOT_HOSTS = 1000, 10_000
SPACE = b"\t\n\v\f\r "
COUNTS = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of width words found twice or more, the first one included."""
    import numpy as np

    n = len(words)
    if n <= width:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    # Exact names for windows by doubling: two equal halves make equal windows.
    size = 1
    while size < width:
        step = min(size, width - size)
        pair = rank[: len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        _, rank = np.unique(pair, return_inverse=True)
        size += step
    often = np.bincount(rank)[rank] > 1
    if not often.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(often)
    edge[:-1] += np.bincount(starts, minlength=n)
    np.subtract.at(edge, starts + width, 1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() cuts at exactly space and \x09-\x0D
    if not words:
        return 0, 0, len(raw) - len(raw.translate(None, b"#*$%&|<>")), 0, 0
    chars = len(text) - (len(raw) - sum(map(len, words)))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def count_rows(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the base counts of each document."""

    def factory():
        def apply(keys, texts):
            rows = list(map(base_counts, texts))
            ids, hosts = [k["doc_id"] for k in keys], [k["host"] for k in keys]
            return [pa.array(ids, pa.int64()), pa.array(hosts, pa.string()), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(5))]

        return apply

    keyed = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host")).alias("key"), "text")
    return map_texts(keyed, COUNTS, factory, key="key")


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host, n_docs, n_failed, host_rate, host_kept: the posterior mean (failed + a) / (n + a + b) of each host.

    The beta prior has the hosts' mean rate m and the strength s = m(1-m)/v - 1 of their variance v, held to
    [1, 1000]; one host, or none that differ, gives s = 1000. The sums over hosts are partial sums of a table
    with one row for each host.
    """
    hosts = rows.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg((F.sum("n_failed") / F.sum("n_docs")).alias("prior_mean"), F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("prior_var"))
    mean, var = F.col("prior_mean"), F.col("prior_var")
    strength = F.when(var <= 0, 1000.0).otherwise(F.greatest(F.lit(1.0), F.least(F.lit(1000.0), mean * (1 - mean) / var - 1)))
    prior = prior.select("prior_mean", strength.alias("prior_strength"))  # one row
    posterior = (F.col("n_failed") + mean * F.col("prior_strength")) / (F.col("n_docs") + F.col("prior_strength"))
    return hosts.join(F.broadcast(prior)).select("host", "n_docs", "n_failed", posterior.alias("host_rate"), (posterior <= limit).alias("host_kept"))


def quality_rules(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Base counts, base_failed, host_rate and kept of each document."""
    counted = count_rows(docs, host)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rows = materialize(counted.withColumn("base_failed", failed))
    verdicts = host_verdicts(rows, limit)
    most = max(HOT_ROWS, rows.count() // HOT_HOSTS)
    hot = F.broadcast(verdicts.where(F.col("n_docs") > most))
    same = F.col("r.host").eqNullSafe(F.col("v.host"))
    others = rows.alias("r").join(hot.alias("v"), same, "left_anti")
    columns = [F.col(f"r.{c}") for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]
    columns += [(~F.col("r.base_failed") & F.col("v.host_kept")).alias("kept"), F.round("v.host_rate", 9).alias("host_rate")]
    of_hot = rows.alias("r").join(hot.alias("v"), same).select(*columns)
    return of_hot.union(others.alias("r").join(verdicts.where(F.col("n_docs") <= most).alias("v"), same).select(*columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


ORACLE = """
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t, string_split(trim(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '), ' ') AS ws
  FROM documents
), b AS (
  SELECT doc_id, source, t, CASE WHEN ws = [''] THEN []::VARCHAR[] ELSE ws END AS ws,
    [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM w
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM b WHERE len(ws) >= 8)
), d AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(0, 8)) AS k FROM d) GROUP BY doc_id
), c AS (
  SELECT b.doc_id, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words FROM b LEFT JOIN r USING (doc_id)
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c
), h AS (
  SELECT source, count(*) AS n, sum(base_failed::BIGINT) AS k FROM f GROUP BY source
), p AS (
  SELECT sum(k)::DOUBLE / sum(n) AS m, coalesce(var_pop(k::DOUBLE / n), 0.0) AS v FROM h
), q AS (
  SELECT m, CASE WHEN v <= 0 THEN 1000.0 ELSE greatest(1.0, least(1000.0, m * (1 - m) / v - 1)) END AS s FROM p
), v AS (
  SELECT source, (k + m * s) / (n + s) AS host_rate FROM h, q
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_rate <= 0.5 AS kept, round(host_rate, 9) AS host_rate
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
