"""The jobs as registered queries, with their SQL: each runs twice into one new folder, and the output is read back after the second run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import page_links, resolve_entities
from tessera.operators.state import NO_LINKS
from tessera.operators.tables import new_folder
from tessera.plans import catalog as C


def job1_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "job1_page_links")
    for _ in range(2):
        links = page_links.run(spark, f"{sf_dir}/pages.parquet", f"{folder}/links", f"{folder}/checkpoint")
    return links


#: Every href of the pages is a path of its host; other forms are covered by tests.
_BASE = f"concat({C.d_part('p.url', 1)}, '://', {C.d_part('p.url', 2)})"
JOB1 = f"""
WITH h AS (
  SELECT page_id, url, {C.d_host(C.d_url('url'))} AS site, unnest(regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<a\\s[^>]*?href="([^"]*)"', 1)) AS href FROM pages WHERE coalesce(url, '') <> ''
), r AS (
  SELECT page_id, regexp_replace(site, '^www\\.', '') AS site, concat({_BASE}, href) AS raw FROM h AS p WHERE starts_with(href, '/')
), n AS (
  SELECT page_id, site, {C.d_url('raw')} AS url FROM r
), m AS (
  SELECT site, url, min(page_id) AS first_page FROM n GROUP BY site, url
)
SELECT site, url, {C.d_profile('url')} AS profile, first_page, CAST(0 AS BIGINT) AS batch, {C.d_platform('url')} AS platform FROM m
"""


def job2_resolve_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "job2_resolve_entities")
    given = {"tables": ["part", "customer", "supplier"], "entities": C.ENTITIES, "registry": C.RAW, "shards": 8}
    for _ in range(2):
        rows = resolve_entities.run(spark, sf_dir, folder, **given)
    r = F.col("result")
    joined = lambda values: F.array_join(values, " ")
    return rows.select(
        "entity_id", "name", "entity_type", "status", F.coalesce("error", F.lit("")).alias("error"), F.round(r["registry_match_score"], 6).alias("match_score"), r["ambiguous"].alias("ambiguous"),
        r["canonical_name"].alias("canonical_name"), joined(r["registry_record_ids"]).alias("record_ids"), joined(F.transform(r["links"], lambda x: x["url"])).alias("urls"), r["needs_human_review"].alias("review"), "shard",
    )


JOB2 = f"""
{C._D_NAMED}, i AS (
  SELECT n.*, has FROM n JOIN h USING (cache_key) WHERE CASE WHEN has THEN prim ELSE ids = 1 END
), g AS (
  SELECT *, trim(date_excluded) = '' AS live, bool_or(trim(date_excluded) = '') OVER (PARTITION BY cache_key) AS act, max(registry_number) OVER (PARTITION BY cache_key) AS newest FROM i
), o AS (
  SELECT cache_key, has, record_id, display_name, row_number() OVER (PARTITION BY cache_key ORDER BY live DESC, registry_number DESC, record_id) AS place FROM g WHERE CASE WHEN act THEN live ELSE registry_number = newest END
), found AS (
  SELECT cache_key, CASE WHEN bool_or(has) THEN 1.0 ELSE 0.99 END::DOUBLE AS match_score, false AS ambiguous, arg_min(display_name, place) AS canonical_name, string_agg(record_id, ' ' ORDER BY place) AS record_ids FROM o GROUP BY cache_key
  UNION ALL SELECT cache_key, 0.99, true, NULL, '' FROM h WHERE NOT has AND ids > 1
), l AS (
  SELECT record_id, date_excluded, unnest(us) AS url, unnest(range(len(us))) AS pos FROM (SELECT record_id, date_excluded, {C.d_found('resources_raw')} AS us FROM recs)
), e AS (
  SELECT cache_key, place * 1000 + pos AS pos, {C.d_url('url')} AS url, CASE WHEN date_excluded <> '' THEN 0.88 ELSE 0.98 END AS confidence FROM o JOIN l USING (record_id)
), k AS (
  SELECT cache_key, url, min(pos) AS pos, max(confidence) AS confidence FROM e WHERE {C.d_profile('url')} GROUP BY cache_key, url
), u AS (
  SELECT cache_key, string_agg(url, ' ' ORDER BY confidence DESC, pos) AS urls FROM k GROUP BY cache_key
)
SELECT ent.entity_id, ent.name, ent.entity_type, CASE WHEN urls IS NULL THEN 'unresolved' ELSE 'success' END AS status, CASE WHEN urls IS NULL THEN '{NO_LINKS}' ELSE '' END AS error, match_score, coalesce(ambiguous, false) AS ambiguous,
  canonical_name, coalesce(record_ids, '') AS record_ids, coalesce(urls, '') AS urls, coalesce(ambiguous, false) OR urls IS NULL AS review, CAST(CAST(concat('0x', substr(cache_key, 1, 16)) AS UBIGINT) % 8 AS INTEGER) AS shard
FROM ent LEFT JOIN found USING (cache_key) LEFT JOIN u USING (cache_key)
"""

QUERIES = {"job1_page_links": job1_page_links, "job2_resolve_entities": job2_resolve_entities}
ORACLES = {"job1_page_links": JOB1, "job2_resolve_entities": JOB2}
