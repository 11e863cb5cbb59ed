"""Results of entities: made from registry matches, merged with search items, finalized."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import links as L
from tessera.schemas import RESULT


def _texts(*values: str) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def from_registry(entities: DataFrame, found: DataFrame) -> DataFrame:
    """entities with result: what the registry gives (found: from matching.lookup), links merged but not sanitized."""
    rows = entities.join(found, "cache_key", "left")
    records = F.coalesce("records", F.array().cast(found.schema["records"].dataType))
    merged = L.merge_record_links(F.coalesce(F.flatten(F.transform(records, lambda r: r["links"])), L.empty_links()))
    some = F.size(records) > 0
    result = F.struct(
        F.col("entity_id"),
        F.col("name").alias("input_name"),
        F.get(F.transform(records, lambda r: r["display_name"]), F.lit(0)).alias("canonical_name"),
        F.col("entity_type"),
        F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"),
        F.coalesce("ambiguity_notes", _texts()).alias("ambiguity_notes"),
        _texts().alias("aliases_used"),
        merged.alias("links"),
        F.lit(False).alias("search_used"),
        _texts().alias("search_queries"),
        _texts().alias("grounding_sources"),
        F.transform(records, lambda r: r["record_id"]).alias("registry_record_ids"),
        F.filter(F.transform(records, lambda r: r["registry_number"]), lambda n: n.isNotNull()).alias("registry_numbers"),
        F.transform(records, lambda r: r["display_name"]).alias("registry_names"),
        F.col("match_score").alias("registry_match_score"),
        F.when(some, F.exists(records, lambda r: r["active"])).alias("registry_has_active_record"),
        F.when(some, _texts("registry")).otherwise(_texts()).alias("resolution_sources"),
        F.lit(False).alias("needs_human_review"),
    )
    return rows.select(*entities.columns, result.cast(RESULT).alias("result"))


def with_item(result: Column, item: Column, used: Column, queries: Column, sources: Column) -> Column:
    """result with a search item put in; the batch's queries and sources take the place of its own."""
    distinct = lambda a, b: F.array_distinct(F.concat(a, F.coalesce(b, _texts())))
    return (
        result.withField("canonical_name", F.coalesce(F.nullif(result["canonical_name"], F.lit("")), item["canonical_name"]))
        .withField("ambiguous", result["ambiguous"] | F.coalesce(item["ambiguous"], F.lit(False)))
        .withField("ambiguity_notes", distinct(result["ambiguity_notes"], item["ambiguity_notes"]))
        .withField("aliases_used", distinct(result["aliases_used"], item["aliases_used"]))
        .withField("search_used", used)
        .withField("search_queries", queries)
        .withField("grounding_sources", sources)
        .withField("resolution_sources", F.concat(result["resolution_sources"], _texts("search")))
        .withField("links", L.merge_links(result["links"], F.coalesce(item["links"], L.empty_links())))
    )


def with_sites(rows: DataFrame, pages: DataFrame, config) -> DataFrame:
    """result with the social links of its official sites: pages has url and html."""
    from tessera.functions.documents import social_links

    sites = L.sites_to_visit(F.col("result.links"), config.crawler_skip_if_links, config.crawler_min_site_confidence, config.crawler_max_sites)
    visits = rows.select("cache_key", F.posexplode(F.transform(sites, lambda x: x["url"])).alias("site_no", "url"))
    found = visits.join(pages, "url").withColumn("social", social_links(F.col("html"), F.col("url"))).where(F.size("social") > 0)
    made = found.groupBy("cache_key").agg(F.array_sort(F.collect_list(F.struct("site_no", L.site_links(F.col("social"), F.col("url")).alias("links")))).alias("visited"))
    joined = rows.join(made, "cache_key", "left")
    result, more = F.col("result"), F.flatten(F.transform("visited", lambda v: v["links"]))
    merged = result.withField("links", L.merge_links(result["links"], F.coalesce(more, L.empty_links()))).withField("resolution_sources", F.concat(result["resolution_sources"], _texts("official_site_crawler")))
    return joined.withColumn("result", F.when(F.col("visited").isNull(), result).otherwise(merged)).drop("visited")


def finalized(rows: DataFrame, config, pages: DataFrame | None = None) -> DataFrame:
    """result ready to store: sites visited, links sanitized and ranked, review marked."""
    if config.crawler_enabled and pages is not None:
        rows = with_sites(rows, pages, config)
    rows = rows.withColumn("__links", L.finalize(F.col("result.links"), config.min_confidence))
    result = F.col("result").withField("links", F.col("__links")).withField("resolution_sources", F.array_distinct("result.resolution_sources"))
    result = result.withField("needs_human_review", L.needs_review(F.col("__links"), F.col("result.ambiguous"), config.human_review_threshold))
    return rows.withColumn("result", result).drop("__links")
