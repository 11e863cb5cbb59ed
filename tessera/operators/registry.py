"""The reference registry: raw records, parsed records, their indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import names, urls
from tessera.schemas import LINKS

# Fixed values.
PERSON_CATEGORY = "Физические лица"
EVIDENCE = "URL указан в информационном ресурсе реестра"

RAW = "id string, field_1_i string, field_2_s string, field_4_s string, field_5_s string, field_5_dt string, field_6_s string, field_7_s string, field_9_s string, field_10_s string, field_12_s string, field_13_s string, field_15_s string"


def dedupe_pages(rows: DataFrame) -> DataFrame:
    """Raw rows (pos, id, ...) by id: the last value wins, the first position stays."""
    columns = [c for c in rows.columns if c not in ("id", "pos")]
    kept = rows.where(F.coalesce(F.col("id"), F.lit("")) != "").groupBy("id").agg(F.min("pos").alias("pos"), F.max_by(F.struct(*columns), "pos").alias("r"))
    return kept.select("pos", "id", *(F.col(f"r.{c}").alias(c) for c in columns))


def _text(*columns: str) -> Column:
    """The first of the columns that is not empty, trimmed; else an empty text."""
    return urls.strip(F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in columns), F.lit("")))


def confidence_of(excluded: Column, base: float) -> Column:
    return F.when(excluded != "", F.greatest(F.lit(0.5), F.lit(base) - 0.1)).otherwise(F.lit(base))


def record_links(resources: Column, number: Column, excluded: Column, base: float, page_url: str) -> Column:
    """A link for each URL of the free-text field."""
    evidence = F.concat(
        F.lit(EVIDENCE),
        F.when(F.coalesce(number, F.lit(0)) != 0, F.concat(F.lit(" (запись № "), number.cast("string"), F.lit(")"))).otherwise(""),
        F.when(excluded != "", F.concat(F.lit("; запись имеет дату исключения "), excluded)).otherwise(""),
        F.lit("."),
    )
    made = F.transform(
        urls.urls_in_text(resources),
        lambda u: F.struct(urls.detect_platform(u).alias("platform"), u.alias("url"), confidence_of(excluded, base).alias("confidence"), evidence.alias("evidence"), F.lit("registry").alias("source"), F.array(F.lit(page_url)).alias("source_urls")),
    )
    return made.cast(LINKS)


def parse(rows: DataFrame, base: float = 0.98, page_url: str = "https://registry.example.org/", plain: bool = False) -> DataFrame:
    """Records of raw registry rows; rows without id or name are dropped."""
    out = rows.select(
        *(["pos"] if "pos" in rows.columns else []),
        urls.strip(F.coalesce("id", F.lit(""))).alias("record_id"),
        F.expr("try_cast(field_1_i AS bigint)").alias("registry_number"),
        _text("field_2_s").alias("display_name"),
        _text("field_7_s").alias("category"),
        _text("field_6_s").alias("resources_raw"),
        _text("field_4_s", "field_15_s").alias("date_included"),
        _text("field_5_s", "field_5_dt").alias("date_excluded"),
        _text("field_9_s").alias("inn"),
        _text("field_10_s").alias("ogrn"),
        _text("field_12_s").alias("birth_date"),
        _text("field_13_s").alias("participants_raw"),
        F.to_json(F.struct(*(c for c in rows.columns if c != "pos"))).alias("raw"),
    ).where("record_id <> '' AND display_name <> ''")
    out = out.withColumn("entity_type", F.when(F.col("category") == PERSON_CATEGORY, "person").otherwise("organization"))
    return with_names(out, plain).withColumn("links", record_links(F.col("resources_raw"), F.col("registry_number"), F.col("date_excluded"), base, page_url))


def with_names(records: DataFrame, plain: bool = False) -> DataFrame:
    """With normalized_name, token_key and search_names."""
    name = F.col("display_name")
    normal = names.normalize_plain(name) if plain else names.normalize_name(name)
    return records.withColumn("normalized_name", normal).withColumn("token_key", names.token_key(F.col("normalized_name"))).withColumn("search_names", names.search_names(name, F.col("entity_type"), plain))


def is_active(excluded: Column | None = None) -> Column:
    return F.trim(F.col("date_excluded") if excluded is None else excluded) == ""


def name_index(records: DataFrame) -> DataFrame:
    """One row for each record and search name."""
    return records.select("record_id", F.col("entity_type").alias("record_type"), "normalized_name", F.explode("search_names").alias("search_name"))


def token_index(records: DataFrame) -> DataFrame:
    """One row for each record and token of its search names."""
    found = F.array_distinct(F.flatten(F.transform("search_names", names.tokens)))
    return records.select("record_id", F.col("entity_type").alias("record_type"), F.explode(found).alias("token"))
