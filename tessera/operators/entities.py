"""Entity lists: keys, shards, limits and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import names


def keyed(entities: DataFrame, plain: bool = False) -> DataFrame:
    """With normalized_name and cache_key."""
    normal = names.normalize_plain(F.col("name")) if plain else names.normalize_name(F.col("name"))
    return entities.withColumn("normalized_name", normal).withColumn("cache_key", names.cache_key(F.col("normalized_name"), F.col("entity_type")))


def in_shard(entities: DataFrame, shards: int, index: int) -> DataFrame:
    return entities.where(names.shard_of(F.col("cache_key"), shards) == index)


def first_rows(entities: DataFrame, limit: int) -> DataFrame:
    """The first rows of the list; 0 means all."""
    return entities.orderBy("row_no").limit(limit) if limit else entities


def first_of_each(entities: DataFrame) -> DataFrame:
    """The first row of each cache key."""
    columns = [c for c in entities.columns if c != "cache_key"]
    best = entities.groupBy("cache_key").agg(F.min_by(F.struct(*columns), "row_no").alias("r"))
    return best.select(*(F.col("cache_key") if c == "cache_key" else F.col(f"r.{c}").alias(c) for c in entities.columns))


def normalized_type(value):
    """A known entity type in lower case, else `unknown`."""
    lowered = F.lower(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)^\s+|\s+$", ""))
    return F.when(lowered.isin("person", "organization", "unknown"), lowered).otherwise("unknown")
