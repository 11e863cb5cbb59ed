"""Resolving a list of people and organizations against a registry, shard by shard, without a search.

Lists and registries come in tables of any form; two SELECTs of the configuration map them to entity_id, name, entity_type, row_no and to the raw
fields of the registry. Entities are keyed, matched once for each key (exact, token-set and fuzzy tiers with their ambiguity rules), the links of
their records merged, sanitized and ranked, and a row for each input row is written to OUTPUT/results in partitions by shard of the key,
what has no link also to OUTPUT/unresolved as CSV, by shard.

A run over all shards overwrites the whole output; a run over some (`only`) overwrites the partitions of these alone, so several
clusters can share a list, and a shard that failed is run again by itself. An entity keeps its shard, since that follows from its key, and every
run gives the same rows for the same tables.

Blank and null names are left out; unknown types count as `unknown`; repeated rows come out each, with the result of the first of
their key; an empty list or registry gives an empty output or unresolved rows; null or broken registry texts give no links.

    python -m jobs.resolve_entities --config jobs/resolve_entities.json --data DIR --output DIR [--only 0,3]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import LOG, session, settings
from tessera.config import Config
from tessera.functions import names
from tessera.operators import entities as E
from tessera.operators import matching, registry, results, state
from tessera.schemas import SUCCESS
from tessera.sources.files import entities_from

#: tables: names of Parquet tables of the data folder, {name} in the SELECTs; threshold and margin as in the match.
DEFAULTS = {
    "tables": ["entities", "registry"],
    "entities": "SELECT entity_id, name, entity_type, row_no FROM {entities}",
    "registry": "SELECT * FROM {registry}",
    "shards": 8,
    "threshold": 0.84,
    "margin": 0.04,
    "min_confidence": 0.45,
}


def mapped(spark: SparkSession, data: str, tables: list[str], select: str) -> DataFrame:
    """A SELECT over the tables that it names."""
    return spark.sql(select, **{t: spark.read.parquet(f"{data}/{t}.parquet") for t in tables if f"{{{t}}}" in select})


def records_of(raw: DataFrame) -> DataFrame:
    """Registry records; raw fields that the table lacks are null."""
    fields = [c.split()[0] for c in registry.RAW.split(", ")]
    have = {c.lower() for c in raw.columns}
    return registry.parse(raw.select(*(F.col(f"`{f}`").cast("string").alias(f) if f in have else F.lit(None).cast("string").alias(f) for f in fields)))


def resolved(entities: DataFrame, records: DataFrame, config: Config) -> DataFrame:
    """A row for each keyed entity row: its first namesake's result."""
    unique = E.first_of_each(entities)
    found = matching.lookup(matching.with_search_names(unique), records, config.registry_match_threshold, config.registry_match_margin)
    final = results.finalized(results.from_registry(unique, found), config)
    outcome = state.outcome(F.lit("final"), F.size("result.links"), F.lit(None).cast("string"))
    told = final.select("cache_key", outcome.alias("o"), "result").select("cache_key", "o.status", F.col("o.last_error").alias("error"), "result")
    return entities.select("cache_key", "entity_id", "name", "entity_type", "row_no").join(told, "cache_key")


def run(spark: SparkSession, data: str, output: str, only: list[int] | None = None, **given) -> DataFrame:
    """Resolve the list into OUTPUT/results and OUTPUT/unresolved, and return all results as they stand."""
    c = DEFAULTS | given
    config = Config(llm_enabled=False, registry_match_threshold=c["threshold"], registry_match_margin=c["margin"], min_confidence=c["min_confidence"])
    shard = names.shard_of(F.col("cache_key"), c["shards"])
    entities = E.keyed(entities_from(mapped(spark, data, c["tables"], c["entities"])))
    if only is not None:
        entities = entities.where(shard.isin(only))
    records = records_of(mapped(spark, data, c["tables"], c["registry"]))
    rows = resolved(entities, records, config).withColumn("shard", shard).hint("rebalance", "shard")
    mode = "static" if only is None else "dynamic"

    def write(frame: DataFrame):
        return frame.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("shard")

    write(rows).parquet(f"{output}/results")
    written = spark.read.schema(rows.schema).parquet(f"{output}/results")
    fresh = written if only is None else written.where(F.col("shard").isin(only))
    missing = fresh.where(F.col("status") != SUCCESS).select("entity_id", "name", "entity_type", "status", F.coalesce("error", F.lit("")).alias("error"), "shard")
    write(missing).option("header", True).option("escape", '"').csv(f"{output}/unresolved")
    counts = {r["status"]: r["count"] for r in fresh.groupBy("status").count().collect()}
    LOG.info("read %s; %s rows written to %s/results: %s", data, sum(counts.values()), output, counts)
    return written


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("jobs.resolve_entities")
    for name in ("config", "data", "output", "only"):
        parser.add_argument(f"--{name}", required=name in ("data", "output"))
    asked = parser.parse_args(arguments)
    spark = session("resolve-entities")
    try:
        only = [int(x) for x in asked.only.split(",")] if asked.only else None
        run(spark, asked.data, asked.output, only, **(settings(spark, asked.config, DEFAULTS) if asked.config else DEFAULTS))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
