"""The bulk run: cache, registry, search, results.

One plan per pass; tables are written between passes, since what is stored must be settled before calls are spent.
"""

from __future__ import annotations

import json
import logging
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import Config
from tessera.operators import entities as E
from tessera.operators import answers, links, matching, registry, results, state
from tessera.operators.search import LOG, RegistryError, Searcher, spend
from tessera.schemas import ITEM, RECORD, RESULT, STORED
from tessera.sources import files, web
from tessera.sources.store import Store

OUTCOME = f"cache_key string, event string, item {ITEM}, error string, search_used boolean, search_queries array<string>, grounding_sources array<string>"


class Counts(NamedTuple):
    """What a run did: rows listed and selected, entities worked on, their statuses after it, and batches."""

    listed: int
    selected: int
    worked: int
    pending: int
    answered: int
    success: int
    unresolved: int
    failed: int

    @property
    def reused(self) -> int:
        return self.selected - self.worked


#: What a download can fail with; anything else is an error of the program and passes.
UNREADABLE = (RegistryError, OSError, PySparkException, Py4JJavaError)


class Engine:
    """A store, a configuration and the providers of a run.

    registry_rows() -> raw rows (pos and raw fields); provider.ask() answers batches; pages has url and html, without it
    official sites are fetched.
    """

    def __init__(self, spark: SparkSession, config: Config, registry_rows=None, provider=None, ledger=None, pages: DataFrame | None = None, sleep=None, fetch=web.fetch_html):
        self.spark, self.config, self.registry_rows, self.pages, self.fetch = spark, config, registry_rows, pages, fetch
        logging.getLogger("tessera").setLevel(config.log_level.upper())
        self.store = Store(spark, config.store_dir)
        self.searcher = None
        if config.llm_enabled and provider is not None:
            self.searcher = Searcher(provider, ledger, config, **({"sleep": sleep} if sleep else {}))

    def stored(self) -> DataFrame:
        return self.store.load("results", STORED)

    def ensure_registry(self, force: bool = False) -> DataFrame:
        """The registry, downloaded anew if it is stale; an old copy serves where that fails."""
        c, store = self.config, self.store
        if not c.registry_enabled:
            return self.spark.createDataFrame([], RECORD)
        have = store.count("registry") > 0
        if force:
            store.expire("registry")
        elif have and (store.is_fresh("registry", c.registry_ttl_hours) or not c.registry_refresh):
            return self._load_registry()
        try:
            if self.registry_rows is None:
                raise RegistryError("no registry provider")
            records = registry.parse(self.registry_rows(), c.registry_confidence, c.registry_page_url)
            names = [x.split()[0] for x in RECORD.split("links")[0].split(", ") if x.strip()]
            records = records.select(*names, "links", "date_included", "date_excluded", "inn", "ogrn", "birth_date", "participants_raw", "raw")

            def check(n: int) -> None:
                if not c.registry_min_expected <= n <= c.registry_max_records:
                    raise RegistryError(f"{n} records were read, {c.registry_min_expected} to {c.registry_max_records} are expected")

            store.replace("registry", records, check)
        except UNREADABLE as error:
            LOG.warning("the registry could not be read: %s", str(error).split("\n")[0])
            if not have and c.registry_required:
                raise error if isinstance(error, RegistryError) else RegistryError(str(error)) from error
            if not have:
                return self.spark.createDataFrame([], RECORD)
        return self._load_registry()

    def _load_registry(self) -> DataFrame:
        rows = self.store.load("registry", RECORD)
        return rows if self.config.registry_include_excluded else rows.where("date_excluded = ''")

    def resolve(self, entities: DataFrame, records: DataFrame) -> DataFrame:
        """Keyed entities (one for each cache_key) with their result from the registry."""
        named = matching.with_search_names(entities)
        found = matching.lookup(named, records, self.config.registry_match_threshold, self.config.registry_match_margin)
        return results.from_registry(entities, found)

    def _finalized(self, rows: DataFrame) -> DataFrame:
        pages = self.pages
        if self.config.crawler_enabled and pages is None:
            rows = self._snapshot("sites", rows)
            sites = links.sites_to_visit(F.col("result.links"), self.config.crawler_skip_if_links, self.config.crawler_min_site_confidence, self.config.crawler_max_sites)
            urls = rows.select(F.explode(F.transform(sites, lambda x: x["url"])).alias("url"))
            pages = self._snapshot("pages", web.pages_of(urls, self.config, self.fetch))
        return results.finalized(rows, self.config, pages)

    def run(self, entities: DataFrame | None = None, stored_answers: DataFrame | None = None) -> tuple[Counts, DataFrame]:
        """Work on the list; the counts and the output rows, which are also written.

        With stored_answers (columns of answers.ANSWER; ids are cache keys) what is left is looked up there instead of being asked,
        as one plan; what no answer was asked for is deferred.
        """
        c, spark = self.config, self.spark
        entities = files.read_entities(spark, c.input_csv) if entities is None else entities
        total = entities.count()
        keyed = E.keyed(entities)
        selected = E.first_rows(E.in_shard(keyed, c.shard_count, c.shard_index) if c.shard_count > 1 else keyed, c.max_entities_per_run)
        selected = self._snapshot("selected", selected)
        records = self.ensure_registry()

        stored = self.stored()
        unique = E.first_of_each(selected)
        marked = unique.join(stored.select("cache_key", F.col("status").alias("old_status"), F.col("attempts").alias("old_attempts")), "cache_key", "left")
        marked = marked.withColumn("reused", state.reuse(F.col("old_status"), F.col("old_attempts"), c))
        work = marked.where(~F.col("reused")).select(*unique.columns)
        resolved = self.resolve(work, records).withColumn("search", state.needs_search(F.size("result.links"), c) & F.lit(self.searcher is not None or stored_answers is not None))
        resolved = self._snapshot("resolved", resolved)

        final = self._finalized(resolved.where(~F.col("search")))
        final = final.withColumn("o", state.outcome(F.lit("final"), F.size("result.links"), F.lit(None).cast("string")))
        self._save(final)
        pending = resolved.where("search")
        counts = {"listed": total, "selected": selected.count(), "worked": resolved.count(), "pending": pending.count()}
        LOG.info("%(listed)s rows, %(selected)s selected, %(worked)s entities worked on, %(pending)s to search", counts)
        if stored_answers is not None:
            counts["answered"] = self._take(pending, stored_answers)
        else:
            counts["answered"] = self._search(pending) if counts["pending"] else 0

        rows = self._snapshot("output", files.output_rows(selected, self.stored()))
        touched = resolved.select("cache_key").join(self.stored(), "cache_key")
        ended = state.run_counts(touched).first()
        stats = Counts(**counts, **{k: ended[k] for k in ("success", "unresolved", "failed")})
        LOG.info("%s success, %s unresolved, %s failed, %s batches answered", stats.success, stats.unresolved, stats.failed, stats.answered)
        files.write_results(rows, c.sharded(c.output_jsonl))
        files.write_unresolved(rows, c.sharded(c.unresolved_csv))
        return stats, rows

    def _snapshot(self, name: str, rows: DataFrame) -> DataFrame:
        return self.store.replace(f"run_{name}", rows)

    def _save(self, rows: DataFrame, settled: list[str] | None = None) -> None:
        """Rows with result and o (the outcome) into the stored results; settled names the logged outcomes that they hold."""
        self._drop_settled()
        saved = rows.select("cache_key", F.col("name").alias("input_name"), "entity_type", "o.status", "result", "o.last_error", F.current_timestamp().alias("updated_at"), "o.increment")
        self.store.replace("results", state.upsert(self.stored(), saved), settled=settled or [])
        self._drop_settled()

    def _drop_settled(self) -> None:
        """Delete logged outcomes that the stored results hold, also after a stop between the two."""
        self.store.drop((self.store.manifest("results") or {}).get("settled", []))

    def _search(self, pending: DataFrame) -> int:
        """Batches are asked one by one, their outcomes appended as files before the next is asked; at most the run's calls are made.

        Outcomes that a stopped run left in these files are taken up, and their entities not asked again.
        """
        c = self.config
        logged = {name: [json.loads(x) for x in lines] for name, lines in self.store.logged("asked").items()}
        left = self.spark.createDataFrame([(name, o["cache_key"]) for name, found in logged.items() for o in found], "file string, cache_key string")
        known = left.join(pending.select("cache_key"), "cache_key", "left_semi").collect()
        keys, settled = {r["cache_key"] for r in known}, sorted({r["file"] for r in known})
        outcomes: list[dict] = list({o["cache_key"]: o for name in settled for o in logged[name] if o["cache_key"] in keys}.values())

        def save(batch: list[dict]) -> None:
            outcomes.extend(batch)
            lines = [json.dumps(o, ensure_ascii=False) for o in batch if o["event"] != "quota"]  # deferred ones were not asked
            if lines:
                settled.append(self.store.append("asked", lines))

        fresh = pending.join(left.select("cache_key").distinct(), "cache_key", "left_anti")
        # What a run can ask is bounded by its calls; entities behind that are deferred without being sent to the driver.
        most = (c.llm_max_calls_per_run or c.llm_daily_budget) * c.llm_batch_size
        asked = sorted(state.batches(fresh, c.llm_batch_size, most).select("batch_no", "row_no", "cache_key", "name", "entity_type").collect(), key=lambda r: r["row_no"])
        groups: dict[int, list[dict]] = {}
        for r in asked:
            groups.setdefault(r["batch_no"], []).append({"id": r["cache_key"], "name": r["name"], "type": r["entity_type"]})
        answered = spend([groups[k] for k in sorted(groups)], self.searcher, save, c.progress_every)
        lines = [json.dumps(o, ensure_ascii=False) for o in outcomes]
        made = self.spark.createDataFrame([(x,) for x in lines], "line string").select(F.from_json("line", OUTCOME).alias("o")).select("o.*")
        self._settle(pending, made, settled)
        return answered

    def _take(self, pending: DataFrame, stored_answers: DataFrame) -> int:
        """Outcomes from a table of answers; of several for one entity an item counts before a missing one and that before an error.

        Returns the number of sound answers that were asked for a pending entity.
        """
        made = answers.outcomes(stored_answers, self.config.llm_require_grounding)
        rank = F.struct(F.when(F.col("event") == "item", 0).when(F.col("event") == "missing", 1).otherwise(2).alias("rank"), F.to_json(F.struct(*made.columns)).alias("text"))
        best = self._snapshot("answers", made.groupBy("cache_key").agg(F.min_by(F.struct(*(c for c in made.columns if c != "cache_key")), rank).alias("o")).select("cache_key", "o.*"))
        self._settle(pending, best, [])
        sound = answers.checked(answers.grounding(stored_answers), self.config.llm_require_grounding).where("error IS NULL")
        numbered = sound.withColumn("answer_no", F.monotonically_increasing_id()).select("answer_no", F.explode("ids").alias("cache_key"))
        return numbered.join(pending.select("cache_key"), "cache_key", "left_semi").agg(F.count_distinct("answer_no")).first()[0]

    def _settle(self, pending: DataFrame, made: DataFrame, settled: list[str]) -> None:
        """Store the pending entities with their outcomes; those without one are deferred."""
        joined = pending.join(made, "cache_key", "left").withColumn("event", F.coalesce("event", F.lit("quota")))
        merged = results.with_item(F.col("result"), F.col("item"), F.col("search_used"), F.col("search_queries"), F.col("grounding_sources"))
        joined = joined.withColumn("result", F.when(F.col("event") == "item", merged).when(F.col("event") == "missing", F.col("result").withField("search_used", F.col("search_used"))).otherwise(F.col("result")).cast(RESULT))
        final = self._finalized(joined)
        final = final.withColumn("o", state.outcome(F.col("event"), F.size("result.links"), F.col("error")))
        self._save(final, settled)

    def resolve_one(self, name: str, entity_type: str = "unknown", entity_id: str = "1") -> dict:
        """One entity, without the cache and without storing; errors of the search pass through."""
        rows = self.spark.createDataFrame([(entity_id, name, entity_type, 1)], "entity_id string, name string, entity_type string, row_no long")
        resolved = self.resolve(E.keyed(rows), self.ensure_registry()).withColumn("search", state.needs_search(F.size("result.links"), self.config) & F.lit(self.searcher is not None))
        if resolved.first()["search"]:
            found = self.searcher.batch([{"id": entity_id, "name": name, "type": entity_type}])
            if found["items"]:
                line = json.dumps({"item": found["items"][0]} | {k: found[k] for k in ("search_used", "search_queries", "grounding_sources")}, ensure_ascii=False)
                o = F.from_json(F.lit(line), OUTCOME)
                resolved = resolved.withColumn("result", results.with_item(F.col("result"), o["item"], o["search_used"], o["search_queries"], o["grounding_sources"]).cast(RESULT))
        final = self._finalized(resolved)
        return json.loads(final.select(F.to_json("result").alias("r")).first()["r"])
