"""Cache decisions, the search gate, outcomes and attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.schemas import FAILED, SUCCESS, UNRESOLVED

# Fixed values.
NO_LINKS = "Ссылки не найдены."
NO_ITEM = "Модель не вернула сущность."
DEFERRED = "Дневной лимит исчерпан, сущность отложена."


def reuse(status: Column, attempts: Column, config) -> Column:
    """Whether a stored row stands: true, or false if the entity is worked on."""
    spent = attempts >= config.max_llm_attempts_per_entity
    return (
        F.when(status.isNull(), False)
        .when(status == SUCCESS, F.lit(config.skip_cached_success))
        .when(status == UNRESOLVED, spent | F.lit(not config.reprocess_unresolved))
        .when(status == FAILED, spent | F.lit(not config.reprocess_failed))
        .otherwise(False)
    )


def needs_search(n_links: Column, config) -> Column:
    """Links of the registry are counted before they are sanitized."""
    if not config.llm_enabled:
        return F.lit(False)
    return {"full": F.lit(True), "economy": n_links == 0, "balanced": n_links < config.registry_min_links_to_skip_llm}[config.resolution_mode]


def batches(pending: DataFrame, size: int, most: int) -> DataFrame:
    """The first `most` rows in order of row_no, with batch_no: consecutive rows.

    `most` is what a run can ask. The first rows are found by partial top-k in each task before they are numbered by one, so
    that task holds `most` rows whatever the list.
    """
    first = pending.orderBy("row_no").limit(most)
    return first.withColumn("batch_no", F.floor((F.row_number().over(Window.orderBy("row_no")) - 1) / size).cast("long"))


def outcome(event: Column, n_links: Column, error: Column) -> Column:
    """status, increment and last_error of an event.

    event: final (no search), item (returned), missing (not returned), error (batch failed), quota (deferred), resolve
    (the registry lookup failed).
    """
    linked = n_links > 0
    status = F.when(event == "resolve", FAILED).when(linked, SUCCESS).otherwise(UNRESOLVED)
    more = F.when(event == "resolve", 1).when(linked | event.isin("final", "quota"), 0).otherwise(1)
    reason = (
        F.when(event == "resolve", error)
        .when(linked, F.lit(None))
        .when(event == "missing", NO_ITEM)
        .when(event == "error", error)
        .when(event == "quota", DEFERRED)
        .otherwise(NO_LINKS)
    )
    return F.struct(status.alias("status"), more.cast("long").alias("increment"), reason.alias("last_error"))


def upsert(stored: DataFrame, saved: DataFrame) -> DataFrame:
    """The stored rows with the saved ones put in by cache_key; attempts only grow.

    saved: the stored columns without attempts, and increment.
    """
    before = stored.select("cache_key", F.col("attempts").alias("__before"))
    new = saved.join(before, "cache_key", "left").withColumn("attempts", F.coalesce("__before", F.lit(0)).cast("long") + F.col("increment")).select(stored.columns)
    return stored.join(saved.select("cache_key"), "cache_key", "left_anti").unionByName(new)


def run_counts(rows: DataFrame) -> DataFrame:
    """Numbers of rows by status, in one row."""
    status = F.col("status")
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(status == SUCCESS).alias("success"),
        F.count_if(status == UNRESOLVED).alias("unresolved"),
        F.count_if(status.isNotNull() & ~status.isin(SUCCESS, UNRESOLVED)).alias("failed"),
        F.count_if(status.isNull()).alias("not_processed"),
    )


def request_windows(requests: DataFrame, key: str, time: str, seconds: int = 60) -> DataFrame:
    """With in_window: the requests of the key in the seconds up to each, itself and those of its instant included."""
    at = F.unix_micros(F.col(time))
    return requests.withColumn("in_window", F.count("*").over(Window.partitionBy(key).orderBy(at).rangeBetween(-(seconds * 1_000_000 - 1), 0)))


def usage(events: DataFrame, zone: str) -> DataFrame:
    """Sums of the event log by day in the budget's time zone and by model."""
    day = F.date_format(F.from_utc_timestamp("at", zone), "yyyy-MM-dd").alias("usage_date")
    return events.groupBy(day, "model").agg(*(F.sum(c).alias(c) for c in ("requests", "entities_sent", "successful_entities", "failed_requests")))
