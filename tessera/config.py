"""Settings, from a mapping of names (environment variables, spark.conf or a dict), and their checks."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from zoneinfo import ZoneInfo

TRUE_WORDS = ("1", "true", "yes", "y", "on")
MODES = ("economy", "balanced", "full")


class ConfigError(ValueError):
    """A setting is out of its range."""


@dataclass(frozen=True)
class Config:
    # paths
    input_csv: str = "data/entities.csv"
    output_jsonl: str = "data/results.jsonl"
    unresolved_csv: str = "data/unresolved.csv"
    store_dir: str = "data/store"
    ledger_path: str = "data/usage.db"
    # run
    resolution_mode: str = "economy"
    max_entities_per_run: int = 0
    skip_cached_success: bool = True
    reprocess_unresolved: bool = True
    reprocess_failed: bool = True
    max_llm_attempts_per_entity: int = 2
    log_level: str = "INFO"
    progress_every: int = 50
    shard_count: int = 1
    shard_index: int = 0
    # registry
    registry_enabled: bool = True
    registry_required: bool = True
    registry_refresh: bool = True
    registry_ttl_hours: float = 24.0
    registry_url: str = ""
    registry_page_size: int = 200
    registry_page_delay: float = 0.2
    registry_timeout: float = 30.0
    registry_attempts: int = 3
    registry_base_delay: float = 2.0
    registry_min_expected: int = 500
    registry_max_records: int = 10_000
    registry_include_excluded: bool = True
    registry_page_url: str = "https://registry.example.org/"
    registry_match_threshold: float = 0.84
    registry_match_margin: float = 0.04
    registry_confidence: float = 0.98
    registry_min_links_to_skip_llm: int = 1
    # search
    llm_enabled: bool = True
    llm_model: str = "search-model"
    llm_url: str = ""
    llm_key: str = ""
    llm_require_grounding: bool = True
    llm_batch_size: int = 5
    llm_requests_per_minute: int = 5
    llm_daily_budget: int = 480
    llm_timezone: str = "America/Los_Angeles"
    llm_max_calls_per_run: int = 480
    llm_attempts: int = 2
    llm_base_delay: float = 2.0
    llm_temperature: float = 0.0
    llm_max_tokens: int = 8192
    # official sites
    crawler_enabled: bool = False
    crawler_timeout: float = 12.0
    crawler_max_bytes: int = 2_000_000
    crawler_max_sites: int = 3
    crawler_min_site_confidence: float = 0.80
    crawler_skip_if_links: int = 4
    # links
    min_confidence: float = 0.45
    human_review_threshold: float = 0.70

    def __post_init__(self):
        def need(fine: bool, what: str) -> None:
            if not fine:
                raise ConfigError(what)

        need(self.resolution_mode in MODES, f"resolution_mode must be one of {MODES}")
        need(self.shard_count >= 1 and 0 <= self.shard_index < self.shard_count, "0 <= shard_index < shard_count")
        need(not self.llm_enabled or bool(self.llm_key), "llm_key is needed while llm_enabled")
        need(1 <= self.llm_batch_size <= 10, "llm_batch_size is 1 to 10")
        need(self.llm_requests_per_minute >= 1, "llm_requests_per_minute is 1 or more")
        need(self.llm_daily_budget >= 1, "llm_daily_budget is 1 or more")
        need(self.llm_attempts >= 1 and self.max_llm_attempts_per_entity >= 1, "attempts are 1 or more")
        need(1 <= self.registry_page_size <= 1000, "registry_page_size is 1 to 1000")
        need(1 <= self.registry_min_expected <= self.registry_max_records, "1 <= registry_min_expected <= registry_max_records")
        try:
            ZoneInfo(self.llm_timezone)
        except Exception as error:
            raise ConfigError(f"llm_timezone: {self.llm_timezone}") from error

    @classmethod
    def from_mapping(cls, values: Mapping[str, str] | None = None, prefix: str = "") -> "Config":
        """Settings by upper-case or lower-case name, prefix before it; a blank number means the default."""
        values = os.environ if values is None else values
        made = {}
        for field in fields(cls):
            raw = values.get(f"{prefix}{field.name.upper()}", values.get(f"{prefix}{field.name}"))
            if raw is None:
                continue
            if field.type == "bool":
                made[field.name] = str(raw).strip().lower() in TRUE_WORDS
            elif field.type in ("int", "float"):
                if str(raw).strip():
                    made[field.name] = {"int": int, "float": float}[field.type](raw)
            else:
                made[field.name] = str(raw)
        return cls(**made)

    def sharded(self, path: str) -> str:
        """The path of this shard's file: {stem}.shard-{i}-of-{n}{suffix}."""
        if self.shard_count == 1:
            return path
        stem, suffix = os.path.splitext(path)
        return f"{stem}.shard-{self.shard_index}-of-{self.shard_count}{suffix}"
