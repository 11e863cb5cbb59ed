"""Record schemas as DDL."""

LINK = "struct<platform: string, url: string, confidence: double, evidence: string, source: string, source_urls: array<string>>"
LINKS = f"array<{LINK}>"
ENTITY = "entity_id string, name string, entity_type string, row_no long"
RECORD = (
    "record_id string, registry_number long, display_name string, normalized_name string, token_key string, search_names array<string>, entity_type string, category string, resources_raw string, "
    f"links {LINKS}, date_included string, date_excluded string, inn string, ogrn string, birth_date string, participants_raw string, raw string"
)
#: One resolved entity.
RESULT = (
    f"struct<entity_id: string, input_name: string, canonical_name: string, entity_type: string, ambiguous: boolean, ambiguity_notes: array<string>, aliases_used: array<string>, links: {LINKS}, search_used: boolean, "
    "search_queries: array<string>, grounding_sources: array<string>, registry_record_ids: array<string>, registry_numbers: array<bigint>, registry_names: array<string>, registry_match_score: double, "
    "registry_has_active_record: boolean, resolution_sources: array<string>, needs_human_review: boolean>"
)
STORED = f"cache_key string, input_name string, entity_type string, status string, result {RESULT}, attempts long, last_error string, updated_at timestamp"
#: A search answer: one item for each entity found.
ITEM = f"struct<entity_id: string, canonical_name: string, ambiguous: boolean, ambiguity_notes: array<string>, aliases_used: array<string>, links: {LINKS}>"
SUCCESS, UNRESOLVED, FAILED, NOT_PROCESSED = "success", "unresolved", "failed", "not_processed"
