"""Column functions: names, URLs, JSON and HTML."""

from tessera.functions.documents import social_links
from tessera.functions.names import cache_key, match_score, normalize_name, search_names, sequence_ratio, shard_of, token_key
from tessera.functions.urls import detect_platform, is_bad_url, is_http_url, is_profile_url, normalize_url, repair_url, urls_in_text

__all__ = [
    "cache_key", "detect_platform", "is_bad_url", "is_http_url", "is_profile_url", "match_score", "normalize_name", "normalize_url", "repair_url", "search_names", "sequence_ratio", "shard_of", "social_links", "token_key", "urls_in_text",
]
