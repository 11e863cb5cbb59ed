"""URLs: repair, normalization, classification and extraction from text, as column functions.

A URL is taken apart by the RFC 3986 expression, since the built-in parse_url rejects hosts outside ASCII. A URL that
no parser accepts (an open bracket in its host) is null and so dropped; nothing stops for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PLATFORM_DOMAINS = {
    "telegram": ("t.me", "telegram.me"),
    "instagram": ("instagram.com",),
    "facebook": ("facebook.com", "fb.com"),
    "x": ("x.com", "twitter.com"),
    "youtube": ("youtube.com", "youtu.be"),
    "vk": ("vk.com",),
    "linkedin": ("linkedin.com",),
    "tiktok": ("tiktok.com",),
    "ok": ("ok.ru",),
    "threads": ("threads.net", "threads.com"),
    "boosty": ("boosty.to",),
    "patreon": ("patreon.com",),
    "dzen": ("dzen.ru",),
    "bluesky": ("bsky.app",),
    "medium": ("medium.com",),
    "livejournal": ("livejournal.com",),
}
BAD_PARTS = ("/search", "/hashtag/", "/explore/", "/status/", "/posts/", "/post/", "/share", "/sharer", "/intent/", "/reel/", "/stories/", "/watch", "/results", "/tag/")
PATH_PLATFORMS = ("telegram", "instagram", "x", "vk", "ok", "threads", "boosty", "patreon", "bluesky", "medium", "facebook")

REPAIRS = ((r"^(https?://)[хХ]\.com", "$1x.com"), (r"(?i)^(https?://)(?:www\.)?youtube\.eom", "$1youtube.com"))

SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, SPLIT, k)


def strip(value: Column) -> Column:
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def repair_url(url: Column) -> Column:
    """Trimmed, without no-break spaces, with two usual misspellings of hosts mended."""
    value = F.translate(strip(url), "\u00a0", "")
    for wrong, right in REPAIRS:
        value = F.regexp_replace(value, wrong, right)
    return value


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def broken(url: Column) -> Column:
    """Brackets of the host that do not pair: no parser accepts such a URL."""
    return url.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#\]]*\[[^/?#\]]*|[^/?#\[]*\][^/?#\[]*)(?:[/?#]|$)")


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host without one leading www., single slashes, no closing slash, parameters or fragment."""

    def put(v: Column) -> Column:
        scheme = F.regexp_replace(F.lower(_part(v, 1)), "^(.+)$", "$1:")
        host = F.regexp_replace(F.regexp_replace(F.lower(_part(v, 2)), r"^www\.", ""), "^(.+)$", "//$1")
        path = F.regexp_replace(F.regexp_replace(F.regexp_replace(_part(v, 3), ";[^/]*$", ""), "^$", "/"), "/+", "/")
        place = F.regexp_replace(F.concat(host, path), r"^//(t\.me|telegram\.me)/s/", "//$1/")
        place = F.regexp_replace(F.regexp_replace(place, "(?s)^(//[^/]+/.*[^/])/+$", "$1"), "(?s)^((?!//).*[^/])/+$", "$1")
        query = F.regexp_replace(_part(v, 4), "(?s)^(.+)$", "?$1")
        return F.when(v == "", "").when(broken(v), F.lit(None)).otherwise(F.concat(scheme, place, query))

    return let(repair_url(url), put)


def hostname(url: Column) -> Column:
    """Host without user and port, in lower case; an empty text where there is none."""
    host = F.regexp_replace(_part(url, 2), "^.*@", "")
    return F.lower(F.regexp_replace(host, r":[^\]:]*$", ""))


def is_http_url(url: Column) -> Column:
    return F.coalesce(F.lower(_part(url, 1)).isin("http", "https") & (hostname(url) != "") & ~broken(url), F.lit(False))


_DOMAINS = {domain: platform for platform, domains in PLATFORM_DOMAINS.items() for domain in domains}
_DOMAIN = rf"(?:^|\.)({'|'.join(d.replace('.', chr(92) + '.') for d in _DOMAINS)})$"


def detect_platform(url: Column) -> Column:
    """The platform whose domain the host is or lies under, `website` for any other host, `unknown` for a broken URL."""
    known = F.create_map(*(F.lit(x) for pair in _DOMAINS.items() for x in pair))
    found = F.coalesce(F.try_element_at(known, F.regexp_extract(hostname(url), _DOMAIN, 1)), F.lit("website"))
    return F.when(broken(url), "unknown").otherwise(found)


def is_bad_url(url: Column) -> Column:
    return ~is_http_url(url) | F.lower(url).rlike("|".join(BAD_PARTS))


def is_profile_url(url: Column) -> Column:
    """Whether a URL may be a site or profile of its owner rather than a post or a search."""
    path = F.regexp_replace(F.regexp_replace(_part(url, 3), r";[^/]*$", ""), "^/+|/+$", "")
    known = F.struct(F.coalesce(is_bad_url(url), F.lit(True)).alias("bad"), detect_platform(url).alias("platform"), path.alias("path"), F.filter(F.split(path, "/"), lambda p: p != "").alias("parts"))

    def decide(u: Column) -> Column:
        platform, parts = u["platform"], u["parts"]
        first = F.coalesce(F.get(parts, F.lit(0)), F.lit(""))
        return (
            F.when(u["bad"], False)
            .when(platform == "website", True)
            .when(u["path"] == "", False)
            .when(platform.isin(*PATH_PLATFORMS), F.size(parts) >= 1)
            .when(platform == "tiktok", (F.size(parts) == 1) & first.startswith("@"))
            .when(platform == "linkedin", (F.size(parts) >= 2) & first.isin("in", "company", "school"))
            .when(platform == "youtube", u["path"].rlike("^(@|channel/|user/|c/)"))
            .otherwise(True)
        )

    return let(known, decide)


def urls_in_text(text: Column) -> Column:
    """The normalized http(s) URLs of a text, in order, without repeats."""
    found = F.regexp_extract_all(F.translate(text, "\u00a0", " "), F.lit(r"(?iU)(https?://[^\s;,]+)"), F.lit(1))
    cleaned = F.transform(found, lambda u: normalize_url(repair_url(F.regexp_replace(u, r'[.,:!?)\]}»"]+$', ""))))
    return F.array_distinct(F.filter(cleaned, is_http_url))
