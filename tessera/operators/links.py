"""Links: merging, sanitizing, ranking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import urls
from tessera.schemas import LINK, LINKS

# Fixed values.
MORE_EVIDENCE = " Дополнительное подтверждение: "


def empty_links() -> Column:
    return F.array().cast(LINKS)


def link(platform, url, confidence, evidence, source, source_urls) -> Column:
    return F.struct(platform.alias("platform"), url.alias("url"), confidence.alias("confidence"), evidence.alias("evidence"), source.alias("source"), source_urls.alias("source_urls")).cast(LINK)


def _fold(links: Column, step) -> Column:
    """For each distinct URL in order of first occurrence, its links folded from the left."""

    def fold(found: Column) -> Column:
        def of(url: Column) -> Column:
            return urls.let(F.filter(found, lambda x: x["url"] == url), lambda same: F.aggregate(F.slice(same, 2, F.greatest(F.size(same) - 1, F.lit(0))), F.element_at(same, 1), step))

        return F.transform(F.array_distinct(F.transform(found, lambda x: x["url"])), of)

    return urls.let(links, fold)


def merge_record_links(links: Column) -> Column:
    """By URL as it is: the first link, with the highest confidence and all source URLs in order."""

    def step(kept: Column, new: Column) -> Column:
        return link(kept["platform"], kept["url"], F.greatest(kept["confidence"], new["confidence"]), kept["evidence"], kept["source"], F.array_distinct(F.concat(kept["source_urls"], new["source_urls"])))

    return _fold(links, step)


def normalized(links: Column) -> Column:
    """With normalized URL and platform; links without a URL dropped."""
    made = F.transform(links, lambda x: x.withField("url", urls.normalize_url(x["url"])))
    kept = F.filter(made, lambda x: F.coalesce(x["url"], F.lit("")) != "")
    return F.transform(kept, lambda x: x.withField("platform", urls.detect_platform(x["url"])))


def merge_links(current: Column, more: Column) -> Column:
    """By normalized URL: a higher confidence takes the place of the first and cites its evidence, else it is cited itself."""

    def cite(one: Column, other: Column) -> Column:
        return F.when((other != "") & ~F.contains(one, other), F.concat(one, F.lit(MORE_EVIDENCE), other)).otherwise(one)

    def step(kept: Column, new: Column) -> Column:
        sources = F.array_distinct(F.concat(kept["source_urls"], new["source_urls"]))
        higher = new["confidence"] > kept["confidence"]
        pick = lambda field: F.when(higher, new[field]).otherwise(kept[field])
        evidence = F.when(higher, cite(new["evidence"], kept["evidence"])).otherwise(cite(kept["evidence"], new["evidence"]))
        return link(pick("platform"), kept["url"], pick("confidence"), evidence, pick("source"), sources)

    return _fold(normalized(F.concat(current, more)), step)


def sanitize(links: Column, least: float = 0.45) -> Column:
    """Profiles of enough confidence, with normalized URLs and sources, merged."""
    made = F.transform(links, lambda x: x.withField("url", urls.normalize_url(x["url"])))
    kept = F.filter(made, lambda x: x["url"].isNotNull() & urls.is_profile_url(x["url"]) & (x["confidence"] >= least))
    sources = lambda x: F.array_distinct(F.filter(F.transform(F.filter(x["source_urls"], urls.is_http_url), urls.normalize_url), lambda u: u.isNotNull()))
    return merge_links(empty_links(), F.transform(kept, lambda x: x.withField("source_urls", sources(x))))


def ordered(links: Column) -> Column:
    """By confidence, highest first; equal ones stay in order."""
    placed = F.transform(links, lambda x, i: F.struct((-x["confidence"]).alias("c"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(placed), lambda p: p["x"])


def finalize(links: Column, least: float = 0.45) -> Column:
    return ordered(sanitize(links, least))


def needs_review(links: Column, ambiguous: Column, threshold: float = 0.70) -> Column:
    return ambiguous | urls.let(links, lambda found: (F.size(found) == 0) | F.exists(found, lambda x: x["confidence"] < threshold))


def sites_to_visit(links: Column, enough: int = 4, least: float = 0.80, most: int = 3) -> Column:
    """The first websites worth a visit, unless there are links enough."""

    def choose(found: Column) -> Column:
        sites = F.slice(F.filter(found, lambda x: (x["platform"] == "website") & (x["confidence"] >= least)), 1, most)
        return F.when(F.size(found) >= enough, empty_links()).otherwise(sites)

    return urls.let(links, choose)


def site_links(found: Column, site: Column) -> Column:
    """Links made from the social URLs of an official site."""
    return F.transform(found, lambda u: link(urls.detect_platform(u), u, F.lit(0.97), F.lit("Ссылка размещена на официальном сайте."), F.lit("official_site"), F.array(site)))
