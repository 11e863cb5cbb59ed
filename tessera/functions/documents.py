"""Links of HTML pages."""

from __future__ import annotations

import json
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tessera.functions.urls import detect_platform, is_profile_url, normalize_url


class _Anchors(HTMLParser):
    """href of every anchor, and the text of every JSON-LD script."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs: list[str] = []
        self.scripts: list[str] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if tag == "a" and values.get("href") is not None:
            self.hrefs.append(values["href"].strip())
        if tag == "script" and values.get("type") == "application/ld+json":
            self.inside = True
            self.scripts.append("")

    def handle_endtag(self, tag):
        if tag == "script":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.scripts[-1] += data


def same_as(value, out: list[str]) -> list[str]:
    """sameAs texts of a JSON value, at any depth, an object before its members."""
    stack = [value]
    while stack:
        value = stack.pop()
        if isinstance(value, dict):
            found = value.get("sameAs")
            out += [found] if isinstance(found, str) else [x for x in found if isinstance(x, str)] if isinstance(found, list) else []
            stack += reversed(list(value.values()))
        elif isinstance(value, list):
            stack += reversed(value)
    return out


def page_links(html: str | None, base: str | None) -> list[str]:
    """Resolved anchors of a page, then its sameAs texts."""
    if not html:
        return []
    parser = _Anchors()
    parser.feed(html)
    parser.close()
    out = []
    for href in parser.hrefs:
        try:
            out.append(urljoin(base or "", href))
        except ValueError:
            continue
    for script in parser.scripts:
        try:
            same_as(json.loads(script), out)
        except (ValueError, RecursionError):
            continue
    return out


@F.pandas_udf(ArrayType(StringType()))
def raw_page_links(html: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([page_links(h, b) for h, b in zip(html, base)])


def social_links(html: Column, base: Column) -> Column:
    """Normalized profile links of a page on known platforms, in order, without repeats."""
    found = F.filter(raw_page_links(html, base), lambda u: detect_platform(u) != "website")
    return F.array_distinct(F.filter(F.transform(found, normalize_url), lambda u: u.isNotNull() & is_profile_url(u)))


def anchor_hrefs(html: Column) -> Column:
    """href of every anchor of a page, by expression alone (comments dropped)."""
    shown = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    return F.regexp_extract_all(shown, F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))
