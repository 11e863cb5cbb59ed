"""Golden values of the scalar functions, and properties of them."""

import random
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tessera.functions import documents, names, urls
from tessera.operators import matching, search


def one(spark, column_of, *values):
    """column_of(columns...) over one row of texts."""
    fields = ", ".join(f"c{i} string" for i in range(len(values)))
    return spark.createDataFrame([values], fields).select(column_of(*(F.col(f"c{i}") for i in range(len(values)))).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("name", "want"),
    [("Ёлкин  «Фонд» \"X\"", "елкин фонд x"), ("ФОНД №5 ①", "фонд no5 1"), ("İzmir", "i zmir"), ("Straße Éa", "stra e a"), ("", ""), ("«»", "")],
)
def test_normalize_name(spark, name, want):
    assert one(spark, names.normalize_name, name) == want


def test_plain_names_need_no_udf(spark):
    texts = ["Ёлкин «Фонд»", "ООО «Ромашка Медиа» (x)", "a-b_c"]
    frame = spark.createDataFrame([(t,) for t in texts], "c string")
    for row in frame.select("c", names.normalize_plain(F.col("c")).alias("p"), names.normalize_name(F.col("c")).alias("n")).collect():
        assert row.p == row.n and unicodedata.normalize("NFKC", row.c) == row.c


def test_keys(spark):
    key = lambda c: names.token_key(names.normalize_name(c))
    assert one(spark, key, "Тестов Пётр Ильич") == "ильич петр тестов"
    assert one(spark, lambda c: names.organization_key(names.normalize_name(c)), "ООО «Ромашка Медиа»") == "медиа ромашка"
    person = one(spark, lambda c: names.cache_key(names.normalize_name(c), F.lit("person")), "Тестов Пётр Ильич")
    assert person == "ecb39e022b602e1f6b6dda84743e17688f271d999f4d171e1bb5ca340f858780"
    organization = one(spark, lambda c: names.cache_key(names.normalize_name(c), F.lit("organization")), "ООО Ромашка Медиа")
    assert organization == "1eee75450c0efdcc4621470137c61271ec815c4623e66b240db16ae4096bf2b1"
    assert one(spark, lambda c: names.shard_of(c, 4), person) == 3 and one(spark, lambda c: names.shard_of(c, 4), organization) == 0


def test_search_names(spark):
    got = one(spark, lambda c: names.search_names(c, F.lit("organization")), 'Фонд "Ромашка; Медиа" (Луг)')
    assert got == ["фонд ромашка медиа луг", "луг медиа ромашка", "фонд", "ромашка медиа", "медиа ромашка", "ромашка", "медиа", "луг"]
    assert one(spark, lambda c: names.search_names(c, F.lit("person")), "Тестов Пётр Ильич") == ["тестов петр ильич", "тестов петр", "петр тестов", "тестов ильич", "ильич тестов"]
    assert one(spark, lambda c: names.search_names(c, F.lit("unknown")), "Тестов Пётр Ильич") == ["тестов петр ильич"]


def plain_score(a, b, kind):
    """The definition, in plain Python, over normalized names."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    x, y = ([t for t in s.split() if t not in names.LEGAL_FORM_WORDS] for s in (a, b)) if kind == "organization" else (a.split(), b.split())
    if kind == "organization":
        x, y = sorted(x), sorted(y)
    if not x or not y:
        return 0.0
    if set(x) == set(y):
        return 0.99
    both = len(set(x) & set(y))
    j, c = both / len(set(x) | set(y)), both / min(len(set(x)), len(set(y)))
    s1 = SequenceMatcher(None, " ".join(x), " ".join(y)).ratio()
    s2 = SequenceMatcher(None, " ".join(sorted(x)), " ".join(sorted(y))).ratio()
    return max(0.45 * s1 + 0.35 * j + 0.20 * c, 0.55 * s2 + 0.30 * j + 0.15 * c)


@pytest.mark.parametrize(
    ("a", "b", "kind", "want"),
    [
        ("Тестов Пётр Ильич", "Петр Ильич Тестов", "person", 0.99),
        ("Тестов Пётр Ильич", "Тестов Пётр", "person", 0.786905),
        ("Тестов Пётр Ильич", "Тестова Пётр Ильич", "person", 0.784286),
        ("ООО «Ромашка Медиа»", 'Фонд "Ромашка Медиа"', "organization", 0.99),
        ("Acme Media Ltd", "Acme Medea Group", "organization", 0.530769),
        ("Фонд", "ООО", "organization", 0.0),
        ("Ромашка Медиа Север", "Ромашка Медиа", "organization", 0.798958),
    ],
)
def test_match_score(spark, a, b, kind, want):
    score = one(spark, lambda x, y: names.match_score(names.normalize_name(x), names.normalize_name(y), F.lit(kind)), a, b)
    assert score == pytest.approx(want, abs=1e-6)


def test_scores_equal_the_definition_and_stay_under_the_bound(spark):
    r = random.Random(4)
    pool = ["фонд", "ооо", "ромашка", "медиа", "север", "acme", "acma", "луг", "лугов", "ltd"]
    rows = [(" ".join(r.choices(pool, k=r.randint(0, 5))), " ".join(r.choices(pool, k=r.randint(0, 5))), r.choice(["person", "organization"])) for _ in range(600)]
    frame = spark.createDataFrame(rows, "a string, b string, kind string")
    organization = F.col("kind") == "organization"
    x, y = (F.when(organization, names.core_tokens(F.col(c))).otherwise(names.tokens(F.col(c))) for c in "ab")
    _, j, c = names.overlap(x, y)
    for row in frame.select("*", names.match_score(F.col("a"), F.col("b"), F.col("kind")).alias("s"), names.score_bound(j, c).alias("most")).collect():
        assert row.s == pytest.approx(plain_score(row.a, row.b, row.kind), abs=1e-12)
        assert row.most is None or row.s in (0.0, 1.0, 0.99) or row.s <= row.most + 1e-9


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://WWW.Example.COM//a//b/?q=1#f", "https://example.com/a/b?q=1"),
        ("http://t.me/s/chan/", "http://t.me/chan"),
        ("https://user@Host.com:8080/p;par?x", "https://user@host.com:8080/p?x"),
        ("https://www.www.a.ru/", "https://www.a.ru/"),
        ("example.com/x", "example.com/x"),
        ("http://h.com?x=1", "http://h.com/?x=1"),
        ("  https://хx.com/a ", "https://хx.com/a"),
        ("https://Х.com/name", "https://x.com/name"),
        ("http://www.youtube.eom/@a", "http://youtube.com/@a"),
        ("http://[abc", None),
        ("", ""),
    ],
)
def test_normalize_url(spark, url, want):
    assert one(spark, urls.normalize_url, url) == want


def test_url_kinds(spark):
    cases = {
        "https://t.me/a": ("telegram", True),
        "https://sub.vk.com/x": ("vk", True),
        "https://vk.com/": ("vk", False),
        "https://example.org": ("website", True),
        "https://x.com/a/status/1": ("x", False),
        "https://www.tiktok.com/@a": ("tiktok", True),
        "https://tiktok.com/a": ("tiktok", False),
        "https://linkedin.com/in/a": ("linkedin", True),
        "https://linkedin.com/a/b": ("linkedin", False),
        "https://youtube.com/channel/x": ("youtube", True),
        "https://youtube.com/watch?v=1": ("youtube", False),
        "https://search.example.org/": ("website", False),
        "ftp://example.org": ("website", False),
        "https://dzen.ru/a": ("dzen", True),
        "https://notvk.com/a": ("website", True),
        "http://[abc": ("unknown", False),
    }
    frame = spark.createDataFrame([(u,) for u in cases], "u string")
    got = {r.u: (r.p, r.ok) for r in frame.select("u", urls.detect_platform(F.col("u")).alias("p"), urls.is_profile_url(F.col("u")).alias("ok")).collect()}
    assert got == cases


def test_urls_in_text(spark):
    text = "сайт: https://WWW.a.example.org//x/, (http://t.me/s/abc); HTTPS://www.a.example.org/x ftp://no"
    assert one(spark, urls.urls_in_text, text) == ["https://a.example.org/x", "http://t.me/abc"]


def test_page_links(spark):
    html = (
        '<a href=" /local ">x</a><!-- <a href="https://vk.com/hidden"> --><a href="https://t.me/s/chan/">t</a><a href="https://x.com/a/status/1">p</a><a href="//youtube.com/@u&amp;v">y</a>'
        '<script type="application/ld+json">{"a": [{"sameAs": ["https://ok.ru/g", 5]}], "sameAs": "https://facebook.com/f"}</script><script type="application/ld+json">{bad</script>'
    )
    got = one(spark, lambda h: documents.social_links(h, F.lit("https://site.example.org/")), html)
    assert got == ["https://t.me/chan", "https://youtube.com/@u&v", "https://facebook.com/f", "https://ok.ru/g"]
    assert one(spark, documents.anchor_hrefs, html)[1:] == ["https://t.me/s/chan/", "https://x.com/a/status/1", "//youtube.com/@u&amp;v"]


def test_payloads():
    link = '{"platform": "x", "url": "https://x.com/a", "confidence": %s, "evidence": "e"}'
    good = '```json\n{"results": [{"entity_id": "1", "links": [' + link % "0.5" + "]}]}\n``` done"
    bad = '{"results": [{"entity_id": "1", "links": [' + link % "0.5" + ", " + link % "1.5" + "]}]}"
    assert search.check_items(search.read_object(good))[0]["links"][0]["confidence"] == 0.5
    for text in (bad, "no object", "[1]", '{"results": 5}'):
        with pytest.raises(search.InvalidResponse):
            search.check_items(search.read_object(text))


def test_variants_of_a_name_are_cut_before_they_are_normalized(spark):
    """Full-width quotes and parentheses are no quotes and parentheses of the name as given."""
    found = lambda name: one(spark, lambda n: names.search_names(n, F.lit("unknown")), name)
    assert found("Медиа （Луг） ＂Дом＂") == ["медиа луг дом"]
    assert found('Медиа № (Луг ①) "Дом"') == ["медиа no луг 1 дом", "медиа no луг 1", "дом", "луг 1"]


def test_names_in_notes_are_quoted_like_texts(spark):
    for name in ("plain", "it's", 'a "b"', "it's \"b\"", "back\\slash", "a\nb\tc"):
        assert one(spark, matching.quoted, name) == repr(name)
