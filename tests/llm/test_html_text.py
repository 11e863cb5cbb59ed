import html
import random
import re
import time

import pytest

from tessera.llm.html_text import STOP_WORDS, blocks, extract, main_text, second_pass

PROSE = "The house of the old man and the sea is a tale that was told by many of the people in the town with great care and love for it, and it has been read by all of them."


def test_driver_pages_equal_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", p))).strip() for p in re.split(r"</?p>|</?h1>", article)]
        assert got[row.page_id].text == "\n\n".join(p for p in parts if p) and got[row.page_id].n_chars == len(got[row.page_id].text)


def test_boilerplate_is_dropped_inside_and_outside_an_article():
    page = f"""<html><head><title>t</title><style>a</style></head><body><header><p>{PROSE}</p></header><nav><a href=x>Home</a></nav><div class="cookie-notice">{PROSE}</div>
    <article><h1>Title &amp; more</h1><p>One&nbsp;short   line.</p><div class="ad">{PROSE}</div><script>var x = "<p>no</p>";</script><p>{PROSE}<br>next</p><form><p>{PROSE}</p></form><section id="comments"><p>{PROSE}</p></section></article>
    <aside><p>{PROSE}</p></aside><!-- <p>{PROSE}</p> --><footer>&copy; {PROSE}</footer></body></html>"""
    assert main_text(page) == f"Title & more\n\nOne short line.\n\n{PROSE} next"


def test_pages_without_an_article():
    links = '<li><a href="a">Home page</a></li><li><a href="b">About the people</a></li>'
    page = f"<body><ul>{links}</ul><div><p>{PROSE} {PROSE}</p><p>A short one.</p><p>{PROSE} {PROSE}</p></div><p>Privacy</p><p><a href=x>All rights of the owner and the terms of use of this site</a></p></body>"
    assert main_text(page) == f"{PROSE} {PROSE}\n\nA short one.\n\n{PROSE} {PROSE}"


def test_short_blocks_take_the_nearest_label():
    assert second_pass(["good", "short", "short", "short", "bad"]) == [True, True, False, False, False]
    assert second_pass(["short", "near", "bad"]) == [False, False, False] and second_pass(["near", "good", "short", "good"]) == [True] * 4


def plain_second(labels, ends):
    """The second pass by looking for the nearest decided block on either side."""
    out = []
    for i, label in enumerate(labels):
        if label in ("good", "bad"):
            out.append(label == "good")
            continue
        left = next(((i - j, labels[j] == "good") for j in range(i - 1, -1, -1) if labels[j] in ("good", "bad")), (i + 1, ends))
        right = next(((j - i, labels[j] == "good") for j in range(i + 1, len(labels)) if labels[j] in ("good", "bad")), (len(labels) - i, ends))
        if left[1] == right[1]:
            out.append(left[1])
        elif label == "near":
            out.append(True)
        else:
            out.append(ends if left[0] == right[0] else min(left, right)[1])
    return out


def plain_first(text, linked, other=False):
    """other: stop words tell nothing, as in a page that holds hardly any."""
    words = re.findall(r"\w+", text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if linked / len(text) > 0.4 or re.match(r"©|\(c\)\s|copyright\b|all rights reserved", text, re.I):
        return "bad"
    if len(text) < 70:
        return "bad" if linked else "short"
    if other:
        return "near" if len(text) <= 200 else "good"
    return "bad" if stops < 0.15 else "near" if stops < 0.25 or len(text) <= 200 else "good"


def test_the_two_passes_equal_plain_ones():
    chance = random.Random(4)
    words = ["the", "of", "and", "house", "sea", "old", "tale", "people", "zebra", "quartz", "ink"]
    others = 0
    for number in range(300):
        blocks_of = []
        for _ in range(chance.randint(1, 12)):
            pool = chance.choice([words, words[3:], words[:5]])
            parts = [" ".join(chance.choice(pool) for _ in range(chance.choice([1, 3, 20, 60]))) for _ in range(2)]
            link = chance.random() < 0.3
            blocks_of.append((f"{parts[0]} {parts[1]}", len(parts[0]) if link else 0, f"<p>{f'<a href=x>{parts[0]}</a>' if link else parts[0]} {parts[1]}</p>"))
        body, labels = "".join(b[2] for b in blocks_of), [plain_first(t, n) for t, n, _ in blocks_of]
        every = re.findall(r"\w+", " ".join(b[0] for b in blocks_of).lower())
        if len(every) >= 5 and sum(w in STOP_WORDS for w in every) < 0.04 * len(every):
            others += 1
            plain = [plain_first(t, n, True) for t, n, _ in blocks_of]
        else:
            plain = labels
        kept = plain_second(["good" if x == "near" and "good" not in plain else x for x in plain], False)
        assert main_text(f"<body>{body}</body>") == "\n\n".join(b[0] for b, k in zip(blocks_of, kept) if k)
        link_blocks = [b[1] > 0.4 * len(b[0]) for b in blocks_of]
        listed = [link and True in link_blocks[i + 1 : i + 2] + link_blocks[max(i, 1) - 1 : i] for i, link in enumerate(link_blocks)]
        inner = ["short" if x == "bad" and not in_list else x for x, in_list in zip(labels, listed)]
        kept = plain_second(inner, True)
        assert main_text(f"<body><p>{PROSE}</p><main>{body}</main></body>") == "\n\n".join(b[0] for b, k in zip(blocks_of, kept) if k)
    assert others > 10


def test_time_is_in_proportion():
    def seconds(page):
        began = time.process_time()
        main_text(page)
        return time.process_time() - began

    for make in (lambda n: "<div>" * n + "x</p>" * n, lambda n: "<button>" * n + "x", lambda n: "<" + "a" * 5 * n, lambda n: '<a "' * n, lambda n: "<!--" * n):
        assert seconds(make(60_000)) < 3


def test_defined_results(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p></p><div>"), (4, "u", "<p>" + "x" * 100_000), (4, "u", "plain text without any tag & more"), (5, "u", "<scr<p>a"), (6, "u", "<script>never closed")]
    got = [(r.page_id, r.url, r.text) for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert (1, "u", "") in got and (2, None, "") in got and (3, "u", "") in got and (6, "u", "") in got and len(got) == 7
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    assert blocks("<div>a<div>b</div>c</div>")[1][0] == "b"


def test_marks_of_containers():
    def kept(attributes, tag="div"):
        return main_text(f"<html class='nav-fixed'><body class='has-sidebar'><article><p>{PROSE}</p><{tag} {attributes}><p>{PROSE} inner</p></{tag}></article></body></html>") != PROSE

    for attributes in ('class="ad-slot"', "id=comments", 'class="box user-comment"', 'role="alert"', 'class="site-notice top"', 'class="adsbygoogle"', 'style="display: none"', "hidden"):
        assert not kept(attributes), attributes
    for attributes in ('class="content-with-sidebar"', 'class="lead"', 'class="navy"', 'id="adam"', "data-x=1"):
        assert kept(attributes), attributes
    assert not kept('class="comment"', "article") and not kept("", "aside") and kept("", "section")


ARTICLE = "<p>The house of the old man and the sea is a tale of the town and of the people who lived there for all of the years.</p>"
RUSSIAN = "Это длинный абзац статьи о том, как жил старик у самого синего моря, и как он ловил неводом рыбу, а старуха пряла свою пряжу, и жили они ровно тридцать лет и три года, пока не пришла беда."
JAPANESE = "これは日本語の長い文章です。記事の本文には多くの文字があり、句読点で区切られていますが、単語の間に空白はありません。" * 2


@pytest.mark.parametrize("text", [RUSSIAN, JAPANESE])
def test_pages_in_other_languages(text):
    page = f'<body><nav><a href="/">x</a></nav><h1>{text[:11]}</h1><p>{text}</p><p>{text}</p><div class="menu"><a href="/a">{text[:10]}</a></div><footer>{text}</footer></body>'
    assert main_text(page) == "\n\n".join([text[:11], text, text])


@pytest.mark.parametrize("mark", ['class="post post-alerts"', 'id="search-results-study"', 'class="news-comments-digest"', 'role="article" class="related-work"'])
def test_a_word_in_the_name_of_an_article_is_no_veto(mark):
    assert main_text(f"<article {mark}>{ARTICLE}</article>") == ARTICLE[3:-4]


@pytest.mark.parametrize("mark", ['class="comment"', 'class="post comment-12"', 'class="teaser sidebar"', 'id="related"'])
def test_articles_that_are_comments_or_sidebars(mark):
    assert main_text(f"<article>{ARTICLE}</article><article {mark}>{ARTICLE}</article>") == ARTICLE[3:-4]


def test_a_linked_paragraph_of_an_article_stays_and_a_list_of_links_goes():
    one = '<p><a href="x">The whole of the report</a></p>'
    assert main_text(f"<article>{ARTICLE}{one}{ARTICLE}</article>").split("\n\n")[1] == "The whole of the report"
    assert main_text(f"<article>{ARTICLE}<ul><li><a href='x'>one of them</a></li><li><a href='y'>two of them</a></li></ul></article>") == ARTICLE[3:-4]
