"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one looks at each block alone: its length, the density of
stop words and the density of linked characters make it good, bad, near-good or short. Pass two gives near-good
and short blocks the label of their nearest decided neighbours. Marked containers (menus, headers, footers,
sidebars, notices, adverts, forms, comments) are a veto: their blocks are bad as a whole. Where a page marks its article, the
blocks outside are bad too, and the two passes decide among the blocks inside: there a lack of stop words or a
notice leaves a block undecided instead of bad (lists, code and other languages belong to articles), and the article's ends count as good;
so does a block that is one link, unless another such block is next to it (a list of links).

Stop words are those of four languages. A page whose blocks outside marked containers hold hardly any of them is in another
language: length and link density alone decide there, and text in scripts without blanks between words counts double.

Defined results: null, empty or markup-only html gives an empty text; unclosed tags end with their container;
repeated rows count each; a null page_id or url stays null; an empty table gives an empty result; other columns of the input are
ignored; pages of any length are handled whole, in time proportional to it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, read

#: Blocks of fewer characters are short, of more are long.
SHORT, LONG = 70, 200
#: Shares of stop words among words, and of linked characters.
STOP_LOW, STOP_HIGH, LINK_HIGH = 0.15, 0.25, 0.4
#: A page of a lower share of stop words in all is in a language of none of ours, if it has so many words.
STOP_NONE, WORDS_TOLD = 0.04, 5

#: Frequent function words of the languages served.
STOP_WORDS = frozenset(
    "the of and to in a is that it for as was with be by on are this from or an at not which have he his they but had were their one all we can her has there been if more when will would who so no"  # noqa: SIM905
    " de la le les et des en un une du que est pour qui dans par sur au pas plus ne se ce il sont avec son aux ou mais comme"
    " der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum"
    " que el los del las por con una su para como más o pero sus al lo ya entre cuando sin sobre este y".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())  # noqa: SIM905
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())  # noqa: SIM905
#: Elements whose content is no text.
SILENT = frozenset("head script style noscript template svg math iframe object canvas audio video select textarea button title option datalist".split())  # noqa: SIM905
#: Elements that hold no main text.
FRAME = frozenset("nav footer aside form header dialog menu fieldset".split())  # noqa: SIM905
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Words of class, id or role that mark a container as no main text.
BAD_WORD = (
    r"(?:ads?|ad(?:box|slot|space|unit|banner|sense|sbygoogle)|advert\w*|sponsor\w*|promo\w*|banner|nav(?:bar|igation|menu|s)?|menu\w*|breadcrumbs?|header|masthead|footer|sidebar|side-bar|sidenav|aside|colophon|widget\w*|related|recommend\w*|share|sharing|social"
    r"|cookies?|consent|gdpr|notices?|announcements?|alerts?|warning|toast|flash|paywall|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|comments?|comment-\w+|disqus|replies|reply|respond|responses|feedback|discussion|pagination|pager|toolbar|copyright|legal|disclaimer|skip|complementary|contentinfo|navigation|search)"
)
BAD_NAME = re.compile(rf"(?:^|[\s_-])(?<!with[_-])(?<!has[_-])(?<!no[_-])(?<!and[_-]){BAD_WORD}(?=$|[\s_-])", re.IGNORECASE)
#: An article is no main text only if one of its names is such a word as a whole: a post about alerts is a post.
BAD_ARTICLE = re.compile(rf"(?:^|\s){BAD_WORD}(?=$|\s)", re.IGNORECASE)
TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<!--|<[!?]")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
CLOSING = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in SILENT}
HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
GAP = re.compile(r"\s+")
WORD = re.compile(r"\w+")
#: Letters of scripts without blanks between words.
DENSE = re.compile(r"[\u0e00-\u0eff\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
NOTICE = re.compile(r"^(?:©|\(c\)\s|copyright\b|all rights reserved)", re.IGNORECASE)


class Block:
    __slots__ = ("bad", "heading", "inside", "linked", "parts")

    def __init__(self, bad: bool, inside: bool, heading: bool):
        self.parts: list[str] = []
        self.linked, self.bad, self.inside, self.heading = 0, bad, inside, heading


def blocks(html: str) -> list[tuple[str, int, bool, bool, bool]]:
    """(text, linked characters, in a bad container, in a marked article, heading) of each block with text."""
    out: list[tuple[str, int, bool, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # open block elements: name, bad, article
    open_names: Counter[str] = Counter()
    unclosed: set[str] = set()  # silent elements that no later tag closes
    bad = inside = 0
    links = 0
    block = Block(False, False, False)
    position, n = 0, len(html)

    def close() -> None:
        nonlocal block
        if block.parts:
            text = GAP.sub(" ", "".join(block.parts)).strip()
            if text:
                out.append((text, block.linked, block.bad, block.inside, block.heading))
        block = Block(bad > 0, inside > 0, any(x[0] in HEADINGS for x in stack[-2:]))

    def leave() -> str:
        nonlocal bad, inside
        name, was_bad, was_main = stack.pop()
        open_names[name] -= 1
        bad, inside = bad - was_bad, inside - was_main
        return name

    def add(raw: str) -> None:
        if raw:
            text = entities.unescape(raw)
            block.parts.append(text)
            if links:
                block.linked += len(text.strip())

    while position < n:
        found = TAG.search(html, position)
        if not found:
            add(html[position:])
            break
        add(html[position : found.start()])
        position = found.end()
        if not found[2]:
            end = html.find("-->" if found[0] == "<!--" else ">", position)
            position = n if end < 0 else end + (3 if found[0] == "<!--" else 1)
            continue
        name, closing = found[2].lower(), bool(found[1])
        if name in SILENT and not closing:
            end = None if name in unclosed else CLOSING[name].search(html, position)
            if end:
                position = end.end()
                continue
            unclosed.add(name)
            if name in ("script", "style", "textarea", "title", "iframe"):
                position = n
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if name == "br":
            block.parts.append(" ")
            continue
        if name in INLINE:
            names = None if closing else NAMED.search(found[3])
            if not (names and BAD_NAME.search(names[1] or names[2] or names[3] or "")) and not any(x[0] == name and x[1] for x in stack[-3:]):
                continue
        links = 0
        if closing:
            if open_names[name]:
                while leave() != name:
                    pass
            close()
            continue
        if name == "p" or name in ("li", "dt", "dd", "tr", "td", "th"):  # these end their open sibling
            if stack and stack[-1][0] == name:
                leave()
        if name not in VOID and not found[0].endswith("/>"):
            words = " ".join(m[1] or m[2] or m[3] or "" for m in NAMED.finditer(found[3]))
            named = bool(words and name not in ("html", "body", "main") and (BAD_ARTICLE if name == "article" else BAD_NAME).search(words))
            is_main = name in MAIN and not named and not bad  # a comment or a teaser may be marked as an article too
            marked = name in FRAME and not (name == "header" and inside) or named or bool(found[3] and HIDDEN.search(found[3]))
            stack.append((name, marked, is_main))
            open_names[name] += 1
            bad, inside = bad + marked, inside + is_main
        close()
    close()
    return out


def first_pass(text: str, linked: int) -> str:
    """good, bad, near or short, of a block alone."""
    n = len(text)
    if linked > LINK_HIGH * n or NOTICE.match(text):
        return "bad"
    if n < SHORT:
        return "bad" if linked else "short"
    words = WORD.findall(text.lower())
    density = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if density >= STOP_HIGH:
        return "good" if n > LONG else "near"
    return "near" if density >= STOP_LOW else "bad"


def length_alone(text: str, linked: int) -> str:
    """good, bad, near or short, of a block in a language without known stop words."""
    n = len(text) + len(DENSE.findall(text))
    if linked > LINK_HIGH * len(text) or NOTICE.match(text):
        return "bad"
    if n < SHORT:
        return "bad" if linked else "short"
    return "good" if n > LONG else "near"


def other_language(texts: list[str]) -> bool:
    """Whether these texts hold hardly any known stop word."""
    words = [w for text in texts for w in WORD.findall(text.lower())]
    letters = sum(len(DENSE.findall(text)) for text in texts)
    told = len(words) >= WORDS_TOLD or letters >= SHORT // 2
    return told and sum(w in STOP_WORDS for w in words) < STOP_NONE * len(words)


def second_pass(labels: list[str], ends: bool = False) -> list[bool]:
    """Near-good and short blocks take the label of their nearest decided neighbours.

    Between two good neighbours they are good, between two bad ones bad; between unlike ones a near-good block is
    good and a short one follows the nearer, or the ends' label if both are as near. ends: what lies before the first block
    and behind the last counts as good.
    """
    n = len(labels)
    before, after = [(-1, ends)] * n, [(n, ends)] * n
    last = (-1, ends)
    for i in range(n):
        before[i] = last
        if labels[i] in ("good", "bad"):
            last = (i, labels[i] == "good")
    last = (n, ends)
    for i in range(n - 1, -1, -1):
        after[i] = last
        if labels[i] in ("good", "bad"):
            last = (i, labels[i] == "good")
    out = []
    for i, label in enumerate(labels):
        (j, left), (k, right) = before[i], after[i]
        if label in ("good", "bad"):
            out.append(label == "good")
        elif left == right:
            out.append(left)
        elif label == "near":
            out.append(True)
        else:
            out.append((left if i - j < k - i else right) if i - j != k - i else ends)
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    found = blocks(html)
    article = [b for b in found if b[3] and not b[2]]
    if article:
        # The mark of the article and its containers have left these blocks; links and neighbours decide.
        labels = []
        lists = [linked > LINK_HIGH * len(text) for text, linked, _, _, _ in article]
        for i, (text, linked, _, _, _) in enumerate(article):
            label = first_pass(text, linked)
            listed = lists[i] and any(lists[max(0, i - 1) : i] + lists[i + 1 : i + 2])
            labels.append("short" if label == "bad" and not listed else label)
        return "\n\n".join(b[0] for b, keep in zip(article, second_pass(labels, ends=True)) if keep)
    judge = length_alone if other_language([b[0] for b in found if not b[2]]) else first_pass
    labels = []
    for text, linked, bad, _, heading in found:
        label = "bad" if bad else judge(text, linked)
        labels.append("short" if heading and not bad and label == "bad" and linked <= LINK_HIGH * len(text) else label)
    if "good" not in labels and "near" in labels:
        labels = ["good" if x == "near" else x for x in labels]  # a page of short paragraphs
    kept = second_pass(labels)
    for i in range(len(found) - 2, -1, -1):  # an undecided heading belongs to what follows it
        kept[i] = kept[i] or (found[i][4] and labels[i] in ("short", "near") and kept[i + 1])
    return "\n\n".join(b[0] for b, keep in zip(found, kept) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page."""

    def factory():
        def apply(keys, texts):
            rows = list(map(main_text, texts))
            return [pa.array([k["page_id"] for k in keys], pa.int64()), pa.array([k["url"] for k in keys], pa.string()), pa.array(rows, pa.string()), pa.array(map(len, rows), pa.int64())]

        return apply

    keyed = pages.select(F.struct(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).alias("key"), "html")
    return map_texts(keyed, "page_id long, url string, text string, n_chars long", factory, key="key", text="html")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
