"""Main texts of web pages by consensus host paths.

1. Every page's containers are scored: a block of running text (its length without link text) counts
   in full for its parent, by half for the next container up, and so on. The best container, widened
   while that adds little, is the page's proposal.
2. The proposal's path of tags and classes, digits generalised, is the page's vote; votes are counted
   per host in Spark, and the paths with a twentieth of a host's votes or more stay, by rank.
3. Every page is read again with its host's paths: the first path found in the page gives the main text,
   so an odd page (a short article under a long notice) follows its host. A page without any of the
   paths keeps its own proposal.

Boilerplate inside the container (menus, footers, asides, forms, adverts, notices, comments, …; by tag,
role, class or id) never counts. A class or id does not make an element boilerplate where it only says what a
layout has (has-sidebar, post-with-comments), or where the element holds the page's article or main. The html is not shuffled unless the table of winning paths outgrows
what the planner sends to every task.

Defined results: null or empty html, and pages without text, give an empty text; a null or hostless url
takes no part in the consensus; repeated rows are extracted alike; unclosed and crossed tags are
closed where a browser would close paragraphs, list items and cells; a tag whose quotes do not close ends at the
next bracket, and what no bracket follows is text; extra columns are dropped. Time and memory grow in
proportion to the html, however its tags nest and whatever its quotes.
"""

from __future__ import annotations

import html
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import small_batches, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_VOTE_SHARE = 0.05
WIDEN = 1.25

MARKUP = re.compile(r"<(?:[!?]|(/?)([a-zA-Z][^\s/>]*)|/)")
#: The end of a tag, or a quoted value, in which the end may stand.
TAG_END = re.compile(r">|=[ \t\n\r\f]*([\"'])")
ATTRIBUTE = re.compile(r"([^\s=\"'/<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content that is not text of the page.
RAW = frozenset("script style title textarea noscript template iframe svg canvas object select annotation annotation-xml".split())
CONTAINER = frozenset("article main section div td body blockquote center details".split())
#: An open element that the start of another one ends, and what it may not reach beyond.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILER_TAGS = frozenset("nav footer aside button menu head".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog menu menubar".split())
#: Parts that some sites wrap the whole page in; like names, they go unless they hold the page's content.
FORM_TAGS = frozenset("form dialog label".split())
FORM_ROLES = frozenset("form dialog".split())
BOILER_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidenav rail widget widgets ad ads adv advert "
    "adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices notification alert popup popover modal overlay newsletter subscribe subscription signup share sharing "
    "social related recommended recommendations comment comments commentlist respond replies disqus discussion footer "
    "masthead pagination pager toolbar login signin searchform searchbox copyright disclaimer skip banner teaser".split()
)
#: What follows these in a class or id is not what the element is.
MODIFIERS = frozenset("has have with without no".split())
WRAPPERS = frozenset("wrap wrapper container inner outer".split())
#: Share of the page's running text that, with its first heading, is the page's content whatever its name.
DOMINANT = 0.9
#: A header that belongs to an article, rather than to the site.
OWN_HEADER = frozenset("article entry post story content title".split())


@dataclass
class Element:
    tag: str
    parent: int
    step: str  # of the path of tags and classes; an element holds no more of it, as pages may nest deeply
    path_crc: int = 0
    boiler: bool = False
    header: bool = False
    own: bool = False  # inside an article or main
    link: bool = False
    score: float = 0.0
    named: bool = False  # boilerplate by its own class or id, or a form
    form: bool = False  # a form, dialog or label without such a name
    hard: bool = False  # boilerplate whatever the names
    article: bool = False  # an article or main without such a name
    size: int = 0  # characters of text outside boilerplate


@dataclass
class Page:
    elements: list[Element]
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # element, text, characters in links

    def path(self, index: int) -> str:
        steps = []
        while index >= 0:
            steps.append(self.elements[index].step)
            index = self.elements[index].parent
        return "".join(reversed(steps))


def _labels(attributes: str) -> tuple[dict[str, str], set[str]]:
    values = {}
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), a or b or c)
    names: set[str] = set()
    for name in f"{values.get('class', '')} {values.get('id', '')}".split():
        words = [word.lower() for word in WORD.findall(name)]
        words = words[: next((i for i, word in enumerate(words) if word in MODIFIERS), len(words))]
        if words and (words[-1] == "layout" or words[-1] in WRAPPERS and not OWN_HEADER.isdisjoint(words)):
            words = [word for word in words if word not in BOILER_NAMES]
        names.update(words)
    return values, names


def _element(tag: str, attributes: str, above: Element, parent: int, wrapper: bool = False) -> Element:
    values, names = _labels(attributes) if attributes.strip() else ({}, set())
    classes = sorted(re.sub(r"[0-9]+", "#", c) for c in values.get("class", "").split())
    step = "" if tag in ("html", "body") else "/" + ".".join([tag, *classes])
    own = above.own or tag in ("article", "main")
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
    ours = tag in ("article", "main")
    labelled = bool(names & BOILER_NAMES) and tag not in ("html", "body") and not ours
    header = above.header or ((tag == "header" or "header" in names) and tag not in HEADINGS)
    form = tag in FORM_TAGS or values.get("role", "") in FORM_ROLES
    always = (
        hidden or tag in BOILER_TAGS or values.get("role", "") in BOILER_ROLES
        or (header and not above.header and not own and not names & OWN_HEADER)
    )
    return Element(
        tag, parent, step, zlib.crc32(step.encode(), above.path_crc), above.boiler or always or ((labelled or form) and not wrapper), header, own,
        above.link or tag == "a", named=labelled or form, form=form and not labelled, hard=above.hard or always, article=ours and not names & BOILER_NAMES,
    )


def parse(source: str) -> Page:
    """Elements and text blocks of a page. Inside an article's header only headings are text."""
    page = _parse(source, frozenset())
    wrappers = _wrappers(page)
    return _parse(source, wrappers) if wrappers else page


def _wrappers(page: Page) -> frozenset[int]:
    """The elements named like boilerplate that hold the page's content: articles or mains with more running text
    than there is outside, or nearly all running text and the first heading. A form may have paragraphs with most
    of the page's running text instead of the heading."""
    elements = page.elements
    if not any(e.named and not e.hard for e in elements):
        return frozenset()
    text, articles, heading = [0] * len(elements), [0] * len(elements), [e.tag == "h1" for e in elements]
    prose = [0] * len(elements)
    for index, words, linked in page.blocks:
        if not elements[index].hard:
            text[index] += max(0, len(words) - 2 * linked)
            if elements[index].tag == "p":
                prose[index] = text[index]
    for i in range(len(elements) - 1, 0, -1):
        above = elements[i].parent
        text[above] += text[i]
        prose[above] += prose[i]
        articles[above] += text[i] if elements[i].article else articles[i]
        heading[above] |= heading[i]
    return frozenset(
        i for i, e in enumerate(elements)
        if e.named and not e.hard and text[i]
        and (
            articles[i] > text[0] - text[i]
            or (text[i] >= DOMINANT * text[0] and (heading[i] or (e.form and 2 * prose[i] > text[0])))
        )
    )


def _tag_end(source: str, at: int, dead: set[int]) -> int:
    """Where the tag with the attributes from ``at`` on ends, -1 if nowhere. Where quotes are not closed, it ends at
    the next bracket; ``dead`` has the quotes from which no end was found, so none is followed twice."""
    begin, opened = at, []
    while found := TAG_END.search(source, at):
        if not found.group(1):
            return found.start()
        quote = found.end() - 1
        if quote in dead:
            break
        opened.append(quote)
        at = source.find(found.group(1), quote + 1) + 1
        if not at:
            break
    dead.update(opened)
    return source.find(">", begin)


def _parse(source: str, wrappers: frozenset[int]) -> Page:
    page = Page([Element("", -1, "")])
    elements, stack = page.elements, [0]
    pieces: list[str] = []
    start, linked, at, n = 0, 0, 0, len(source)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                page.blocks.append((start, text, linked))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal start, linked
        text = html.unescape(raw) if "&" in raw else raw
        if not pieces:
            start = next(i for i in reversed(stack) if i == 0 or elements[i].tag in BLOCK)
        top = elements[stack[-1]]
        if top.boiler and not elements[start].boiler:
            return  # an inline advert or a label
        pieces.append(text)
        if top.link:
            linked += len(text.strip())

    def close(index: int) -> None:
        if any(elements[i].tag in BLOCK for i in stack[index:]):
            flush()
        del stack[index:]

    dead: set[int] = set()
    text_from = 0
    while True:
        found = MARKUP.search(source, at)
        if not found:
            break
        tag = (found.group(2) or "").lower()
        if source.startswith("<!--", found.start()):
            end = source.find("-->", found.start() + 4)
            end = end + 2 if end >= 0 else n - 1
        else:
            end = _tag_end(source, found.end(), dead) if tag else source.find(">", found.end())
            if end < 0:
                break  # no bracket follows, so no tag either
        if found.start() > text_from:
            add(source[text_from : found.start()])
        at = text_from = end + 1
        if not tag:
            continue
        if found.group(1):
            for index in range(len(stack) - 1, 0, -1):
                open_tag = elements[stack[index]].tag
                if open_tag == tag:
                    close(index)
                    break
                if tag not in BLOCK and open_tag in BLOCK:
                    break
            continue
        attributes = source[found.end() : end]
        if tag in RAW and not attributes.rstrip().endswith("/"):
            closing = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(source, at)
            at = source.find(">", closing.end() - 1) + 1 if closing else n
            at = text_from = at or n
            continue
        if tag == "br":
            if pieces:
                pieces.append(" ")
            continue
        if tag in BLOCK:
            flush()
            ends, limit = ENDS.get(tag, (set(), set()))
            for index in range(len(stack) - 1, 0, -1):
                open_tag = elements[stack[index]].tag
                if open_tag in ends or open_tag == "p" or (tag in HEADINGS and open_tag in HEADINGS):
                    del stack[index:]
                    if not ends or open_tag != "p":
                        break
                elif open_tag in limit or (open_tag in BLOCK and not ends):
                    break
        if tag in VOID:
            continue
        if tag in ("html", "body") and any(elements[i].tag == tag for i in stack):
            continue
        if tag == "body":
            del stack[1 + any(elements[i].tag == "html" for i in stack[:2]) :]
        elements.append(_element(tag, attributes, elements[stack[-1]], stack[-1], len(elements) in wrappers))
        if attributes.rstrip().endswith("/") and tag not in BLOCK:
            elements.pop()
            continue
        stack.append(len(elements) - 1)
    if text_from < n:
        add(source[text_from:])
    flush()
    return page


def _is_text(page: Page, index: int) -> bool:
    element = page.elements[index]
    return not element.boiler and (not element.header or element.tag in HEADINGS)


def propose(page: Page) -> int:
    """The element that scores best, 0 (the page) if nothing does."""
    elements = page.elements
    plain = [0.0] * len(elements)
    for index, text, linked in page.blocks:
        if _is_text(page, index):
            plain[index] += max(0, len(text) - 2 * linked)
            elements[index].size += len(text)
    for i in range(len(elements) - 1, -1, -1):
        element = elements[i]
        if element.tag in CONTAINER:
            element.score = plain[i]
            plain[i] /= 2
        if i:
            plain[element.parent] += plain[i]
            elements[element.parent].size += element.size
    best = max(range(len(elements)), key=lambda i: (elements[i].score, -i))
    if elements[best].score <= 0:
        return 0
    outer, at = best, best
    while at > 0:
        if elements[at].tag == "article":
            outer = at
        at = elements[at].parent
    if elements[outer].tag == "article":
        return outer
    while True:
        above = elements[best].parent
        if above <= 0 or elements[above].tag in ("body", "html") or elements[above].size > WIDEN * elements[best].size:
            return best
        best = above


def text_in(page: Page, chosen: set[int]) -> str:
    """The blocks under the chosen elements, in page order."""
    inside = [False] * len(page.elements)
    for i, element in enumerate(page.elements):
        inside[i] = i in chosen or (element.parent >= 0 and inside[element.parent])
    return "\n".join(text for index, text, _ in page.blocks if inside[index] and _is_text(page, index))


def main_text(source: str | None, paths: list[str] | None) -> str:
    if not source:
        return ""
    page = parse(source)
    for path in paths or []:
        crc = zlib.crc32(path.encode())
        chosen = {i for i, e in enumerate(page.elements) if i and e.path_crc == crc and not e.boiler and page.path(i) == path}
        if chosen and (text := text_in(page, chosen)):
            return text
    return text_in(page, {propose(page)})


def host_of(url: Column) -> Column:
    """Lower-case host of an address, null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(F.length(host) > 0, host)


def host_paths(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """(host, paths): the paths most voted for on each host, best first; at most 1 / MIN_VOTE_SHARE."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = []
            for value in batch.column(1):
                page = parse(value.as_py() or "")
                chosen = propose(page)
                votes.append(page.path(chosen) if chosen else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.string())], names=["host", "path"])

    cast = pages.select(host_of(F.col(url)).alias("host"), F.col(source)).where("host IS NOT NULL")
    votes = cast.mapInArrow(vote, "host string, path string").where("path <> ''")
    counts = stored(votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes")), "votes")
    total = counts.groupBy("host").agg(F.sum("votes").alias("total"))
    won = counts.join(total, "host").where(F.col("votes") >= MIN_VOTE_SHARE * F.col("total"))
    ranked = won.groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("rank"), "path"))).alias("won"))
    return ranked.select("host", F.transform("won", lambda w: w["path"]).alias("paths"))


def extract(pages: DataFrame, url: str = "url", source: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns with the main text of each page and its length in code points."""
    winners = stored(host_paths(small_batches(pages), url, source), "host_paths")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(1).to_pylist()
            texts = [main_text(value.as_py(), p) for value, p in zip(batch.column(0), paths, strict=True)]
            columns = [*batch.columns[2:], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[2:], "text"])

    chosen = pages.select(F.col(source).alias("source"), host_of(F.col(url)).alias("host"), F.struct(*keep).alias("row"))
    met = chosen.join(winners, "host", "left").select("source", "paths", "row.*")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields)
    return met.mapInArrow(read, f"{shape}, text string").withColumn("n_chars", F.length("text").cast("bigint"))
