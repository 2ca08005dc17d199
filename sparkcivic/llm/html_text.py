"""Main text of web pages from streaming parser events and text density.

One pass of the standard library's parser over a page gives its lines: the
stretches of text between block-level tags, each with the number of tags met
in it and the containers around it. Scripts, styles and the like hold no text.
Blocks that are marked as no content by their tag, role or style (menus, forms,
hidden parts), or named as adverts, notices, sidebars, comments and so on, are
judged by the text that they hold (see ``_kept``), as the form, wrapper or
layout around a whole page may be marked so too. The text-to-tag
ratio of the other lines is smoothed with a Gaussian over neighbouring lines, and lines above a
threshold are clustered into runs. The runs then select the content region:
the article elements, else the main element, if they hold most of the runs'
text, else the innermost container that is named as content and holds half of
it, else the smallest container that holds most of it. Articles that are no
more than teasers beside the text are no part of it, nor is a section that a
heading calls comments, if it is shorter than the text before. The region's
lines are returned whole, so a short paragraph inside the article is not lost
to its low ratio.

Each page is treated on its own in Arrow batches; nothing is shuffled.

Defined results
  * NULL or empty HTML, and pages without text: an empty string.
  * Character references are decoded, white space inside a line becomes one
    space, lines are joined by an empty line. Unclosed and misnested tags are
    taken as they come; broken markup never stops a page.
  * A comment that is not closed hides the rest of the page, as in browsers.
  * Time is linear in the page, however deep its markup: elements know what is
    above them, and text is summed from the innermost outwards.
  * Every row gives one row, repeated rows and NULL ids included; an empty
    table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup
option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("""script style noscript template title head svg math iframe object canvas audio video map select
option textarea button datalist""".split())
NO_CONTENT = frozenset("nav footer aside form menu dialog fieldset".split())
CLOSED_BY_BLOCK = frozenset(["p"])
ROLES = frozenset("""navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog
toolbar status tooltip tablist""".split())
ASIDES = frozenset("nav footer aside menu navigation contentinfo complementary search menubar toolbar tooltip tablist".split())
# Words in class and id names by which a block may be no part of the article.
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored sponsors promo
promotion promoted banner banners cookie cookies consent gdpr notice notices alert popup modal overlay lightbox toast
newsletter subscribe subscription signup nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars
sidenav rail aside footer footnav masthead topbar toolbar comment comments commentlist reply replies respond discussion
disqus share sharing social related recommended recommendations trending pagination pager widget widgets login search
searchbox disclaimer copyright skip hidden visuallyhidden""".split())
PAGE_NAMES = frozenset("header".split())  # outside the article only
COMMENTS = frozenset("comment comments commentlist reply replies respond discussion disqus".split())
CONTENT_NAMES = frozenset("content article post entry story main maincontent".split())
ARTICLE, MAIN = "article", "main"
SIGMA, THRESHOLD = 1.0, 0.5  # smoothing in lines; share of the mean ratio
HOLDS, NAMED_HOLDS = 0.6, 0.5  # share of the text that the region must hold; that a named one must hold
SMALL, BODY_LINES = 0.2, 2  # share of the text that is no more than small; lines of a cluster that make a body of text
SPACE = re.compile(r"\s+")
TEASER = 0.3  # of the largest article's text: another article that holds less is a teaser
COMMENTS_HEADING = re.compile(r"(\d+ )?(reader |user )?(comments?|responses?|replies|kommentare?|commentaires?|comentarios?|commenti)( ?\(?\d+\)?)?:?", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 legend caption".split())
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


class _Element:
    __slots__ = ("tag", "parent", "depth", "silent", "kind", "named", "comments", "marked", "role", "doubt", "said", "inside", "under", "scope", "open")

    def __init__(self, tag, parent, silent, kind, named=False, doubted=False, comments=False, marked=False, role=""):
        self.tag, self.parent, self.silent, self.kind, self.named = tag, parent, silent, kind, named
        self.comments, self.marked, self.role = comments, marked, role
        self.doubt = self if doubted or marked else parent.doubt if parent else None  # the innermost block that may be no content
        self.said = bool(kind or named or parent and parent.said)  # marked as content
        self.inside = bool(kind or parent and parent.inside)
        self.under = parent.under | ({parent.kind} if parent.kind else set()) if parent else frozenset()  # kinds further out
        self.depth = parent.depth + 1 if parent else 0
        block = parent is None or tag in BLOCKS and tag != "p"
        self.scope = self if block else parent.scope  # an inline end tag closes nothing beyond it
        self.open = {} if block else None  # open inline elements, by tag


class Lines(HTMLParser):
    """Collects ``(text, tags, link_chars, element)`` lines, and the elements in
    the order of their start tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.at = _Element("", None, False, "")
        self.elements = [self.at]
        self.lines: list[tuple[str, int, int, _Element]] = []
        self.text: list[str] = []
        self.tags = self.links = 0
        self.in_link = 0
        self.open: dict[str, int] = {}

    def enter(self, e: _Element) -> None:
        self.at = e
        self.elements.append(e)
        opened = self.open if e.scope is e else e.scope.open
        opened[e.tag] = opened.get(e.tag, 0) + 1

    def leave(self) -> None:
        e = self.at
        (self.open if e.scope is e else e.scope.open)[e.tag] -= 1
        self.at = e.parent

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append((text, self.tags, self.links, self.at))
        self.text, self.tags, self.links = [], 0, 0

    def _names(self, attrs: dict) -> set[str]:
        said = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        return {x.lower() for x in NAME_PARTS.findall(said)} if said != " " else set()

    def handle_starttag(self, tag, attrs):
        if self.at.silent and tag not in ("body",):  # an unclosed head ends where the body begins
            if tag not in VOID:
                self.enter(_Element(tag, self.at, True, ""))
            return
        if tag in BLOCKS:
            self.flush()
            if self.at.tag in CLOSED_BY_BLOCK:
                self.leave()
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and self.at.tag == tag:
                self.leave()
            if tag == "body":
                while self.at.silent:
                    self.leave()
        else:
            self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag == "a":
            self.in_link = 1
        if tag in VOID:
            return
        a, up = dict(attrs), self.at
        if tag in ("html", "body"):  # whatever they say, they are the page
            self.enter(_Element(tag, up, False, ""))
            return
        names, role = self._names(a), (a.get("role") or "").lower()
        kind = ARTICLE if tag == ARTICLE or "articlebody" in (a.get("itemprop") or "").lower() else MAIN if tag == MAIN or role == MAIN else ""
        style = (a.get("style") or "").replace(" ", "").lower()
        marked = (tag in NO_CONTENT or role in ROLES or "hidden" in a
                  or (a.get("aria-hidden") or "").lower() == "true" or "display:none" in style or "visibility:hidden" in style)
        block = tag in BLOCKS
        doubted = block and bool(names & NAMES)
        if not marked and not up.inside:
            marked = tag == "header"
            doubted = doubted or block and not kind and bool(names & PAGE_NAMES)
        self.enter(_Element(tag, up, tag in NO_TEXT, kind, block and bool(names & CONTENT_NAMES),
                            doubted, doubted and bool(names & COMMENTS), marked, role))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS and not self.at.silent:
            self.flush()
        elif not self.at.silent:
            self.tags += 1
        if tag == "a":
            self.in_link = 0
        opened = self.open if tag in BLOCKS and tag != "p" else self.at.scope.open
        while opened.get(tag):  # what is open inside of it is closed with it
            e = self.at
            self.leave()
            if e.tag == tag:
                return

    def handle_data(self, data):
        if not self.at.silent:
            self.text.append(data)
            if self.in_link:
                self.links += len(data)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(ratios, reach)
    weight = np.convolve(np.pad(np.ones_like(ratios), reach), k, mode="valid")
    return np.convolve(padded, k, mode="valid") / weight


def _closed(html: str) -> str:
    """The page up to a comment that nothing closes."""
    at = html.find("<!--", html.rfind("-->") + 1)
    while at >= 0:
        opened = max((html.rfind(f"<{t}", 0, at), t) for t in ("script", "style"))
        if html.rfind(f"</{opened[1]}", 0, at) >= opened[0] or opened[0] < 0:
            return html[:at]
        end = html.find(f"</{opened[1]}", at)  # a comment sign inside a script
        at = html.find("<!--", end) if end >= 0 else -1
    return html


def extract(html: str | None) -> str:
    if not html:
        return ""
    html = _closed(html)
    cut = html.rfind("<")
    if cut >= 0 and ">" not in html[cut:] and re.match(r"</?[A-Za-z]", html[cut:cut + 3]):
        html = html[:cut]  # a tag that the page's end cuts off
    p = Lines()
    p.feed(html)
    p.close()
    p.flush()
    lines, elements = p.lines, p.elements
    if not lines:
        return ""
    weight = _weights(lines)
    if any(e.doubt for *_, e in lines):
        kept = _kept(lines, weight, elements)
        lines = [line for line in lines if line[3].doubt is None or line[3].doubt in kept]
        if not lines:
            return ""
        weight = _weights(lines)
    held, total = _held(lines, weight, elements), weight.sum()
    teasers: set[_Element] = set()
    for kind in (ARTICLE, MAIN):  # outermost elements of the kind; together they may be the region
        tops = {e for e in held if e.kind == kind and kind not in e.under}
        large = {e for e in tops if held[e] >= TEASER * max(map(held.get, tops))}
        beside = sum(held[e] for e in tops - large)
        if large and sum(held[e] for e in large) >= HOLDS * (total - beside):
            return _text(lines, large, elements, teasers)
        if kind == ARTICLE:
            teasers = {e for e in tops if held[e] <= SMALL * total}
    holders = [e for e in held if e.tag not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6") and (e.tag in BLOCKS or e.parent is None)]
    region = max((e for e in holders if e.named and e.tag != "body" and held[e] >= NAMED_HOLDS * total), key=lambda e: e.depth, default=None)
    region = region or max((e for e in holders if held[e] >= HOLDS * total), key=lambda e: e.depth)
    return _text([line for line in lines if not _menu(line)], {region}, elements, teasers - {region})


def _weights(lines: list) -> np.ndarray:
    """Text of the lines that are in a cluster of content lines, 0 for others."""
    size = np.array([len(t) for t, *_ in lines], dtype=float)
    ratio = np.array([max(0, len(t) - links) / max(1, tags) for t, tags, links, _ in lines])
    dense = smoothed(ratio)
    return np.where(dense >= THRESHOLD * dense.mean(), size, 0.0)


def _held(lines: list, weight: np.ndarray, elements: list[_Element]) -> dict[_Element, float]:
    held: dict[_Element, float] = {}
    for (_, _, _, e), w in zip(lines, weight.tolist()):
        held[e] = held.get(e, 0.0) + w
    for e in reversed(elements):  # parents come before their children
        if e in held and e.parent is not None:
            held[e.parent] = held.get(e.parent, 0.0) + held[e]
    return held


def _kept(lines: list, weight: np.ndarray, elements: list[_Element]) -> set[_Element]:
    """The blocks named as no content that are content all the same, judged
    from the outermost inwards and by size. They are kept if they are around
    the largest article (main), are a body of more than a small share, or hold
    more than all text outside them while nothing there is marked as content.
    If more than a small share is marked there, they must hold more than all
    text outside, as a body or around the article. Comments must always hold
    more, and go where content is marked. Blocks that are marked as no content,
    and not just named so, are kept if they are around an article (main) that is
    more than a small share of the text; forms, dialogs, headers and hidden
    blocks also if they hold more than all text outside and nothing there is
    marked as content."""
    held, total = _held(lines, weight, elements), weight.sum()
    none: tuple = (0.0, 0.0, 0)
    own: dict[_Element | None, tuple] = {}  # text, text marked as content and its lines, by the innermost such block
    under: dict[_Element, tuple] = {}  # marked text, its lines and all clustered lines, with the blocks inside
    for (_, _, _, e), w in zip(lines, weight.tolist()):
        d = e.doubt
        text, marked, n = own.get(d, none)
        own[d] = text + w, marked + w * e.said, n + e.said
        if d is not None:
            marked, n, body = under.get(d, none)
            under[d] = marked + w * e.said, n + e.said, body + (w > 0)
    for d in reversed(elements):
        if d in under and (up := d.parent.doubt) is not None:
            under[up] = tuple(map(sum, zip(under.get(up, none), under[d])))
    inner: dict[_Element | None, list[_Element]] = {}
    for d in under:
        inner.setdefault(d.parent.doubt, []).append(d)
    around, large = set(), False
    for kind in (ARTICLE, MAIN):
        chief = max((e for e in held if e.kind == kind), key=held.get, default=None)
        if chief is not None:
            d, large = chief.doubt, held[chief] > SMALL * total
            while d is not None:
                around.add(d)
                d = d.parent.doubt
            break
    kept, level, out = set(), inner.get(None, []), own.get(None, none)
    while level:
        found, beside = [], out
        for d in sorted(level, key=lambda d: (d in around, held[d]), reverse=True):
            text, marked, n = beside
            more, body = held[d] > text, under[d][2] >= BODY_LINES
            if d.comments:
                keep = more and marked <= SMALL * total
            elif d.marked:
                keep = d in around and large or d.tag not in ASIDES and d.role not in ASIDES and more and not n
            elif marked > SMALL * total:
                keep = more and (body or d in around)
            else:
                keep = d in around or body and held[d] > SMALL * total or more and not n
            if keep:
                found.append(d)
                beside = text + held[d], marked + under[d][0], n + under[d][1]
        kept.update(found)
        out = tuple(map(sum, zip(out, *(own.get(d, none) for d in found))))
        level = [x for d in found for x in inner.get(d, [])]
    return kept


def _menu(line: tuple) -> bool:
    """Nothing but links."""
    return line[2] >= 0.9 * len(line[0]) and line[3].tag in ("li", "ul", "div", "td", "span", "a")


def _inside(elements: list[_Element], tops: set[_Element]) -> set[_Element]:
    inside: set[_Element] = set()
    for e in elements:
        if e in tops or e.parent in inside:
            inside.add(e)
    return inside


def _text(lines: list, tops: set[_Element], elements: list[_Element], teasers: set[_Element]) -> str:
    inside = _inside(elements, tops)
    if teasers:
        inside -= _inside(elements, teasers - tops)
    return "\n\n".join(line[0] for line in _without_comments([line for line in lines if line[3] in inside], elements))


def _without_comments(lines: list, elements: list[_Element]) -> list:
    """The lines but for the first section that a heading calls comments: the
    heading and what follows it in its container, if that is less than the text
    before."""
    for k, (text, _, _, e) in enumerate(lines):
        while e.parent is not None and e.tag not in BLOCKS:
            e = e.parent
        if e.tag in HEADINGS and COMMENTS_HEADING.fullmatch(text):
            section = _inside(elements, {e.parent})
            gone = {j for j in range(k, len(lines)) if lines[j][3] in section}
            if sum(len(lines[j][0]) for j in gone) < sum(len(line[0]) for line in lines[:k]):
                return [line for j, line in enumerate(lines) if j not in gone]
            return lines
    return lines


@F.pandas_udf(T.StringType())
def _extract(pages: pd.Series) -> pd.Series:
    return pages.map(extract, na_action=None)


def main_text(html: Column) -> Column:
    return _extract(html)
