"""Main text of web pages: parser events, text-to-tag ratios of lines, Gaussian smoothing, and clusters above a threshold."""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from classweave.llm.frames import free_name, map_batches

#: Lines on either side that smoothing reaches, and its width.
RADIUS, SIGMA = 2, 1.0

_BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_GROUP = set("article main section div td body html".split())
#: Elements that are never part of an article's text.
_APART = set("head title script style noscript template nav header footer aside form button select option textarea label iframe object svg math canvas audio video dialog menu".split())
#: Words in class, id or role that say the same of any element but body and html.
_WORDS = set(
    "ad ads advert adverts advertisement advertising adbox adslot banner banners sponsor sponsored promo promotion promoted "
    "nav navbar navigation menu menus breadcrumb breadcrumbs toolbar pagination pager "
    "header masthead topbar footer foot colophon copyright sidebar side aside rail complementary contentinfo "
    "notice notices notification alert cookie cookies consent gdpr disclaimer popup modal overlay newsletter subscribe subscription signup login "
    "comment comments commentlist disqus respond reply replies discussion "
    "share sharing social related recommended recommendations widget widgets search searchbox skip hidden".split()
)
#: Of these, words that headings, sections and boxes of an article have too: inside one they count only as a whole name.
_AMBIGUOUS = set("discussion related side search searchbox notice notices alert header sharing social share reply replies respond recommended recommendations disclaimer promotion subscription banner".split())
_TEXTUAL = set("h1 h2 h3 h4 h5 h6 p".split())
_ABOUT = {"has", "with", "no", "without", "layout"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_COMMENT = {"comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "discussion"}


def _names(attributes: list[tuple[str, str | None]], inside: str = "") -> set[str]:
    """The words of an element's class, id and role; `hidden` for one that is not shown.

    Inside an article (`inside` is the element's tag) ids of headings and paragraphs, which are made from their text, say
    nothing, and ambiguous words only say something as a whole class or role, or with another such word.
    """
    out: set[str] = set()
    for key, value in attributes:
        value = value or ""
        if key in ("class", "id", "role", "data-role"):
            if key == "id" and inside in _TEXTUAL:
                continue
            for name in value.split():
                parts = [x.lower() for x in re.split(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])", name) if x]
                # A box that says it has a sidebar, or none, is not the sidebar.
                if parts and parts[0] not in _ABOUT and parts[-1] not in _ABOUT:
                    sure = not inside or len(parts) == 1 and key != "id" or len(set(parts) & _WORDS) > 1
                    out.update(x for x in parts if sure or x not in _AMBIGUOUS)
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            out.add("hidden")
    return out


_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())


class _Lines(HTMLParser):
    """Turns parser events into lines: one per block, with its characters, tags, characters in links, and innermost group.

    What every event asks of the open elements is counted as they open and close, so deep nesting costs no more than its
    tags: how many are open of each tag and where, the open blocks, the groups, and what is apart.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # (tag, why it is apart: "", "apart", "comment" or "heading" for an article's own header, blocks open so far)
        self.open: list[tuple[str, str, int]] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[str] = []
        self.apart = 0
        self.headers = 0
        self.headings = 0
        self.links = 0
        self.articles = 0
        self.groups: list[int] = []
        self.kinds: list[str] = []
        self.parents: list[int] = []
        self.lines: list[tuple[str, int, int, int, str]] = []
        self._fresh()

    def _fresh(self) -> None:
        self.parts: list[str] = []
        self.tags = 0
        self.linked = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            group = self.groups[-1] if self.groups else -1
            self.lines.append((text, self.tags, self.linked, group, self.blocks[-1] if self.blocks else "body"))
            self._fresh()
        else:
            self.parts = []

    def _push(self, tag: str, why: str, names: set[str]) -> None:
        self.places[tag].append(len(self.open))
        if tag in _BLOCK:
            self.blocks.append(tag)
        self.open.append((tag, why, len(self.blocks)))
        self.apart += bool(why)
        self.headers += why == "heading"
        self.headings += tag in _HEADINGS
        self.links += tag == "a"
        if tag in _GROUP:
            self.parents.append(self.groups[-1] if self.groups else -1)
            self.groups.append(len(self.kinds))
            self.kinds.append("main" if "main" in names and tag != "body" else tag)
            self.articles += self.kinds[-1] in ("article", "main")

    def _pop(self, depth: int) -> None:
        """Close all elements from `depth` on."""
        while len(self.open) > depth:
            tag, why, _ = self.open.pop()
            if tag in _BLOCK:
                # The line lies in the elements around this one, and is named after the innermost block of those.
                self.blocks.pop()
                self._end_line()
            elif tag in ("td", "th"):
                self.parts.append(" ")
            self.places[tag].pop()
            self.apart -= bool(why)
            self.headers -= why == "heading"
            self.headings -= tag in _HEADINGS
            self.links -= tag == "a"
            if tag in _GROUP:
                self.articles -= self.kinds[self.groups.pop()] in ("article", "main")

    def _find(self, tags: set[str], stop: set[str]) -> int | None:
        """The innermost open element of `tags`, unless one of `stop` lies further in."""
        found = max((self.places[t][-1] for t in tags if self.places[t]), default=None)
        if found is None or any(self.places[t] and self.places[t][-1] > found for t in stop):
            return None
        return found

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.parts.append(" ")
            self.tags += 1
            return
        if tag == "body" and (k := self._find({"head"}, set())) is not None:
            self._pop(k)
        if tag in _CLOSES and (k := self._find(_CLOSES[tag], {"ul", "ol", "dl", "table", "tbody"})) is not None:
            self._pop(k)
        elif tag in _BLOCK and (k := self._find({"p"}, _GROUP | {"li", "blockquote", "table"})) is not None:
            self._pop(k)
        article = self.articles > 0
        names = _names(attrs, tag if article else "") if attrs else set()
        if tag in ("main", "article") and self.apart and not names & _COMMENT and not any(why == "comment" or t in ("head", "script", "style", "aside", "form", "template") for t, why, _ in self.open):
            self._pop(next(k for k, (_, why, _) in enumerate(self.open) if why))  # a menu or an advert that was never closed
        if tag in _BLOCK:
            self._end_line()
        self.tags += 1
        if tag in _VOID:
            return
        words = names & _WORDS if tag not in ("html", "body", "main") else set()
        if tag == "article":
            words &= _COMMENT | {"hidden", "related", "recommended", "ad", "ads", "sponsored", "promo"}
        why = "comment" if words & _COMMENT else "apart" if tag in _APART or words else ""
        if tag == "header" and article and not words:
            why = "heading"
        self._push(tag, why, names)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if self.places[tag]:
            k = self.places[tag][-1]
            if tag in _BLOCK or tag in _APART or tag in _GROUP or self.open[k][2] == len(self.blocks):
                self._pop(k)

    def handle_data(self, data: str) -> None:
        # Of an article's own header the headings are part of the article.
        if not self.apart or self.headings and self.apart == self.headers:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())

    def finish(self) -> None:
        self.close()
        self._pop(0)
        self._end_line()


def smooth(values: np.ndarray, radius: int = RADIUS, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights that fall on lines count alone."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    full = np.convolve(values, kernel, mode="full")[radius : radius + len(values)]
    return full / np.convolve(np.ones(len(values)), kernel, mode="full")[radius : radius + len(values)]


def main_text(html: str | None) -> str:
    """The article's blocks, joined by empty lines."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.finish()
    lines = parser.lines
    if not lines:
        return ""
    chars = np.array([len(x[0]) for x in lines], dtype=float)
    linked = np.minimum(np.array([x[2] for x in lines], dtype=float), chars)
    ratio = smooth((chars - linked) / np.maximum([x[1] for x in lines], 1))
    content = ratio >= min(float(ratio.std()), float(ratio.max()))
    # The clusters above the threshold say which part of the page holds the text; within it short lines belong to it too.
    # A group's weight is that of the lines in it and in the groups inside it, which all have higher numbers.
    group, parents, kinds = np.array([x[3] for x in lines]), parser.parents, parser.kinds
    weight, holds = [0.0] * len(kinds), [False] * len(kinds)
    for g, n in zip(group[content].tolist(), (chars - linked)[content].tolist()):
        if g >= 0:
            weight[g] += n
            holds[g] = True
    for g in range(len(kinds) - 1, -1, -1):
        if holds[g] and parents[g] >= 0:
            weight[parents[g]] += weight[g]
            holds[parents[g]] = True
    total = float(((chars - linked) * content).sum())
    marked = [holds[g] and kinds[g] in ("article", "main") and weight[g] >= 0.3 * total for g in range(len(kinds))]
    around = [False] * len(kinds)  # groups with a marked one inside
    for g in range(len(kinds) - 1, -1, -1):
        if parents[g] >= 0 and (marked[g] or around[g]):
            around[parents[g]] = True
    inner = [m and not x for m, x in zip(marked, around)]
    chosen = max((g for g in range(len(kinds)) if holds[g] and weight[g] >= 0.6 * total), default=-1)
    picked = inner if any(inner) else [g == chosen for g in range(len(kinds))]
    in_picked, in_article = [False] * len(kinds), [False] * len(kinds)
    for g, parent in enumerate(parents):
        in_picked[g] = picked[g] or parent >= 0 and in_picked[parent]
        in_article[g] = inner[g] or parent >= 0 and in_article[parent]
    everything = not any(picked)
    inside = np.array([g < 0 or everything or in_picked[g] for g in group.tolist()])
    # Three or more lines in a row that are links and nothing else are a menu, whatever they are called, but in an article.
    article = np.array([g >= 0 and in_article[g] for g in group.tolist()])
    only_links = ~article & (linked >= 0.9 * chars) & np.array([x[4] != "p" for x in lines])
    menu = np.zeros(len(lines), dtype=bool)
    begin = 0
    for k in range(1, len(lines) + 1):
        if k == len(lines) or only_links[k] != only_links[begin]:
            menu[begin:k] = only_links[begin] and k - begin >= 3
            begin = k
    return "\n\n".join(x[0] for x, keep, drop in zip(lines, inside, menu) if keep and not drop)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns of `pages` and the main text of the page, in a column `text` (underscores appended where the name is taken).

    Lines are blocks; scripts, styles, menus, headers, footers, sidebars, notices, adverts, forms and reader comments are
    left out by element and by the words of class, id and role. The ratio of text outside links to tags, smoothed over
    the lines, tells content from the rest: the innermost article, main part or other group that holds the content above
    the threshold is the text, whole. A null, empty or text-free page gives an empty text; unclosed elements end where
    HTML ends them; markup that never ends is text. Equal pages are read one by one; rows neither move nor meet.
    """
    name = free_name(pages.columns, "text")
    at = pages.columns.index(html_col)
    return map_batches(pages, lambda batch: {name: pa.array([main_text(x.as_py()) for x in batch.column(at)], pa.string())}, [T.StructField(name, T.StringType())])
