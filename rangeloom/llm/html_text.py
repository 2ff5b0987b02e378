"""Main text of web pages: parser events, text-to-tag ratios, smoothing, clustering.

A page goes through the standard library's parser as a stream of events. Events cut it
into lines (one per block element); each has a text-to-tag ratio, text in links, navigation,
adverts, forms and the like counting as none. The ratios' logarithms, none above their
median, are smoothed by a Gaussian and split into two clusters by a threshold; lines of
the upper one mark content. The content is then all articles of the page, or without one
the lines of the smallest element around all marked lines, except blocks of links before
the first and after the last of them. So a short paragraph, a list or a heading is not lost.

Class names and ids only raise a question, which the element's text answers. Adverts and the
like go, and outside articles menus, footers and sidebars, unless they hold an article or nearly
all of the page's text; what is called "related", "header" or "notice", and a form, goes if it has
little text for its tags, or mostly links. Reader comments are marked as a list of them, or
come several at a time.

Everything is linear in the page: the open elements carry what holds of those around them,
and no more than :data:`DEEPEST` are open at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rangeloom.llm.common import bound_batches

#: Standard deviation of the smoothing, in lines.
SIGMA = 1.5
#: Characters given to the parser at a time.
FEED = 1 << 16
#: A marked element goes if it has fewer characters for each tag, or is mostly links.
LEAST_RATIO = 20
#: Elements open at a time; those deeper are taken as part of the deepest one, as browsers do.
DEEPEST = 512

# HTML's element names by what they do to a page's text.
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NO_END = frozenset("p li dt dd option tr td th thead tbody tfoot b i u em strong small font".split()) | _VOID
_DROPPED = frozenset(
    "head title script style noscript template svg iframe object canvas audio video nav footer aside "
    "button select textarea dialog menu".split()
)
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu".split())
# Words in class names and ids that mark what is not the article. Some count as
# a whole name only, some as a part of one; some hold outside articles, some need proof.
_ADVERTS = frozenset(
    "advert adverts advertisement advertising adsbygoogle sponsor sponsored cookie cookies consent gdpr newsletter "
    "subscribe signup popup modal".split()
)
_WHOLE_ADVERTS = frozenset("ad ads adv promo promotion overlay".split())
_FURNITURE = frozenset(
    "banner nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar aside login search pagination "
    "pager toolbar copyright".split()
)
_DOUBTFUL = _ADVERTS | _WHOLE_ADVERTS | _FURNITURE | frozenset(
    "header widget widgets notice notices alert share sharing social related recommended recommendations teaser "
    "trending disclaimer discussion reply replies responses response reviews".split()
)
_HEADER_MARKS = frozenset("header masthead banner".split())
_COMMENT_LISTS = frozenset("comments commentlist disqus respond user-reviews".split())
_COMMENT = frozenset("comment".split())
_SPACE = re.compile(r"\s+")
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _marks(attrs: dict[str, str | None]) -> tuple[set[str], set[str]]:
    """Names of an element's class and id, whole and in their parts, in small letters."""
    names = " ".join(filter(None, (attrs.get("class"), attrs.get("id"))))
    return {w.lower() for w in names.split()}, {w.lower() for w in _NAME.findall(names)}


class _Element:
    """An open element, with what holds of it by those around it."""

    __slots__ = ("article", "dropped", "group", "header", "hard", "link", "number", "tag")

    def __init__(self, tag, number, dropped, header, link=False, group=0, article=False, hard=False):
        self.tag, self.number, self.dropped, self.header, self.link, self.group = tag, number, dropped, header, link, group
        self.article, self.hard = article, hard


class _Group:
    """An element that class, id or tag puts in doubt."""

    __slots__ = ("article", "headings", "holds", "kind", "parent")

    def __init__(self, parent: int, kind: str, article: bool, headings: bool):
        self.parent, self.kind, self.article, self.headings, self.holds = parent, kind, article, headings, False


class _Lines(HTMLParser):
    """Cuts a page into lines of ``(text, tags, container, characters in links)``; a dropped line has no text.

    ``parents`` has the container around each container, ``articles`` those that are articles.
    ``groups`` are the elements in doubt, ``line_groups`` the innermost one of each line.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.line_groups: list[int] = []
        self.parents = [0]
        self.articles: set[int] = set()
        self.groups = [_Group(0, "page", False, True)]
        self.stack = [_Element("", 0, False, False)]
        self.too_deep: dict[str, int] = {}
        self.data: list[str] = []
        self.tags, self.links, self.line_group = 0, 0, 0
        self.heading = False
        self.headings: set[int] = set()

    def doubt(self, tag: str, values: dict, inside: bool) -> str | None:
        """What an element may be instead of content, by its names."""
        if tag == "form":
            return "form"
        if not ("class" in values or "id" in values):
            return None
        whole, parts = _marks(values)
        if parts & {"with", "has", "no"}:
            return None
        if whole & _COMMENT_LISTS or parts & (_COMMENT_LISTS - {"respond"}):
            return "comments"
        if whole & _COMMENT:
            return "comment"
        if whole & _WHOLE_ADVERTS or parts & _ADVERTS:
            return "advert"
        if not inside and whole & _FURNITURE:
            return "furniture"
        return "doubtful" if parts & _DOUBTFUL or whole & _DOUBTFUL else None

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self.end_line()
        self.tags += 1
        if tag == "br":
            self.data.append(" ")
        if tag in _VOID:
            return
        values = dict(attrs)
        top = self.stack[-1]
        content = tag in ("article", "main", "body", "html")
        kind = None if content else self.doubt(tag, values, top.article)
        if tag in _NO_END:
            if tag in _BLOCK and kind and not top.dropped:
                self.line_group = self.group(top.group, kind, top.article, values)
            return
        self.heading = self.heading or tag in _HEADINGS
        if len(self.stack) > DEEPEST:
            self.too_deep[tag] = self.too_deep.get(tag, 0) + 1
            return
        hidden = "hidden" in values or values.get("aria-hidden") == "true"
        own = tag in _DROPPED or values.get("role") in _DROPPED_ROLES or hidden
        own |= tag == "article" and bool(values) and bool(_marks(values)[1] & {"related", "teaser", "recommended", "promo"})
        header = top.header or (tag == "header" and top.article)
        own |= tag == "header" and not top.article
        if top.article and tag in _HEADINGS and not hidden:
            own = False
        # A menu or header left open ends where the article begins.
        inherited = top.dropped and not (content and not top.hard)
        article = tag in ("article", "main") and not inherited and not own and not top.article
        if article:
            self.articles.add(len(self.parents))
            up = top.group
            while up and not self.groups[up].holds:
                self.groups[up].holds = True
                up = self.groups[up].parent
        number = self.container(top) if article or tag in _BLOCK and not top.article else top.number
        group = top.group
        if kind and tag in _BLOCK and not (own or inherited):
            group = self.group(top.group, kind, top.article, values)
        self.stack.append(
            _Element(
                tag, number, not article and (own or inherited), header and not article, top.link or tag == "a", group,
                top.article or article, top.hard or tag in ("aside", "footer"),
            )
        )

    def group(self, parent: int, kind: str, article: bool, values: dict) -> int:
        self.groups.append(_Group(parent, kind, article, bool(_marks(values)[1] & _HEADER_MARKS)))
        return len(self.groups) - 1

    def container(self, around):
        self.parents.append(around.number)
        return len(self.parents) - 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self.end_line()
        self.tags += 1
        if tag in _NO_END:
            return
        if self.too_deep.get(tag):
            self.too_deep[tag] -= 1
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return

    def handle_data(self, data):
        top = self.stack[-1]
        self.data.append("" if top.dropped else data)
        if top.link and not top.dropped:
            self.links += len(_SPACE.sub(" ", data))

    def end_line(self):
        top = self.stack[-1]
        text = _SPACE.sub(" ", "".join(self.data)).strip()
        if top.dropped or (top.header and not self.heading):
            text = ""
        if text or self.tags:
            if self.heading:
                self.headings.add(len(self.lines))
            self.line_groups.append(self.line_group or top.group)
            self.lines.append((text, self.tags, top.number, min(self.links, len(text))))
        self.data, self.tags, self.links, self.line_group = [], 0, 0, 0
        self.heading = False

    def drop_doubtful(self):
        """Take the text from the elements in doubt whose text does not speak for them."""
        if len(self.groups) == 1:
            return
        chars, links, tags = ([0] * len(self.groups) for _ in range(3))
        for k, (text, n_tags, _, n_links) in enumerate(self.lines):
            g = self.line_groups[k]
            if self.groups[g].headings and k in self.headings and g:
                g = self.groups[g].parent  # a title in a header is the article's
                self.line_groups[k] = g
            chars[g] += len(text)
            links[g] += n_links
            tags[g] += max(1, n_tags)
        for g in range(len(self.groups) - 1, 0, -1):
            for sums in (chars, links, tags):
                sums[self.groups[g].parent] += sums[g]
        several = sum(g.kind == "comment" for g in self.groups) > 1
        gone = [False] * len(self.groups)
        for g in range(1, len(self.groups)):
            group = self.groups[g]
            if gone[group.parent]:
                gone[g] = True
                continue
            poor = 2 * links[g] > chars[g] or chars[g] < LEAST_RATIO * tags[g]
            share = 0.5 if group.kind in ("doubtful", "form", "comment") else 0.8
            most = chars[g] > share * chars[0] and (group.article or not self.articles) and not (group.kind == "form" and poor)
            if not (group.holds or most):
                gone[g] = poor or group.kind in ("advert", "furniture", "comments") or group.kind == "comment" and (several or not group.article)
        for k, g in enumerate(self.line_groups):
            if gone[g]:
                self.lines[k] = ("", *self.lines[k][1:3], 0)


def _smooth(ratios: np.ndarray) -> np.ndarray:
    radius = int(np.ceil(3 * SIGMA))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / SIGMA) ** 2)
    return np.convolve(np.pad(ratios, radius), kernel / kernel.sum(), "valid")


def _threshold(values: np.ndarray) -> float:
    """Where two clusters part: the middle of their means, found from the mean on."""
    at = values.mean()
    while True:
        upper = values >= at
        if upper.all():
            return float(values.min())
        new = (values[upper].mean() + values[~upper].mean()) / 2
        if abs(new - at) <= 1e-9 * max(1.0, abs(at)):
            return float(new)
        at = new


def _of_links(lines: list[tuple[str, int, int, int]]) -> bool:
    """Whether most of the text of lines is in links."""
    return 2 * sum(links for *_, links in lines) > sum(len(text) for text, *_ in lines)


def _outermost(lines: list[tuple[str, int, int, int]], parents: list[int], marked: list[int]) -> set[int]:
    """Lines of the smallest container around all marked lines.

    Its blocks before the first and after the last marked line are left out if they are links.
    """

    depth = [0] * len(parents)  # containers are numbered after those around them
    for k in range(1, len(parents)):
        depth[k] = depth[parents[k]] + 1
    common = lines[marked[0]][2]
    for k in marked[1:]:
        other = lines[k][2]
        while common != other:
            if depth[common] >= depth[other]:
                common = parents[common]
            else:
                other = parents[other]
    child = [-1] * len(parents)  # the block of the common container that each is in
    for k in range(len(parents)):
        if k != common and k:
            child[k] = k if parents[k] == common else child[parents[k]]
    blocks: dict[tuple[int, ...], list[int]] = {}
    for k, line in enumerate(lines):
        if line[0] and (line[2] == common or child[line[2]] >= 0):  # a line of the container itself is a block alone
            blocks.setdefault((child[line[2]],) if line[2] != common else (-1, k), []).append(k)
    kept = [b for b in blocks.values() if b[-1] >= marked[0] and b[0] <= marked[-1] or not _of_links([lines[k] for k in b])]
    return {k for b in kept for k in b}


def _content(parser: _Lines) -> set[int]:
    """Which lines are content."""
    lines = parser.lines
    some = np.array([bool(text) for text, *_ in lines])
    plain = np.array([len(text) - links for text, _, _, links in lines])
    ratios = np.log1p(plain / np.maximum(1, [tags for _, tags, *_ in lines]))
    middle = np.median(ratios[plain > 0]) if (plain > 0).any() else 0.0
    smooth = _smooth(np.minimum(ratios, middle))
    upper = some & (smooth >= _threshold(smooth))
    marked = np.flatnonzero(upper).tolist() or [max(np.flatnonzero(some).tolist(), key=lambda k: smooth[k])]
    inside: dict[int, list[int]] = {}
    for k in np.flatnonzero(some).tolist():
        if lines[k][2] in parser.articles:
            inside.setdefault(lines[k][2], []).append(k)
    if not inside:
        return _outermost(lines, parser.parents, marked)
    articles = {a for a, of in inside.items() if not _of_links([lines[k] for k in of])}
    # Beside an article, a block of long lines is content too.
    beside = {lines[k][2] for k in marked if ratios[k] >= middle}
    return {k for k in np.flatnonzero(some).tolist() if lines[k][2] in articles | beside}


def main_text(html: str | None) -> str:
    """The article of a page: its blocks, white space made one space, joined by two newlines."""
    if not html:
        return ""
    html = _CUT_TAG.sub("", html)
    parser = _Lines()
    for start in range(0, len(html), FEED):
        parser.feed(html[start : start + FEED])
    parser.close()
    parser.end_line()
    parser.drop_doubtful()
    if not any(text for text, *_ in parser.lines):
        return ""
    return "\n\n".join(parser.lines[k][0] for k in sorted(_content(parser)))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``; reads ``page_id, url, html``.

    A null or empty page, or one without article text, gives an empty text. Unclosed and
    cut-off tags end with the page. Ids and urls pass as they are; repeated rows repeat.
    """
    bound_batches(pages.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    )
