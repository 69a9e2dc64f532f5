"""Main text of web pages by composite text density.

A page is read into a tree of elements. Menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts and styles, known by element, role or class name, carry no text. A class name alone is
not believed of an element that holds the main element, the only h1, the only articles or, on a page
without these elements elsewhere, most of its unlinked text; what is inside is then judged by itself. Every other node
gets a density: its characters per tag, corrected for links (the share of characters and of tags inside
links). The sum of the densities of a node's children marks containers of text; the node with the
largest sum is the core of the article. The article is the outermost article or main element around it,
or without one the largest ancestor that has paragraphs, lists or tables beside the way to the core. All
of the article is text but lists and boxes beside that way that are mostly links; so are headings beside the way
before the article, and a title in a box there if the article has none. Elements within running text count as tags only.

Blocks are the texts of block elements; two line breaks in a row also end a block. References are
decoded, white space becomes one space, empty blocks vanish.

Defined cases: a null or empty page, or one without text, gives an empty text; unclosed or stray tags
are mended as browsers do for paragraphs and lists; a page without tags is its own text; repeated rows
are read one by one; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TAG = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z:-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?<=\s)(hidden)(?=[\s/]|\Z)""")
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NOISE = {
    "script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "head", "nav", "footer", "aside", "form",
    "noscript", "template", "svg", "button", "select", "option", "label", "fieldset", "dialog", "menu", "object", "canvas", "audio", "video",
}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "nav", "footer", "aside", "form", "fieldset",
}
#: A start tag of the key ends an open element of the values.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
LIMITS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
CLOSES_P = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|alerts?|newsletter|subscri\w+|"
    r"sign-?up|popup|pop-up|modal|overlay|side-?bars?|aside|menus?|nav\w*|breadcrumbs?|footers?|headers?|masthead|topbar|"
    r"comments?|commentlist|disqus|replies|respond|discussion|shar(?:e|ing)|social\w*|related|recommend\w*|widgets?|toolbar|"
    r"paginat\w+|pager|login|search\w*|skip-link|copyright|disclaimer|tags?|tag-?list)(?:$|[\s_-]|\d)",
    re.I,
)
#: Tokens that say what a page has or lacks, not what an element is.
COMPOUND = re.compile(r"(?:has|no|not|with|without|is)-", re.I)
#: Names of what other people or pages say, however much it is.
OTHERS = re.compile(
    r"comment|disqus|repl(?:y|ies)|respond|discussion|related|recommend|widget|sponsor|promo|advert|adsense|cookie|consent|gdpr|"
    r"newsletter|subscri|disclaimer|copyright|footer|(?:^|[\s_-])ads?(?:$|[\s_-]|\d)",
    re.I,
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu", "menubar", "toolbar"}
NEVER = {"html", "body", "article", "main"}
LINKS = {"a"}
HEADINGS = {"h1", "h2", "h3"}
#: What an article has besides its headings.
PROSE = {"p", "li", "dd", "pre", "blockquote", "table", "figcaption"}
#: Blocks of running text, which are not looked at as containers.
RUNNING = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "caption", "figcaption", "summary", "hr", "address"}


def _noise(tag: str, attributes: str, stack: list[int], tags: list[str]) -> bool:
    if tag in NOISE:
        return True
    if tag == "header" and not any(tags[n] in ("article", "main") for n in stack):
        return True
    if not attributes or tag in NEVER:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = (m[1] or m[3]).lower(), (m[2] or "").strip("\"'")
        if name == "role" and value.lower() in ROLES or name == "hidden":
            return True
        if name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def _named(tag: str, attributes: str) -> str:
    """The class names and ids of an element that sound like noise."""
    if not attributes or tag in NEVER:
        return ""
    found = []
    for m in ATTRIBUTE.finditer(attributes):
        if (m[1] or "").lower() in ("class", "id"):
            tokens = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", m[2].strip("\"'")).split()
            found += [t for t in tokens if not COMPOUND.match(t) and NAMES.search(t)]
    return " ".join(found)


class Page:
    """The tree of a page in lists: parents come before children, texts in page order."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.dead, self.texts = ["#root"], [-1], [False], []
        self.names: dict[int, str] = {}
        stack, at = [0], 0
        match, end = TAG.search(source), len(source)
        while match:
            if match.start() > at:
                self.texts.append((stack[-1], source[at : match.start()]))
            at = match.end()
            tag = (match[2] or match[5] or "").lower()
            if tag and (match[1] or match[4]):
                self._close(tag, stack)
            elif tag:
                attributes = match[3] or match[6] or ""
                self._open(tag, attributes, stack)
                if tag in RAW:
                    stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                    at = stop.start() if stop else end
            elif match[0].startswith("<![CDATA["):
                self.texts.append((stack[-1], html.escape(match[0][9:-3])))
            match = TAG.search(source, at)
        if at < end:
            self.texts.append((stack[-1], source[at:]))
        if self.names:
            self._believe()

    def _open(self, tag: str, attributes: str, stack: list[int]) -> None:
        if tag in CLOSES_P:
            self._end({"p"}, stack, {"table", "td", "th", "button", "article", "div", "section"} if tag != "p" else {"table", "td", "th", "button"})
        if tag in ENDS:
            self._end(ENDS[tag], stack, LIMITS.get(tag, set()))
        if tag in ("html", "body") and tag in self.tags:
            return
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(stack[-1])
        self.dead.append(self.dead[stack[-1]] or _noise(tag, attributes, stack, self.tags))
        if not self.dead[node] and (name := _named(tag, attributes)):
            self.names[node] = name
        if tag == "br":
            self.texts.append((node, ""))
        if tag not in VOID and not attributes.endswith("/") or tag in BLOCKS and tag != "hr":
            stack.append(node)

    def _end(self, tags: set[str], stack: list[int], limits: set[str]) -> None:
        """Close the nearest open element of ``tags``, unless one of ``limits`` is met before."""
        for k in range(len(stack) - 1, 0, -1):
            if self.tags[stack[k]] in tags:
                del stack[k:]
                return
            if self.tags[stack[k]] in limits:
                return

    def _close(self, tag: str, stack: list[int]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            open_tag = self.tags[stack[k]]
            if open_tag == tag:
                del stack[k:]
                return
            # An inline end tag does not reach across a block.
            if tag not in BLOCKS and open_tag in BLOCKS:
                return

    def _believe(self) -> None:
        """Elements whose names sound like noise carry no text, unless they hold what a page is about."""
        n = len(self.tags)
        linked, named = [False] * n, [False] * n
        for i in range(1, n):
            p = self.parents[i]
            linked[i] = linked[p] or self.tags[i] in LINKS
            named[i] = named[p] or i in self.names
        own, holds = [0] * n, [False] * n
        for node, text in self.texts:
            if not self.dead[node] and not linked[node]:
                own[node] += len("".join(text.split()))
        live = [i for i in range(n) if not self.dead[i]]
        only = not any(self.tags[i] in ("article", "main") and not named[i] for i in live)
        articles = [self.tags[i] == "article" and only for i in range(n)]
        title = next((i for i in sorted(live, key=lambda i: (named[i], i)) if self.tags[i] == "h1"), -1)
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            if not self.dead[i]:
                holds[i] = holds[i] or self.tags[i] == "main" or i == title
                holds[p], articles[p], own[p] = holds[p] or holds[i], articles[p] or articles[i], own[p] + own[i]
        for i in range(1, n):
            if i in self.names and not holds[i]:
                most = articles[i] or only and 2 * own[i] > own[0]
                self.dead[i] = not most or bool(OTHERS.search(self.names[i]))
            self.dead[i] = self.dead[i] or self.dead[self.parents[i]]

    def densities(self) -> tuple[list[int], list[int], list[float]]:
        """Characters and linked characters of every node, and the sum of its children's composite densities."""
        n = len(self.tags)
        linked = [False] * n
        for i in range(1, n):
            linked[i] = linked[self.parents[i]] or self.tags[i] in LINKS
        chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text in self.texts:
            if text and not self.dead[node]:
                size = len("".join(text.split()))
                chars[node] += size
                link_chars[node] += size * linked[node]
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            if not self.dead[i]:
                chars[p] += chars[i]
                link_chars[p] += link_chars[i]
                tags[p] += tags[i] + 1
                link_tags[p] += link_tags[i] + linked[i]
        body = next((i for i in range(n) if self.tags[i] == "body"), 0)
        share = link_chars[body] / max(1, chars[body])
        sums = [0.0] * n
        for i in range(n):
            c, lc, t, lt = chars[i], link_chars[i], max(1, tags[i]), max(1, link_tags[i])
            if c and not self.dead[i]:
                base = math.log(c * lc / max(1, c - lc) + share * c + math.e)
                ratio = max(c * t / (max(1, lc) * lt), 1.0 + 1e-9)
                if i:
                    sums[self.parents[i]] += c / t * math.log(ratio) / base
        return chars, link_chars, sums

    def article(self) -> tuple[set[int], set[int]]:
        """The nodes whose subtrees are the main text, and those inside that are not."""
        chars, link_chars, sums = self.densities()
        live = [i for i in range(len(self.tags)) if not self.dead[i]]
        boxes = [i for i in live if i == 0 or self.tags[i] in BLOCKS and self.tags[i] not in RUNNING]
        best = max(boxes, key=lambda i: (sums[i], -i))
        if not sums[best]:
            return {0}, set()
        way = [best]
        while self.parents[way[-1]] >= 0:
            way.append(self.parents[way[-1]])
        above, on_way = set(way[1:]), set(way)
        beside = [i for i in live if self.parents[i] in above and i not in on_way]
        links = {i for i in beside if 2 * link_chars[i] > chars[i] and self.tags[i] in BLOCKS - RUNNING - {"hgroup"}}
        frame = next((i for i in reversed(way) if self.tags[i] in ("article", "main")), None)
        if frame is None:
            frame = self._frame(way, set(beside) - links, chars, link_chars)
        outside = set(way[way.index(frame) + 1 :])
        roots = {frame, *(i for i in beside if self.parents[i] in outside and self.tags[i] in HEADINGS and i < best)}
        within = [False] * len(self.tags)
        for i in range(len(self.tags)):
            within[i] = i in roots or i > 0 and within[self.parents[i]]
        titles = [i for i in live if self.tags[i] == "h1" and chars[i]]
        if titles and titles[0] < best and not any(within[i] for i in titles):
            roots.add(titles[0])
        return roots, links

    def _frame(self, way: list[int], beside: set[int], chars: list[int], link_chars: list[int]) -> int:
        """The largest node of the way that has prose in one of the nodes ``beside`` it."""
        branch, wide = [-1] * len(self.tags), {way[0]}
        for i in range(1, len(self.tags)):
            p = self.parents[i]
            branch[i] = i if i in beside else branch[p]
            if branch[i] >= 0 and self.tags[i] in PROSE and not self.dead[i] and 2 * link_chars[i] < chars[i]:
                wide.add(self.parents[branch[i]])
        return next(i for i in reversed(way) if i in wide)

    def text(self) -> str:
        roots, cut = self.article()
        n = len(self.tags)
        kept, block = [False] * n, [0] * n
        for i in range(n):
            p = self.parents[i]
            kept[i] = (i in roots or p >= 0 and kept[p]) and i not in cut
            block[i] = i if i == 0 or self.tags[i] in BLOCKS else block[p]
        out, parts, last, breaks = [], [], None, 0

        def flush() -> None:
            line = " ".join(html.unescape("".join(parts)).split())
            if line:
                out.append(line)
            parts.clear()

        previous = 0
        for node, text in self.texts:
            if not kept[node] or self.dead[node]:
                continue
            # A block that opened since the last text also ends it, even if it has none itself.
            if last is not None and (block[node] != last or any(self.tags[i] in BLOCKS for i in range(previous + 1, node + 1))):
                flush()
                breaks = 0
            last, previous = block[node], max(previous, node)
            if self.tags[node] == "br":
                breaks += 1
                parts.append(" ")
                if breaks == 2:
                    flush()
            elif text:
                breaks = breaks if text.isspace() else 0
                parts.append(text)
        flush()
        return "\n".join(out)


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns and ``text`` of every page."""
    rows = pages.select(*keep, F.col(html_col).cast("string").alias("_html"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.drop("_html").dtypes)

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = pa.array([main_text(x) for x in batch.column(len(keep)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*keep, "text"])

    return rows.mapInArrow(read, f"{kinds}, text string")
