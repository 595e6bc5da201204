"""Main text of web pages by scoring the tree.

Every block of running text passes points for its length and its commas to the elements around it, less the
further out they are; an element's points are discounted by the share of its text that stands in links. The
best element and those of its siblings that are also text are kept, without the parts that never belong to an
article: menus, headers, footers, sidebars, notices, adverts, forms, comments and what is not shown.

A page is read in one pass by patterns with bounded look-ahead, without recursion, so that time follows its
length. Pages are judged one by one in an Arrow UDF: no shuffle.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements without content, with unparsed content, and those that start a new block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead title tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements and roles that hold no article text.
NEVER = frozenset(
    "head script style noscript template svg math nav header footer aside form button select textarea input iframe "
    "object embed applet canvas audio video menu dialog noembed noframes title search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words of class names and ids of such elements, and words by which a name only tells a state of the page.
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar side "
    "aside menu nav navbar navigation breadcrumb breadcrumbs header masthead footer foot cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share "
    "sharing social related recommended recommendations comment comments disqus respond reply replies discussion "
    "pagination pager widget toolbar tags skip".split()
)
STATES = frozenset("has have with without no not on off open closed enabled disabled allowed is".split())

# A start tag with its attributes; quoted values may hold ">".
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^'">]|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""(?i)(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile("[a-z]+|[0-9]+")
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
_ROOT = 0


def _names_unwanted(value: str) -> bool:
    """Whether a class list, id or itemprop names what is no article. Each name counts for itself: "comment-body" does,
    "content" beside it does not help, and "has-sidebar" or "comments-open" tell a state of something else."""
    for name in value.split():
        words = set(_WORDS.findall(name))
        if words & UNLIKELY and not words & STATES:
            return True
    return False


def _unwanted(tag: str, attributes: str, nested: bool) -> bool:
    """``nested``: inside another article. The names of an outermost article or main element don't count."""
    if tag in NEVER:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    own = tag == "main" or (tag == "article" and not nested)
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id", "itemprop"):
            if not own and _names_unwanted(value):
                return True
        elif name == "role":
            if ROLES & set(value.split()):
                return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


class Page:
    """The elements of a page, numbered in page order, and its text with the block borders between."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.bad = ["#root"], [_ROOT], [False]
        # (element, text), or (element, None) where a block begins or ends.
        self.events: list[tuple[int, str | None]] = []
        self._stack, self._open = [_ROOT], Counter()
        self._read(source)

    def _pop(self, depth: int) -> None:
        while len(self._stack) > depth:
            node = self._stack.pop()
            tag = self.tag[node]
            self._open[tag] -= 1
            if tag in BLOCK:
                self.events.append((node, None))

    def _close_before(self, tag: str) -> None:
        """Ends that the start of this element implies."""
        if tag in BLOCK and self._open["p"]:
            i = len(self._stack) - 1
            while i and self.tag[self._stack[i]] not in BLOCK:
                i -= 1
            if self.tag[self._stack[i]] == "p":
                self._pop(i)
        if tag in _CLOSES:
            own, border = _CLOSES[tag]
            if any(self._open[t] for t in own):
                for i in range(len(self._stack) - 1, 0, -1):
                    at = self.tag[self._stack[i]]
                    if at in own:
                        return self._pop(i)
                    if at in border:
                        return None
        return None

    def _start(self, tag: str, attributes: str) -> None:
        self._close_before(tag)
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self._stack[-1])
        self.bad.append(self.bad[self._stack[-1]] or _unwanted(tag, attributes, self._open["article"] > 0))
        if tag in BLOCK:
            self.events.append((node, None))
        if tag == "br":
            self.events.append((node, " "))
        if tag not in VOID:
            self._stack.append(node)
            self._open[tag] += 1

    def _end(self, tag: str) -> None:
        if not self._open[tag]:
            return
        for i in range(len(self._stack) - 1, 0, -1):
            at = self.tag[self._stack[i]]
            if at == tag:
                return self._pop(i)
            if tag not in BLOCK and at in BLOCK:
                return

    def _read(self, source: str) -> None:
        at, lowered = 0, None
        while True:
            lt = source.find("<", at)
            if lt < 0:
                self._text(source[at:])
                break
            if lt > at:
                self._text(source[at:lt])
            after = source[lt + 1 : lt + 2]
            if source.startswith("<!--", lt):
                end = source.find("-->", lt + 4)
                at = len(source) if end < 0 else end + 3
            elif after in ("!", "?"):
                end = source.find(">", lt)
                at = len(source) if end < 0 else end + 1
            elif m := _TAG.match(source, lt) or _LOOSE_TAG.match(source, lt):
                tag, at = m[2].lower(), m.end()
                if m[1]:
                    self._end(tag)
                else:
                    self._start(tag, m[3])
                    if tag in RAW:
                        lowered = lowered or source.translate(_LOWER)
                        end = lowered.find(f"</{tag}", at)
                        at = len(source) if end < 0 else end
            else:
                # A "<" that starts no tag is text; an unfinished tag at the end of the page is not.
                if not (after.isalpha() or after == "/"):
                    self._text("<")
                    at = lt + 1
                else:
                    at = len(source) if source.find(">", lt) < 0 else lt + 1
        self._pop(1)

    def _text(self, text: str) -> None:
        if text:
            self.events.append((self._stack[-1], html.unescape(text) if "&" in text else text))

    # --- scoring ------------------------------------------------------------------------------

    def _points(self) -> tuple[list[float], list[int], list[int]]:
        """For each element its points, the characters in it, and those of them in links."""
        n = len(self.tag)
        points, size, linked, commas = [0.0] * n, [0] * n, [0] * n, [0] * n
        block, link = [_ROOT] * n, [False] * n
        for node in range(1, n):
            up = self.parent[node]
            block[node] = node if self.tag[node] in BLOCK else block[up]
            link[node] = link[up] or self.tag[node] == "a"
        own = [0] * n
        for node, text in self.events:
            if text is not None and not self.bad[node]:
                length = len(text) if not text.isspace() else 0
                size[node] += length
                linked[node] += length if link[node] else 0
                own[block[node]] += length if not link[node] else 0
                commas[block[node]] += text.count(",")
        for node in range(n - 1, 0, -1):
            size[self.parent[node]] += size[node]
            linked[self.parent[node]] += linked[node]
        for node in range(n):
            if own[node] and self.tag[node] not in HEADINGS:
                gives = 1 + commas[node] + own[node] / 100
                share, up = 1.0, node if self.tag[node] in ("div", "section", "article", "main", "body", "#root") else self.parent[node]
                for _ in range(5):
                    points[up] += gives * share
                    if up == _ROOT:
                        break
                    share, up = share / 2, self.parent[up]
        for node in range(n):
            points[node] *= 1 - linked[node] / max(1, size[node])
        return points, size, linked

    def _leave_out_comments(self) -> None:
        """An article inside another is a reader's comment or a pointer to another text, unless the outer one has less
        text of its own than it."""
        outer = [_ROOT] * len(self.tag)  # the innermost article around each element, itself included
        for node in range(1, len(self.tag)):
            outer[node] = node if self.tag[node] == "article" else outer[self.parent[node]]
        own = [0] * len(self.tag)
        for node, text in self.events:
            if text is not None and not self.bad[node]:
                own[outer[node]] += len(text.strip())
        for node in range(1, len(self.tag)):
            around = outer[self.parent[node]]
            inner = self.tag[node] == "article" and around != _ROOT and own[around] >= own[node]
            self.bad[node] = self.bad[node] or self.bad[self.parent[node]] or inner

    def main_elements(self) -> set[int]:
        """The best element, or the outermost article it lies in, and the siblings that go with it."""
        self._leave_out_comments()
        points, size, linked = self._points()
        inline = [t not in BLOCK and t != "#root" for t in self.tag]
        usable = [i for i in range(len(self.tag)) if not self.bad[i] and not inline[i]]
        best = max(usable, key=lambda i: (points[i], -i))
        if points[best] <= 0:
            # Headings at most; what stands in links alone is a menu.
            return {i for i in usable if self.tag[i] in HEADINGS and size[i] and not linked[i]}
        at, article, main = best, _ROOT, _ROOT
        while at != _ROOT:
            if self.tag[at] == "article":
                article = at
            elif self.tag[at] == "main":
                main = main or at
            at = self.parent[at]
        best = article or main or best
        chosen = {best}
        if best == _ROOT or self.tag[best] in ("html", "body"):
            return chosen
        floor = max(10.0, 0.2 * points[best])
        for node in range(1, len(self.tag)):
            if self.parent[node] != self.parent[best] or self.bad[node] or node == best:
                continue
            few_links = linked[node] < 0.25 * max(1, size[node])
            if self.tag[node] in ("p", "pre", "blockquote") or self.tag[node] in HEADINGS:
                if size[node] and few_links:
                    chosen.add(node)
            elif few_links and (points[node] >= floor or (self.tag[node] == self.tag[best] == "article" and points[node] > 0)):
                chosen.add(node)
        return chosen

    def text(self) -> str:
        chosen = self.main_elements()
        kept = [False] * len(self.tag)
        for node in range(len(self.tag)):
            kept[node] = not self.bad[node] and (node in chosen or (node != _ROOT and kept[self.parent[node]]))
        blocks, parts = [], []
        for node, text in self.events:
            if text is None:
                blocks.append("".join(parts))
                parts = []
            elif kept[node]:
                parts.append(text)
        blocks.append("".join(parts))
        return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


_LOWER = {i: i + 32 for i in range(65, 91)}


def main_text(page: str | None) -> str:
    return Page(page).text() if page else ""


def extract(page: Column) -> Column:
    """Main text of a page's html; empty for null, empty and textless pages.

    Character references are decoded, white space inside a block is one space, blocks are joined by one line
    feed in page order. Broken markup is read as browsers do in the common cases: open elements end with what
    surrounds them or with the page. Articles side by side are one text. An article inside another is left out as a
    comment unless it has more text than the outer one. A page whose text stands in links alone, or whose whole body
    is one form, has no main text.
    """

    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return extracted(page)
