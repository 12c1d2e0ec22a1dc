"""Main text of web pages by tree scoring.

The page becomes a light tree. Elements that are never article text (scripts, menus, forms, footers, adverts,
notices, sidebars, reader comments, ...) are marked with all they hold. A mark by class or id name alone does not
count for an article, nor for an element that holds most of the page's paragraph points; it halves their scores.
A form goes in the same way, unless it is wrapped around the page: then it also holds a heading, an article or
several paragraphs. A fieldset is a form's only if it holds a control. Formulas are text.
Every paragraph passes points for its length and commas to its ancestors, less with each level, and an ancestor's
score is discounted by the share of its text that is inside links. The best container is kept, widened to the article element around it, or
else together with the siblings that score well too. Blocks of the kept text are joined in page order.

Defined results: null and empty pages have an empty text; tags left open are closed where the next block
begins; repeated pages are extracted each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.text import slices

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_LETTERS = re.compile(r"[a-z]+")

RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "object", "xmp",
       "annotation", "annotation-xml"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
          "img", "wbr", "td", "th", "ruby", "rt", "rp",
          "math", "semantics", "mfenced", "mfrac", "mi", "mn", "mo", "mover", "mpadded", "mphantom", "mroot", "mrow", "ms", "mspace",
          "msqrt", "mstyle", "msub", "msubsup", "msup", "mtable", "mtd", "mtext", "mtr", "munder", "munderover"}
#: A start tag of the key closes an open element of the value, up to the given scopes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}
SCOPES = {"ul", "ol", "dl", "table", "html", "body", "div", "article", "section", "td", "th", "main", "blockquote"}
NEVER = {"nav", "footer", "aside", "button", "menu", "dialog", "head", "input", "menuitem", "datalist"}
#: What makes a fieldset part of a form.
CONTROLS = {"input", "select", "textarea", "button"}
NEVER_ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "dialog", "alert", "alertdialog", "menu", "menubar",
               "toolbar", "form"}
#: Words in class or id names of elements that are not article text.
NEVER_WORDS = {"ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb",
               "breadcrumbs", "comment", "comments", "commentlist", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead",
               "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination",
               "paywall", "popup", "promo", "promotion", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "sidebars",
               "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget", "widgets"}
#: Words that go with them in one name: sidebar-left, comment-list; has-sidebar and social-science are other names.
BESIDE = {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "col", "column", "container", "desktop", "fixed",
          "footer", "form", "global", "group", "header", "icons", "inner", "item", "items", "js", "left", "link", "links", "list",
          "main", "media", "mobile", "outer", "page", "posts", "primary", "right", "secondary", "section", "site", "slot", "sticky",
          "stories", "thread", "top", "unit", "wrap", "wrapper", "wp"}
#: What points inside an element that is named as furniture count for.
NAMED = 0.5
#: Elements that hold the whole page or article, whatever their class is.
HOLDERS = {"html", "body", "main"}
PARAGRAPHS = {"p", "pre", "blockquote", "td", "div", "section", "article", "li", "dd"}
LEAST_PARAGRAPH = 25


class Tree:
    """Elements in page order: tag, parent, end of the subtree, marks, and the text items with their block."""

    def __init__(self, page: str):
        self.tag, self.parent, self.end = ["body"], [-1], [0]
        self.dropped, self.linked = [False], [False]
        self.named = [False]  # by class or id name alone, or a form
        controls: set[int] = set()  # fieldsets that hold one
        self.items: list[tuple[int, int, str]] = []  # element, block, text
        stack, block, breaks, at = [0], 0, 0, 0
        for m in iter(lambda: _TAG.search(page, at), None):
            if m.start() > at:
                breaks = self._text(stack[-1], block, page[at:m.start()], breaks)
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                if name not in INLINE:
                    block += 1
                self._close(stack, {name}, set())
                continue
            if name in CONTROLS:
                controls.update(s for s in stack if self.tag[s] == "fieldset")
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = close.end() if close else len(page)
                continue
            if name == "br":
                # one break is white space, two end the block
                breaks += 1
                block += breaks > 1
                self.items.append((stack[-1], block, " "))
                continue
            if name in VOID:
                block += name == "hr"
                continue
            breaks = 0
            if name not in INLINE:
                block += 1
                self._close(stack, {"p", "h1", "h2", "h3", "h4", "h5", "h6"}, SCOPES | {"li"})
            elif name in ("td", "th"):
                self.items.append((stack[-1], block, " "))
            if name in CLOSES:
                self._close(stack, CLOSES[name], SCOPES - CLOSES[name])
            self._open(stack, name, m[3])
        if at < len(page):
            self._text(stack[-1], block, page[at:], breaks)
        n = len(self.tag)
        if controls:
            for i in range(1, n):
                self.dropped[i] |= i in controls or self.dropped[self.parent[i]]
        for i in range(n):
            self.end[i] = i + 1
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            self.end[p] = max(self.end[p], self.end[i])

    def _text(self, element: int, block: int, text: str, breaks: int) -> int:
        self.items.append((element, block, html.unescape(text) if "&" in text else text))
        return breaks if text.isspace() else 0

    def _close(self, stack: list[int], names: set[str], scopes: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag in names:
                del stack[k:]
                return
            if tag in scopes:
                return

    def _open(self, stack: list[int], name: str, raw: str) -> None:
        up = stack[-1]
        gone = self.dropped[up] or name in NEVER
        if name == "header" and not gone:
            gone = not any(self.tag[s] == "article" for s in stack)
        named = False
        if raw and not raw.isspace() and not gone and name not in HOLDERS:
            gone, named = hidden(raw)
        named = named or name == "form" and not gone
        self.tag.append(name)
        self.named.append(named)
        self.parent.append(up)
        self.end.append(0)
        self.dropped.append(gone)
        self.linked.append(self.linked[up] or name == "a")
        stack.append(len(self.tag) - 1)


def hidden(raw: str) -> tuple[bool, bool]:
    """Whether the attributes say that an element is not article text, and whether its names do."""
    values = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(raw)}
    if values.get("role") in NEVER_ROLES or values.get("aria-hidden") == "true":
        return True, False
    if "none" in values.get("style", "") and re.search(r"display\s*:\s*none", values["style"]):
        return True, False
    if re.search(r"(?:^|\s)hidden(?:\s|$|=)", _ATTRIBUTE.sub(" ", raw).lower()):
        return True, False
    for token in (values.get("class", "") + " " + values.get("id", "")).split():
        words = set(_LETTERS.findall(token))
        if words & NEVER_WORDS and words <= NEVER_WORDS | BESIDE:
            return False, True
    return False, False


def _points(direct: int, commas: int, links: int, chars: int) -> float:
    return (1 + commas + min(direct / 100, 3)) * (1 - min(1, links / max(chars, 1)))


def drop_named(tree: Tree, points: list[float]) -> list[float]:
    """Drop the elements that are named as furniture, with what they hold, but outer articles and those that hold
    most of the page's points. Returns what the points of every element count for."""
    n = len(tree.tag)
    weight = [1.0] * n
    if not any(tree.named):
        return weight
    total = [0.0] * (n + 1)
    for i in range(n):
        total[i + 1] = total[i] + points[i]
    page = total[n]
    inside = [False] * n  # inside an article
    for i in range(1, n):
        p = tree.parent[i]
        weight[i] = weight[p]
        inside[i] = inside[p] or tree.tag[p] == "article"
        if tree.dropped[p]:
            tree.dropped[i] = True
        elif tree.named[i] and not tree.dropped[i]:
            own = total[tree.end[i]] - total[i]
            if tree.tag[i] == "article" and not inside[i] or own and NAMED * own > page - own and (
                    tree.tag[i] != "form" or _wraps_page(tree, i, points)):
                weight[i] = NAMED * weight[p]
            else:
                tree.dropped[i] = True
    return weight


def _wraps_page(tree: Tree, form: int, points: list[float]) -> bool:
    """Whether a form holds what a page has: a main heading, an article or more than one paragraph with points."""
    held = range(form + 1, tree.end[form])
    return any(tree.tag[i] in ("article", "main", "h1") and not tree.dropped[i] for i in held) or sum(points[i] > 0 for i in held) > 1


def _sums(tree: Tree) -> tuple[list[int], list[int], list[int], list[int]]:
    """Characters, those inside links, commas and characters that are an element's own, without what is dropped."""
    n = len(tree.tag)
    chars, links, commas, direct = [0] * n, [0] * n, [0] * n, [0] * n
    for element, _, text in tree.items:
        if tree.dropped[element]:
            continue
        size = len(text.strip())
        chars[element] += size
        direct[element] += size
        commas[element] += text.count(",")
        if tree.linked[element]:
            links[element] += size
    inline = [tag in INLINE and tag not in ("td", "th") for tag in tree.tag]
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        if inline[i]:
            # what inline elements hold belongs to the block around them
            direct[p] += direct[i]
            commas[p] += commas[i]
    return chars, links, commas, direct


def _given(tree: Tree, chars: list[int], links: list[int], commas: list[int], direct: list[int]) -> list[float]:
    """The points that every element gives as a paragraph."""
    return [0.0 if tree.dropped[i] or tree.tag[i] not in PARAGRAPHS or direct[i] < LEAST_PARAGRAPH else
            _points(direct[i], commas[i], links[i], chars[i]) for i in range(len(tree.tag))]


def main_text(page: str | None) -> str:
    """The article's blocks, joined by newlines."""
    if not page:
        return ""
    tree = Tree(page)
    n = len(tree.tag)
    weight = [1.0] * n
    chars, links, commas, direct = _sums(tree)
    if any(tree.named):
        weight = drop_named(tree, _given(tree, chars, links, commas, direct))
        chars, links, commas, direct = _sums(tree)
    given = _given(tree, chars, links, commas, direct)
    # lists and the like that are mostly links are menus
    for i in range(1, n):
        if tree.dropped[tree.parent[i]]:
            tree.dropped[i] = True
        elif tree.tag[i] in ("ul", "ol", "table", "dl") and chars[i] and links[i] > 0.5 * chars[i]:
            tree.dropped[i] = True
    score = [0.0] * n
    for i in range(n):
        if tree.dropped[i] or not given[i]:
            continue
        points = given[i] * weight[i]
        level, at = 0, tree.parent[i] if tree.tag[i] in ("p", "pre", "blockquote", "td", "li", "dd") else i
        while at >= 0 and level < 5:
            score[at] += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            at, level = tree.parent[at], level + 1
    for i in range(n):
        score[i] *= 1 - min(1, links[i] / max(chars[i], 1))
    best = max(range(n), key=lambda i: (score[i], i))
    if not score[best]:
        best = next((i for tag in ("article", "main") for i in range(n) if tree.tag[i] == tag and not tree.dropped[i] and chars[i]), 0)
    around = best
    while around > 0 and tree.tag[around] != "article":
        around = tree.parent[around]
    kept = [best]
    if around > 0:
        kept = [around]
    elif best > 0:
        p = tree.parent[best]
        kept = [i for i in range(p + 1, tree.end[p]) if tree.parent[i] == p and not tree.dropped[i] and (
            i == best or score[i] >= max(10, 0.2 * score[best]) or tree.tag[i] in ("h1", "h2") and chars[i]
            or tree.tag[i] == "p" and chars[i] > 80 and links[i] < 0.25 * chars[i])]
    blocks: dict[int, list[str]] = {}
    for element, block, text in tree.items:
        if not tree.dropped[element] and any(k <= element < tree.end[k] for k in kept):
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(line for line in lines if line)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: ``page_id``, ``url``, ``text`` and ``n_chars`` (its code points)."""
    picked = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [main_text(page) for page in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return picked.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
