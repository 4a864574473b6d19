"""Main text of web pages by composite text density.

1. A page becomes a tree of elements by the usual rules of unclosed tags; scripts,
   styles, comments and markup are no text. Subtrees that by tag, role or name are page
   furniture (menus, headers, footers, sidebars, notices, adverts, forms, reader
   comments) or hidden count as empty, so that a long comment thread wins nothing.
2. With C characters, T tags, LC link characters and LT link tags below a node, and b
   the body, the density of a node is its characters per tag, adjusted for links:
       C/T * log(C/LC * T/LT) / log(ln(C/(C-LC) * LC + LCb/Cb * C + e))
   (the last logarithm counts as 1 where it is less, or short texts would win).
   A node's sum is that of its children's densities (its own text counts as a child).
3. The subtree of the largest sum is the main text's core. The least density on its way
   up to the body is the threshold: of every node that reaches it, the subtree of the
   largest sum belongs to the text too. If the core lies in an article or main element,
   all of that is the text. Blocks of links alone are left out.
4. References are decoded, white space inside a block becomes one space, blocks are
   joined by a line feed. Pages are independent: one map, no shuffle, whole pages.

Defined cases: a null, empty or text-free page gives an empty text; plain text without
tags is one block; truncated tags, comments, scripts and references end with the page;
unknown end tags are ignored; repeated rows and null ids are kept as they are, ties go
to the first node; other columns are ignored; an empty table gives an empty result.
Work is linear in a page's length; elements below the depth of 400 join that depth."""

from __future__ import annotations

import math
import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_columns, ship

DEEPEST = 400
# elements by their part in HTML: fixed values of the standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
HEAD_ONLY = frozenset("title meta link base style script noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: start tag: open elements that it ends, and those beyond which it doesn't look
ENDS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
        "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead"), ("table",)),
        "option": (("option",), ("select",))}
CELLS = frozenset("td th table caption button object body html".split())
#: blocks that are text by themselves where no density speaks against them
TEXT_BLOCKS = HEADINGS | frozenset("p pre blockquote ul ol dl table figure hgroup li dt dd".split())
MAIN = frozenset(("article", "main"))

# what page furniture is called
DROP_TAGS = frozenset("nav aside footer form button select textarea script style noscript template iframe object svg "
                      "canvas dialog menu head input label audio video map noembed noframes xmp title".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
                       "toolbar tablist".split())
DROP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promos promotion "
    "comment comments reply replies respond disqus discussion cookie cookies consent gdpr newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations breadcrumb breadcrumbs "
    "pagination pager popup modal navbar navigation nav footer copyright paywall feedback".split())
#: names that also stand in those of the element around the text, with words such as FRAME's
WEAK_NAMES = frozenset("sidebar menu header masthead banner notice notices alert widget widgets toolbar overlay aside topbar "
                       "submenu disclaimer skip form search tags".split())
FRAME = frozenset("content main wrapper wrap container layout page with has no article post entry story body root app "
                  "site left right".split())

_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"""[^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+>""")
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden|itemprop)(?=[\s=/]|$)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
                   re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in RAW}


class Page:
    """Elements in document order with their parents, and texts with the element that holds them."""

    def __init__(self, html: str):
        self.tag, self.parent, self.drop, self.main = ["html"], [-1], [False], [False]
        self.texts: list[tuple[int, str, int]] = []  # element, text, edges of blocks before it
        self.edges = 0
        self.weak: list[int] = []
        self.stack = [0]
        self.parse(html)

    def start(self, tag: str, attrs: str) -> None:
        stack, names = self.stack, self.tag
        if tag == "html":
            return
        if tag not in HEAD_ONLY and len(stack) > 1 and names[stack[1]] == "head":
            del stack[1:]
        if tag == "body" and any(names[i] == "body" for i in stack):
            return
        if tag in BLOCK:
            self.edges += 1
            self.close(("p",), CELLS)
            if tag in HEADINGS and names[stack[-1]] in HEADINGS:
                stack.pop()
        if tag in ENDS:
            self.close(*ENDS[tag])
        if tag == "br":
            self.texts.append((stack[-1], " ", self.edges))
        self.tag.append(tag)
        self.parent.append(stack[-1])
        drop, weak, main = furniture(tag, attrs)
        if weak:
            self.weak.append(len(self.drop))
        self.drop.append(drop)
        self.main.append(main)
        if tag not in VOID and len(stack) < DEEPEST:
            stack.append(len(self.tag) - 1)

    def close(self, tags: tuple, limits) -> bool:
        """Pop up to the nearest open element of `tags`, unless one of `limits` comes first."""
        names = self.tag
        for at in range(len(self.stack) - 1, 0, -1):
            name = names[self.stack[at]]
            if name in tags:
                del self.stack[at:]
                return True
            if name in limits:
                return False
        return False

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag in BLOCK:
            self.edges += 1
        if tag in HEADINGS:
            self.close(tuple(HEADINGS), ())
        elif tag in BLOCK:
            self.close((tag,), () if tag in ("table", "article", "main", "section", "body", "div") else ("table",))
        else:
            self.close((tag,), BLOCK)

    def text(self, raw: str) -> None:
        if raw and not raw.isspace():
            stack = self.stack
            if len(stack) > 1 and self.tag[stack[1]] == "head":
                del stack[1:]
        if raw:
            self.texts.append((self.stack[-1], unescape(raw) if "&" in raw else raw, self.edges))

    def parse(self, html: str) -> None:
        at, size, quoted = 0, len(html), True
        while at < size:
            m = _OPEN.search(html, at)
            if not m:
                self.text(html[at:])
                return
            low = m.start()
            self.text(html[at:low])
            if html.startswith("<!--", low):
                at = html.find("-->", low + 2)
                if at < 0:
                    return
                at += 3
                continue
            name = _NAME.match(html, low)
            if not name:  # a declaration, or an end tag without a name
                at = html.find(">", low)
                if at < 0:
                    return
                at += 1
                continue
            stop = _QUOTED.match(html, name.end()) if quoted else None
            if stop:
                at = stop.end()
            else:  # a quote that never closes: from here on tags end at their first `>`
                quoted = False
                at = html.find(">", name.end()) + 1
                if not at:
                    return
            tag = name.group(1).lower()
            if html[low + 1] == "/":
                self.end(tag)
                continue
            attrs = html[name.end():at - 1]
            self.start(tag, attrs)
            if tag in RAW:
                if self.stack[-1] == len(self.tag) - 1:
                    self.stack.pop()
                m = _RAW_END[tag].search(html, at)
                if not m:
                    return
                at = html.find(">", m.end()) + 1
                if not at:
                    return


def furniture(tag: str, attrs: str) -> tuple[bool, bool, bool]:
    """Whether an element is left out, whether by a weak name only, and whether it holds an article."""
    main = tag in MAIN
    if tag in DROP_TAGS:
        return True, False, main
    weak = tag == "header"
    drop = weak
    if attrs:
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                drop, weak = True, False
            elif name == "role":
                if value.lower() in DROP_ROLES:
                    drop, weak = True, False
                main |= value.lower() in MAIN
            elif name == "itemprop":
                main |= value.lower() == "articlebody"
            elif name == "style":
                if _HIDING.search(value):
                    drop, weak = True, False
            elif tag not in ("body", "html"):
                for part in value.split():
                    words = {w.lower() for w in _WORDS.findall(part)}
                    if not DROP_NAMES.isdisjoint(words):
                        drop, weak = True, False
                    elif not WEAK_NAMES.isdisjoint(words) and FRAME.isdisjoint(words) and not drop:
                        drop, weak = True, True
    return drop, weak, main


def main_text(html: str | None) -> str:
    """The blocks of a page's main text, joined by line feeds."""
    if not html:
        return ""
    page = Page(html)
    n, tag, parent = len(page.tag), page.tag, page.parent
    # an element by weak name that holds an article, and headings of an article's header, stay
    holds = [False] * n
    for i in range(n - 1, 0, -1):
        if holds[i] or page.main[i] and not page.drop[i]:
            holds[parent[i]] = True
    drop, in_main = page.drop, [0] * n
    for i in page.weak:
        if holds[i]:
            drop[i] = False
    header = [False] * n
    for i in range(1, n):
        up = parent[i]
        in_main[i] = i if page.main[i] and not drop[i] and not in_main[up] else in_main[up]
        if drop[up]:
            header[i] = header[up]
            drop[i] = not (header[up] and (tag[i] in HEADINGS or tag[i] == "hgroup"))
        elif drop[i] and tag[i] == "header" and in_main[up]:
            header[i] = True
    # counts of what is left
    chars, tags, link_chars, links, own = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = tag[i] == "a" or in_link[parent[i]]
    for i, t, _ in page.texts:
        if not drop[i]:
            size = len("".join(t.split()))
            own[i] += size
            chars[i] += size
            if in_link[i]:
                link_chars[i] += size
    if not any(own):
        return ""
    for i in range(n - 1, 0, -1):
        if not drop[i]:
            up = parent[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + 1
            links[up] += links[i] + (tag[i] == "a")
    density = densities(chars, tags, link_chars, links)
    lone = [i if l else 0 for i, l in zip(own, in_link)]  # an element's own text as a child of one tag
    total = densities(own, [1] * n, lone, [1] * n, link_chars[0] / chars[0])
    for i in range(1, n):
        if not drop[i]:
            total[parent[i]] += density[i]
    take = chosen(page, total, density, chars, in_main)
    return "\n".join(blocks(page, take, chars, link_chars, links))


def densities(chars: list[int], tags: list[int], link_chars: list[int], links: list[int],
              share: float | None = None) -> list[float]:
    """Composite text density by element; `share`: link characters of all, those of the first element if None."""
    share = link_chars[0] / max(chars[0], 1) if share is None else share
    out = []
    for c, t, lc, lt in zip(chars, tags, link_chars, links):
        if not c:
            out.append(0.0)
            continue
        t, lt = max(t, 1), max(lt, 1)
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        out.append(c / t * math.log(c / max(lc, 1) * t / lt) / max(math.log(base), 1.0))
    return out


def chosen(page: Page, total: list[float], density: list[float], chars: list[int], in_main: list[int]) -> list[bool]:
    """By element: whether it is a root of the main text (its subtree is text)."""
    n, parent = len(total), page.parent
    # an article that holds a quarter of what is left is where to look
    outer = sorted({m for m in in_main if m})
    near = 0
    if len(outer) == 1 and 4 * chars[outer[0]] >= chars[0]:
        near = outer[0]
    # the element of the largest sum below each; among equals the first, and a child before its parent
    best = list(range(n))
    for i in range(n - 1, 0, -1):
        up = parent[i]
        if not page.drop[i] and chars[i] and total[best[i]] >= total[best[up]]:
            best[up] = best[i]
    core = i = best[near]
    threshold = density[core]
    while i > 0:
        i = parent[i]
        threshold = min(threshold, density[i])
    take = [False] * n
    if in_main[core]:
        take[in_main[core]] = True
        return take
    for i in range(n):
        if density[i] >= threshold and chars[i] and not page.drop[i]:
            take[best[i]] = True
    return take


def blocks(page: Page, take: list[bool], chars: list[int], link_chars: list[int], links: list[int]) -> list[str]:
    """Texts of the chosen subtrees, and of plain text blocks between them, by block in page order."""
    n, tag, parent = len(page.tag), page.tag, page.parent
    holds = take[:]
    for i in range(n - 1, 0, -1):
        if holds[i]:
            holds[parent[i]] = True
    # below the lowest element that holds all chosen ones, text blocks between them belong to the text
    inside, keep = [False] * n, [False] * n
    branches = [0] * n
    for i in range(1, n):
        branches[parent[i]] += holds[i]
    top = 0
    while not take[top] and branches[top] == 1:
        top = next(i for i in range(top + 1, n) if parent[i] == top and holds[i])
    for i in range(n):
        up = parent[i]
        while not page.drop[i] and up > 0 and page.drop[up]:  # a heading in an article's header
            up = parent[up]
        menu = (tag[i] in BLOCK and tag[i] not in ("p", "li") and tag[i] not in HEADINGS and links[i] > 1
                and link_chars[i] > 0.9 * chars[i])
        if page.drop[i] or menu and not holds[i]:
            continue
        above = i > 0 and keep[up]
        keep[i] = above or take[i]
        inside[i] = i == top or i > 0 and inside[up]
        if not keep[i] and inside[i] and i != top and not holds[i]:
            keep[i] = tag[i] in TEXT_BLOCKS and 2 * link_chars[i] <= chars[i]
    out, parts, edge = [], [], -1
    for i, t, edges in [*page.texts, (0, "", -2)]:
        if edges != edge:
            words = "".join(parts).split()
            if words:
                out.append(" ".join(words))
            parts, edge = [], edges
        if keep[i] or i and holds[i] and inside[i] and not page.drop[i]:
            parts.append(t)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    ship(pages.sparkSession)

    def run(cols: dict) -> dict:
        text = [main_text(h) for h in cols["html"]]
        return {"page_id": cols["page_id"], "url": cols["url"], "text": text, "n_chars": [len(t) for t in text]}

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.col("html").cast("string").alias("html"))
    return map_columns(src, run, "page_id long, url string, text string, n_chars long", text="html")
