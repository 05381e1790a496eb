"""Main text of web pages by composite text density.

Every page becomes a tree of its elements.  A node's density is its characters per
tag, adjusted for links: with C characters, T tags, LC characters and LT tags in
links below it (zeros count as 1, N = C - LC), and the share s = LC / C of the
whole body,

    density = C / T * log(C / LC * T / LT) / log(log(C / N * LC + s * C + e)).

(Where the body has no link characters the adjustment has base 1 and is left out.)
A container is a node with a block below it; the container whose children's densities
have the largest sum is the core of the article.  The least density on the path from
it up to the body is the threshold: other containers that reach it belong to
the article as well, each with its largest-sum subtree.  An ``article`` or ``main`` element around the
core is taken whole, and ``h1`` headings beside the core's path belong to it.

Never part of the text: page furniture (menus, headers, footers, sidebars, notices, adverts,
forms, reader comments), known by element, ARIA role, or a class or id made of such a
word; scripts, styles, hidden elements and mark-up comments.

Defined results: null html counts as empty; a page without text gives '' and 0; text without any
element is one block; repeated rows give repeated rows; null ids stay; an empty table
gives no rows; extra columns are ignored.  Unclosed elements end where HTML's rules
for ``p``, ``li``, table and option elements say, or with their parent; stray end tags are
ignored; an unclosed script, style or mark-up comment runs to the page's end.
White space is Unicode's; ``br`` and table cells count as white space.
"""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame

from panora.llm.common import arrow_map

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is not mark-up
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: elements that stand in lines of their own
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search
    section summary table tbody td tfoot th thead title tr ul""".split())
CELLS = frozenset(("td", "th"))
#: start tags that end an open element of these kinds, up to a boundary
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
        "tbody": ({"tr", "td", "th", "tbody", "thead"}, {"table"}),
        "tfoot": ({"tr", "td", "th", "tbody", "thead"}, {"table"})}
#: elements that are never part of an article
FURNITURE = frozenset("""aside button canvas datalist dialog embed footer form head iframe input menu nav noembed
    noframes noscript object optgroup option script search select style svg template textarea title xmp""".split())
ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
    toolbar""".split())
#: words that name furniture as the first, second or last word of a class or id
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion
    banner nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars rail footer header masthead topbar
    comment comments commentlist respond disqus reply replies cookie cookies consent gdpr notice notices notification
    notifications alert popup modal overlay newsletter subscribe subscription signup login register share sharing
    social related recommended recommendations widget widgets toolbar pagination pager copyright disclaimer
    skip""".split())
#: a name that begins with one of these keeps its header (the article's own title)
ARTICLE_NAMES = frozenset("article post entry story content main page".split())
#: words that turn the meaning of a name round
NEGATIONS = frozenset("has no with without is hide hidden in".split())
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: containers that are not taken away by their name
KEPT = frozenset(("html", "body", "main"))

TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)
                       ((?:[^>"']++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)>?""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), a or b or c)
    return out


def _furniture(tag: str, attrs: dict[str, str], inside_article: bool) -> bool:
    """Whether an element is taken away with all it holds."""
    if tag in FURNITURE:
        return True
    if tag == "header" and not inside_article:
        return True
    if not attrs or tag in KEPT:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return True
    if attrs.get("role", "").strip().lower() in ROLES:
        return True
    return any(_furniture_name(name) for name in (*attrs.get("class", "").split(), attrs.get("id", "")))


def _furniture_name(name: str) -> bool:
    words = [w.lower() for w in NAME_WORD.findall(name)]
    if not words or not NEGATIONS.isdisjoint(words):
        return False
    if words[0] in ARTICLE_NAMES:
        return not (NAMES - {"header"}).isdisjoint(words[1:])
    return not NAMES.isdisjoint((*words[:2], words[-1]))


class Page:
    """Elements in page order: parent, tag, whether taken away; text pieces with
    the element each belongs to."""

    def __init__(self, source: str):
        self.parent, self.tag, self.away = [-1], ["#page"], [False]
        self.pieces: list[tuple[int, str]] = []      # (element, its text or '' for its start or end)
        self._read(source)

    def _read(self, source: str) -> None:
        parent, tags, away, pieces = self.parent, self.tag, self.away, self.pieces
        stack: list[int] = [0]
        depths: dict[str, list[int]] = {}        # per tag the places of its open elements in the stack
        at, size = 0, len(source)

        def innermost(kinds) -> int:
            return max((d[-1] for k in kinds if (d := depths.get(k))), default=0)

        def end(kinds, stops=()) -> None:
            """End the innermost open element of ``kinds``, unless a stop lies between."""
            depth = innermost(kinds)
            if depth and depth >= innermost(stops):
                for node in reversed(stack[depth:]):
                    depths[tags[node]].pop()
                    if tags[node] in BLOCKS:
                        pieces.append((node, ""))
                del stack[depth:]

        while at < size:
            start = source.find("<", at)
            found = TOKEN.match(source, start) if start >= 0 else None
            to = size if start < 0 else start if found else start + 1
            if to > at:
                pieces.append((stack[-1], source[at:to]))
            at = to
            if not found:
                continue
            at = max(found.end(), to + 1)
            closing, name, rest = found.groups()
            if name is None:
                continue
            name = name.lower()
            if closing:
                end((name,))
                continue
            if name in ("html", "body") and depths.get(name):
                continue
            if name in BLOCKS and name not in CELLS and depths.get("p"):
                end(("p",), ("button", "td", "th", "caption", "table"))
            if name in ENDS:
                end(*ENDS[name])
            node, up = len(tags), stack[-1]
            attrs = _attributes(rest) if rest and not rest.isspace() else {}
            parent.append(up)
            tags.append(name)
            away.append(away[up] or _furniture(name, attrs, bool(depths.get("article"))))
            if name in BLOCKS or name == "br":
                pieces.append((node, ""))
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = close.end() if close else size
            elif name not in VOID:
                depths.setdefault(name, []).append(len(stack))
                stack.append(node)


def _squeeze(text: str) -> str:
    return " ".join(text.split())


def densities(page: Page) -> tuple[list[float], list[float], list[bool], int]:
    """Per element its density, the sum of its children's, and whether it holds a
    block; and the body's number (0 where there is none)."""
    n = len(page.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    holds = [False] * n
    silent = frozenset(("script", "style", "head", "title", "template", "noscript"))
    for node, text in page.pieces:
        if text:
            chars[node] += len(_squeeze(text))
    body = 0
    for node in range(n - 1, 0, -1):
        if page.tag[node] == "body":
            body = node
    for node in range(n - 1, 0, -1):      # children come after their parent
        tag, up = page.tag[node], page.parent[node]
        if tag in silent:
            continue
        if tag == "a":
            links[node], link_tags[node] = chars[node], tags[node]
        chars[up] += chars[node]
        links[up] += links[node]
        tags[up] += tags[node] + 1
        link_tags[up] += link_tags[node] + (tag == "a")
        holds[up] = holds[up] or holds[node] or (tag in BLOCKS and tag != "hr")
    share = links[body] / chars[body] if chars[body] else 0.0
    density, total = [0.0] * n, [0.0] * n
    for node in range(n - 1, -1, -1):
        c = chars[node]
        if c:
            t, lc, lt = max(tags[node], 1), max(links[node], 1), max(link_tags[node], 1)
            value = c / t
            base = math.log(c / max(c - links[node], 1) * links[node] + share * c + math.e)
            if share and base > 1.0:
                value *= math.log(max(c / lc * t / lt, 1.0)) / math.log(base)
            density[node] = value
        if node and not page.away[node]:
            total[page.parent[node]] += density[node]
    return density, total, holds, body


def _chosen(page: Page) -> list[bool]:
    """Per element whether its text belongs to the article."""
    density, total, holds, body = densities(page)
    parent, away, n = page.parent, page.away, len(page.tag)
    inside = [False] * n             # in the body and not taken away
    inside[body] = True
    best = list(range(n))            # the largest-sum container at or below each container
    for node in range(n):
        if node > body and inside[parent[node]] and not away[node]:
            inside[node] = True
    for node in range(n - 1, body, -1):
        up = parent[node]
        if inside[node] and holds[node] and total[best[node]] >= total[best[up]]:
            best[up] = best[node]
    core = best[body]
    path = [core]
    while path[-1] != body:
        path.append(parent[path[-1]])
    threshold = min(density[node] for node in path)
    around = next((node for node in path if page.tag[node] == "article"),
                  next((node for node in path if page.tag[node] == "main"), core))
    onpath = set(path)
    chosen = [False] * n
    reaches = [False] * n            # containers at the threshold, with their ancestors
    for node in range(body, n):
        if not inside[node]:
            continue
        up = parent[node]
        reaches[node] = node == body or (reaches[up] and holds[node] and density[node] >= threshold) or node in onpath
        if reaches[node] and node != body and holds[node] and node not in onpath:
            chosen[best[node]] = True
        if page.tag[node] == "h1" and up in onpath:
            chosen[node] = True
    chosen[core] = chosen[around] = True
    for node in range(body + 1, n):
        chosen[node] = inside[node] and (chosen[node] or chosen[parent[node]])
    return chosen


def main_text(source: str | None) -> str:
    """The article's blocks in page order, one line each."""
    page = Page(source or "")
    chosen = _chosen(page)
    lines: list[str] = []
    open_: list[str] = []

    def close() -> None:
        text = "".join(open_)
        text = _squeeze(html.unescape(text) if "&" in text else text)
        if text:
            lines.append(text)
        open_.clear()

    for node, text in page.pieces:
        if text:
            if chosen[node]:
                open_.append(text)
        elif page.tag[node] == "br" or page.tag[node] in CELLS:
            open_.append(" ")
        else:
            close()
    close()
    return "\n".join(lines)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` rows as (page_id, url, text, n_chars): the main text of every page."""
    ids = [c for c in ("page_id", "url") if c in pages.columns]
    narrow = pages.select(*ids, pages[html_column].cast("string").alias("__html"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name in ids),
                        "text string", "n_chars long"])

    def run(batch):
        import pyarrow as pa

        texts = [main_text(h) for h in batch.column(len(ids)).to_pylist()]
        return pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(ids))], pa.array(texts, pa.string()),
                                           pa.array([len(t) for t in texts], pa.int64())],
                                          names=[*ids, "text", "n_chars"])
    return arrow_map(narrow, run, schema)
