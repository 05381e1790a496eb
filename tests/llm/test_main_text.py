"""Main text of pages: planted articles, the density formula by plain recursion,
odd pages, and the given pages against their article element."""

import html
import math
import random
import re
import time
from html.parser import HTMLParser

import pytest

from panora.llm.main_text import Page, densities, extract, main_text
from panora.llm.queries import op11_main_text
from tests.llm.helpers import folder, prose

FURNITURE = [
    "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>",
    "<div class='menu'><a href='/a'>First</a> <a href='/b'>Second</a></div>",
    "<header><a href='/'>Site</a><p>The best site there is, with a long motto.</p></header>",
    "<footer>&copy; 2020 a site. All rights reserved by the site and its many owners.</footer>",
    "<aside><p>Side story that is rather long and has many words in it.</p></aside>",
    "<div id='sidebar'><p>More side story, also with quite a few words.</p></div>",
    "<div class='cookie-notice'><p>We use many cookies, please accept all of them now.</p></div>",
    "<div class='ad'>Buy this very good thing now, it costs nearly nothing at all.</div>",
    "<form action='/s'><label>Search</label><input name=q><button>Go</button></form>",
    "<script>var x = '<p>not text</p>'; if (a < b) {}</script><style>p > a { color: red }</style>",
    "<section class='comments'><article class='comment'><p>What a nice article, I liked it a lot!</p></article></section>",
    "<div hidden><p>Hidden words of the page.</p></div><div style='display: none'>Also hidden.</div>",
    "<!-- a comment with <p>mark-up</p> -->", "<div role='navigation'><a href='/x'>Elsewhere</a></div>",
]


def planted(rng):
    lines = [prose(rng, rng.randint(3, 6))] + [prose(rng, rng.randint(5, 60)) for _ in range(rng.randint(1, 9))]
    marked = [f"<p>{line}" + rng.choice(["", "</p>"]) if rng.random() < 0.8 else
              f"<p>{' '.join(f'<a href=x>{w}</a>' if rng.random() < 0.05 else w for w in line.split())}</p>"
              for line in lines[1:]]
    head = f"<h1>{lines[0]}</h1>"
    body = rng.choice([lambda: f"<article>{head}{''.join(marked)}</article>",
                       lambda: f"<div class='post-content'>{head}{''.join(marked)}</div>",
                       lambda: f"<main><div>{head}<div>{''.join(marked)}</div></div></main>"])()
    around = rng.sample(FURNITURE, rng.randint(0, len(FURNITURE)))
    cut = rng.randint(0, len(around))
    return f"<!DOCTYPE html><html><head><title>{lines[0]}</title></head><body>" \
           f"{''.join(around[:cut])}{body}{''.join(around[cut:])}</body></html>", "\n".join(lines)


def test_planted_articles():
    rng = random.Random(1)
    for _ in range(400):
        page, article = planted(rng)
        assert main_text(page) == article, page


class Tree(HTMLParser):
    """Well-formed mark-up as nested [tag, children] lists."""

    def __init__(self):
        super().__init__()
        self.root = ["#page", []]
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = [tag, []]
        self.open[-1][1].append(node)
        if tag not in ("br", "img"):
            self.open.append(node)

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        self.open[-1][1].append(data)


def figures(node, linked=False):
    """(chars, link chars, tags, link tags) below a node."""
    linked = linked or node[0] == "a"
    out = [0, 0, 0, 0]
    for child in node[1]:
        if isinstance(child, str):
            n = len(" ".join(child.split()))
            out[0] += n
            out[1] += n * linked
        else:
            c = figures(child, linked)
            out = [a + b for a, b in zip(out, c)]
            out[2] += 1
            out[3] += child[0] == "a" or linked
    return out


def test_densities_by_plain_recursion():
    rng = random.Random(2)

    def part(depth):
        if depth == 0 or rng.random() < 0.2:
            return prose(rng, rng.randint(1, 8))
        tag = rng.choice(["div", "section", "a", "b", "ul", "span"])
        return f"<{tag}>" + "".join(part(depth - 1) for _ in range(rng.randint(0, 4))) + f"</{tag}>"

    for _ in range(60):
        source = f"<body>{part(4)}<div><a>{prose(rng, 4)}</a></div>{part(3)}</body>"
        page, tree = Page(source), Tree()
        tree.feed(source)
        density, total, _, body = densities(page)
        nodes = []

        def walk(node):
            nodes.append(node)
            for child in node[1]:
                if not isinstance(child, str):
                    walk(child)
        walk(tree.root)
        assert [n[0] for n in nodes] == page.tag and page.tag[body] == "body"
        c0, l0, _, _ = figures(nodes[body])
        want = []
        for node in nodes:
            c, lc, t, lt = figures(node)
            if not c:
                want.append(0.0)
                continue
            base = math.log(c / max(c - lc, 1) * lc + l0 / c0 * c + math.e)
            want.append(c / max(t, 1) * math.log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1)) / math.log(base))
        assert density == pytest.approx(want)
        for node, value in zip(nodes, total):
            children = [want[next(i for i, x in enumerate(nodes) if x is ch)] for ch in node[1] if not isinstance(ch, str)]
            assert value == pytest.approx(sum(children))


def test_blocks_and_characters():
    assert main_text("<body><p>a &amp; b&nbsp;c\n d<br>e</p><div>f<b>g</b> h<p>i</p>j</div></body>") == "a & b c d e\nfg h\ni\nj"
    assert main_text("<table><tr><td>1<td>2<tr><th>3</table><ul><li>x<li>y<ul><li>z</ul></ul>") == "1 2\n3\nx\ny\nz"
    assert main_text("1 &lt;b&gt; 2 &#x41;&#65; &unknown; &amp") == "1 <b> 2 AA &unknown; &"
    assert main_text("<p>x</div></p></b>y <Z") == "x\ny"
    assert main_text(None) == main_text("") == main_text("<html></html>") == main_text("<!-- x") == ""
    assert main_text("<script>a") == main_text("<p title='") == ""


def test_two_parts_beside_each_other():
    page = ("<body><div><a href=1>One</a> <a href=2>Two</a></div><div><h1>Title of both</h1></div>"
            "<div><h2>First</h2><p>The first part is long enough to be text.</p><p>And it goes on for a while.</p></div>"
            "<div><h2>Second</h2><p>The second part is also long enough to be text.</p></div></body>")
    text = main_text(page).split("\n")
    assert text[-5:] == ["First", "The first part is long enough to be text.", "And it goes on for a while.", "Second",
                         "The second part is also long enough to be text."]
    assert "One Two" not in text


@pytest.mark.parametrize("page", ["<div>" * 60_000 + "x", "<p><b>" * 30_000 + "x", "<" * 200_000 + "x",
                                  "<!--" * 100_000, "<div class='" * 20_000, '<a href="' + "x" * 500_000,
                                  "<p><button><i>" + "<i>" * 20_000 + "<div>x</div>" * 20_000,
                                  "<li class='" + "ad_" * 50_000 + "'>x", "<p>" + "w " * 1_000_000])
def test_long_pages_take_linear_time(page):
    start = time.time()
    main_text(page)
    assert time.time() - start < 20


def test_tables(spark, tmp_path):
    rng = random.Random(6)
    pages = [planted(rng) for _ in range(30)]
    rows = [(i, f"http://x/{i}", page, "t", 5) for i, (page, _) in enumerate(pages)]
    rows += [(None, None, None, None, None), (7, "u", "", "t", 1)] + rows[:3] * 2
    schema = "page_id long, url string, html string, text string, n_chars long"
    out = op11_main_text(spark, folder(tmp_path, pages=spark.createDataFrame(rows, schema)))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    texts = dict((f"http://x/{i}", t) for i, (_, t) in enumerate(pages))
    want = sorted(((r[0], r[1], texts.get(r[1], ""), len(texts.get(r[1], ""))) for r in rows), key=repr)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert extract(spark.createDataFrame([], schema)).count() == 0


def test_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = {r.page_id: r.text for r in op11_main_text(spark, "/root/testdata/sf0.001").collect()}
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)
