"""Main text of small pages of many makes, and of every page of the table by its known frame."""

import html
import math
import random
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from lendsight.llm import catalog, html_text
from lendsight.llm.html_text import extract_text, main_text

LONG = "Quite a long sentence with a good number of words in it, as articles have. " * 3
BODY = f"<h1>Title</h1><p>{LONG}</p><p>Second &amp; last,   {LONG}</p>"
TEXT = "\n".join(["Title", LONG.strip(), "Second & last, " + LONG.strip()])


@pytest.mark.parametrize("page", [
    f"<html><head><title>x</title></head><body><nav><a href=a>A</a></nav><article>{BODY}</article><footer>f</footer></body></html>",
    f"<body><div id=top-menu><ul><li><a href=1>One</a></ul></div><div class='post'>{BODY}</div><div class=comments><p>{LONG}</p></div></body>",
    f"<body><header><h2>Site</h2></header><main>{BODY}<aside>{LONG}</aside><form><p>{LONG}</p></form></main>",
    f"<body><article>{BODY}<section id='comments'><p>{LONG}</p></section></article><div class=cookie-notice>{LONG}</div>",
    f"<body><div class='content with sidebar'><article>{BODY}</article></div><div class='sidebar'><p>{LONG}</p></div>",
    f"<body><div><div>{BODY}</div><script>if (a < b) document.write('<p>{LONG}</p>')</script><style>p{{}}</style></div>",
    f"<BODY><ARTICLE>{BODY}<!-- <p>{LONG}</p> --></ARTICLE>",
    f"<body><article><header>{BODY}</header></article>".replace("<header><h1>Title</h1>", "<header><h1>Title</h1></header>").replace("</header></article>", "</article>"),
    f"<body><article>{BODY}<div style='display: none'>{LONG}</div><div hidden>{LONG}</div></article>",
])
def test_only_the_article(page):
    assert main_text(page) == TEXT


def test_unclosed_tags_and_entities():
    page = "<body><article><h1>A&nbsp;b</h1><p><b>One<br><p>Two &lt;x&gt; &#233;<ul><li>i<li>j</ul></article>"
    assert main_text(page) == "A b\nOne\nTwo <x> é\ni\nj"


def test_odd_input():
    assert main_text(None) == "" and main_text("") == "" and main_text("  \n ") == ""
    assert main_text("just text") == "just text" and main_text("<p>a < b & c</p>") == "a < b & c"
    assert main_text("<body><p title=\"no end>text") is not None
    assert main_text("<" * 5000) is not None and main_text("<div>" * 5000 + "x") == "x"
    assert main_text("<nav><a href=x>only menu</a></nav>") == ""


def test_long_pages_are_whole():
    page = "<body><article>" + "".join(f"<p>Paragraph {i} of many words here</p>" for i in range(20_000)) + "</article>"
    assert len(main_text(page).split("\n")) == 20_000


def test_column(documents, nothing):
    pages = documents.select(F.concat(F.lit("<article><p>"), "text", F.lit("</p></article>")).alias("html"))
    assert pages.select(extract_text(F.col("html")).alias("t")).filter("t is null").count() == 0
    assert nothing.select(extract_text(F.col("text"))).count() == 0


def _framed(page):
    inside = page.split("<article>")[1].split("</article>")[0]
    blocks = (" ".join(html.unescape(re.sub("</?(?:b|br)>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inside))
    return "\n".join(x for x in blocks if x)


def test_query_over_pages(spark, data):
    given = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    rows = catalog.QUERIES["op7_main_text"](spark, data).collect()
    assert len(rows) == len(given)
    assert all(r.text == _framed(given[r.page_id]) and r.n_chars == len(r.text) for r in rows if "<article>" in given[r.page_id])


@pytest.mark.parametrize("tag", ["form", "fieldset", "dialog", "label"])
def test_a_wrapper_of_the_article_is_kept(tag):
    inner = f"<nav><a href='/'>Home</a></nav><div>{BODY}</div><form><p>Search here</p></form>"
    plain = main_text(f"<body>{inner}</body>")
    assert plain and main_text(f"<body><{tag}>{inner}</{tag}></body>") == plain
    assert main_text(f"<body><{tag}><main>{BODY}</main></{tag}><p>Bye</p></body>") == main_text(f"<body><main>{BODY}</main></body>")


def test_a_closed_picture_swallows_nothing():
    for empty in ("<svg width='8' viewBox=\"0 0 8 8\"/>", "<math/>", "<SVG />"):
        assert main_text(f"<body>{empty}<main>{BODY}</main></body>") == main_text(f"<body><main>{BODY}</main></body>")
    assert "zzz" not in main_text(f"<body><svg><text>zzz</text></svg><main>{BODY}</main></body>")


@pytest.mark.parametrize("wrap", ["class='overflow-hidden'", "class='content has-sidebar'", "class=elementor-widget-container", "id=rail-transport"])
def test_a_name_alone_loses_no_article(wrap):
    menu = "<div class=menu><a href=1>One</a> <a href=2>Two</a></div>"
    assert main_text(f"<body>{menu}<div {wrap}>{BODY}</div></body>") == TEXT
    assert main_text(f"<body><article><div class='widget text'>{BODY}</div></article></body>") == TEXT
    science = f"<body><main>{BODY}<p class=social-science>{LONG}</p></main></body>"
    assert main_text(science) == f"{TEXT}\n{LONG.strip()}"


def test_a_short_article_beside_a_longer_advert():
    assert main_text(f"<body><div class=ad>{LONG}\n{LONG}</div><article><h1>Tiny</h1><p><b>Tiny.<br></article></body>") == "Tiny\nTiny."


def test_reader_comments_are_left_out():
    comments = "".join(f"<article class=comment><p>{LONG}</p></article>" for _ in range(6))
    for frame in ("<body><article>{}</article>{}</body>", "<body><main>{}{}</main></body>", "<body><div class=post>{}</div>{}</body>"):
        assert main_text(frame.format(BODY, f"<section id=comments>{comments}</section>")) == TEXT


def test_formulas_and_pages_within_noscript():
    assert main_text(f"<body><main>{BODY}<p>As <math><mi>x</mi><mo>=</mo><mn>2</mn></math> says.</p></main></body>").endswith("\nAs x=2 says.")
    assert main_text(f"<body><script>load()</script><noscript><article>{BODY}</article></noscript></body>") == TEXT


def test_stray_end_tags_take_linear_time():
    page = "<div>" * 20_000 + "</span>" * 20_000 + "<header>" * 3_000 + "x"
    begin = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - begin < 5


class _Tree(HTMLParser):
    """Well-formed markup as nested lists [tag, pieces]; every element is closed."""

    def __init__(self, page):
        super().__init__()
        self.root = ["#page", []]
        self.open = [self.root]
        self.order = [self.root]
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        node = [tag, []]
        self.order.append(node)
        self.open[-1][1].append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        self.open[-1][1].append(data.strip())


def _counts(node, linked=False):
    linked = linked or node[0] == "a"
    found = [0, 0, 0, 0]
    for piece in node[1]:
        if isinstance(piece, str):
            found[0] += len(piece)
            found[2] += len(piece) * linked
        else:
            below = _counts(piece, linked)
            found = [x + y for x, y in zip(found, (below[0], below[1] + 1, below[2], below[3] + (piece[0] == "a")), strict=True)]
    return found


def _place(nodes, node):
    return next(i for i, other in enumerate(nodes) if other is node)


def _random_page(rng, depth=0):
    parts = []
    for _ in range(rng.randint(1, 4)):
        tag = rng.choice(["div", "section", "p", "ul", "a", "span", "b"])
        words = " ".join(rng.choice(["one", "two", "three", "four"]) for _ in range(rng.choice([0, 1, 5, 40])))
        deeper = "" if depth > 3 or tag in ("p", "a") or rng.random() < 0.4 else _random_page(rng, depth + 1)
        parts.append(f"<{tag}>{words}{deeper}</{tag}>")
    return "".join(parts)


@pytest.mark.parametrize("seed", range(25))
def test_densities_and_core_like_a_plain_recursion(seed):
    text = f"<body>{_random_page(random.Random(seed))}</body>"
    tree = _Tree(text)
    linked = {}

    def mark(node, inside):
        linked[id(node)] = inside
        for piece in node[1]:
            if isinstance(piece, list):
                mark(piece, inside or node[0] == "a")

    mark(tree.root, False)
    whole = _counts(tree.root)
    share = whole[2] / max(whole[0], 1)
    density = []
    for node in tree.order:
        c, t, lc, lt = _counts(node, linked[id(node)])
        if not c:
            density.append(0.0)
            continue
        t, links = max(t, 1), max(lc, 1)
        base = math.log(c / max(c - lc, 1) * links + share * c + math.e)
        density.append(c / t * math.log(max(c / links * t / max(lt, 1), 1.0), base))
    sums = [sum(density[_place(tree.order, x)] for x in node[1] if isinstance(x, list)) for node in tree.order]
    page = html_text.Page(text)
    size = len(page.tag)
    assert page.tag == [node[0] for node in tree.order]
    got = html_text._densities(page, [False] * size, [1.0] * size)
    assert got[0] == pytest.approx(density) and got[1] == pytest.approx(sums)
    best = max(sums)
    assert sums[html_text._core(page, *got)] == pytest.approx(best)
