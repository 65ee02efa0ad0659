import random
from html import escape
from html.parser import HTMLParser

import numpy as np
import pytest

from seqloom.llm import pages

TREE = pages.Tree(*pages.labelled())


class Plain(HTMLParser):
    """Text of the article by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.deep, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.deep += tag == "article"
        if tag != "b":
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.deep -= tag == "article"
        if tag != "b":
            self.out.append(" ")

    def handle_data(self, data):
        if self.deep:
            self.out.append(data)


def test_tree_learns_its_table():
    rows, labels = pages.labelled()
    assert len(labels) < 200 and [TREE.score(r) > 0.5 for r in rows] == [bool(x) for x in labels]


def test_tree_takes_the_best_split():
    rng = np.random.default_rng(3)
    for _ in range(20):
        rows, labels = rng.integers(0, 6, (30, 3)).astype(float), rng.integers(0, 2, 30)
        tree = pages.Tree(rows, labels, depth=1)
        gini = lambda y: len(y) * 2 * y.mean() * (1 - y.mean()) if len(y) else 0.0
        want = min([gini(labels)] + [gini(labels[rows[:, f] <= b]) + gini(labels[rows[:, f] > b]) for f in range(3) for b in range(6)])
        got = gini(labels) if tree.feature < 0 else gini(labels[rows[:, tree.feature] <= tree.bound]) + gini(labels[rows[:, tree.feature] > tree.bound])
        assert got == pytest.approx(want)


def test_given_pages(spark):
    html = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in pages.query(html).collect()}
    given = html.collect()
    assert len(got) == len(given)
    for r in given:
        p = Plain()
        p.feed(r.html)
        assert got[r.page_id].text == " ".join("".join(p.out).split()) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def words(rng, n):
    return " ".join(rng.choice(["tide", "& sons", "a < b", "naïve", "x", "river", "“so”", "and", "the", "1"]) for _ in range(n))


def furniture(rng):
    link = lambda n: f'<a href="/x?a=1&b=2" title="a>b">{escape(words(rng, n))}</a>'
    return rng.choice([
        f"<nav><ul><li>{link(2)}<li>{link(1)}</ul></nav>", f'<aside id=right><h3>{link(3)}</h3><p>{escape(words(rng, 50))}</p></aside>', f'<div class="sideBar left">{escape(words(rng, 30))}</div>',
        f'<div class="cookie-notice"><p>{escape(words(rng, 40))}</p><button>OK</button></div>', f'<section id="comments"><article class="comment"><p>{escape(words(rng, 60))}</p></article></section>',
        f'<form action="/go"><label>{words(rng, 2).replace("<", "")}</label><select><option>one<option>two</select><input value="a>b"></form>', f'<div class=ad><p>{escape(words(rng, 25))}</div>',
        f'<div role="navigation">{link(4)}</div>', "<script>if (a<b) document.write('<p>no</p>')</script>", "<style>p > a{}</style>", "<!-- <p>no</p> -->", "<noscript>Switch it on</noscript>",
        f'<ul class="share_buttons social"><li>{link(1)}</li></ul>', "<svg><text>no</text></svg>", "<textarea><p>no</p></textarea>", "<template><p>no</p></template>",
    ])


@pytest.mark.parametrize("seed", range(30))
def test_marked_pages(seed):
    """Pages with an article, or a main part, among furniture; some furniture inside of it, tags left open."""
    rng = random.Random(seed)
    main, want = [], []
    heading = words(rng, 4)
    main.append(rng.choice(["<header><h1>{}</h1></header>", "<h1>{}</h1>", "<h2>{}"]).format(escape(heading)))
    want.append(heading)
    for _ in range(rng.randrange(1, 12)):
        text = words(rng, rng.choice([1, 2, 5, 40, 90]))
        main.append(rng.choice(["<p>{}</p>", "<p><b>{}</b><br>", "<ul><li>{}</ul>", "<blockquote>{}</blockquote>", "<p><a href=/y>{}</a></p>", "<table><tr><td>{}</table>", "<pre>{}</pre>", "<p>\n {}\t</p>"]).format(escape(text)))
        want.append(text)
        if rng.random() < 0.3:
            main.append(furniture(rng))
    around = [furniture(rng) for _ in range(6)]
    begin, end = rng.choice([("<article>", "</article>"), ("<main>", "</main>"), ('<main><p class="x">', "</main>"), ('<div itemprop="articleBody">', "</div>"), ('<article class="post has-sidebar">', "</article>")])
    page = f"<!DOCTYPE html><html class='no-js menu'><head><title>No {escape(words(rng, 3))}</title></head><body class='has-sidebar menu'><header><p>Site name</p></header>{''.join(around[:3])}{begin}{''.join(main)}{end}{''.join(around[3:])}<footer>&copy; 2020</footer>" + rng.choice(["</body></html>", "", "<div", "<!-- open"])
    assert pages.main_text(page, TREE) == " ".join(" ".join(want).split())


def test_pages_without_marks():
    """Word counts and link densities of a block and its neighbours decide where nothing is marked."""
    for seed in range(20):
        rng = random.Random(seed)
        menu = "".join(f"<div><a href=/{k}>Item {k}</a></div>" for k in range(5))
        title, paragraphs = "river tide notes", [" ".join(["tide"] * rng.randrange(20, 120)) for _ in range(6)]
        page = f"<body>{menu}<h1>{title}</h1>{''.join(f'<p>{p}' for p in paragraphs)}</p>{menu}<div>All <a>terms</a> <a>apply</a></div>"
        assert pages.main_text(page, TREE) == " ".join([title, *paragraphs])


@pytest.mark.parametrize("html, want", [
    ("<article>a&amp;b &lt;p&gt; &#x41;&#66;&nbsp;&eacute;&copy x &unknown; &#0; &am</article>", "a&b <p> AB é© x &unknown; � &am"), ("<article>a<b>b</b>c<br>d<span> e</span></article>", "abc d e"),
    ("<article>1 < 2 <3 > 2</article>", "1 < 2 <3 > 2"), ("<ARTICLE><P>One<P>Two</ARTICLE>", "One Two"), ("", ""), (None, ""), ("   ", ""), ("<article></article>", ""), ("<article><p>open <a href='x", "open"),
    ("<article><p>one</p></nav></div><p>two</p></article>", "one two"), ("<article><p>x</p><script>never ends", "x"), ("<article>x<!-->y<!-- z --!>w</article>", "xyw"),
    ('<div class="menu"><p>No no no</p></div><article><p class="advert">no</p><p>yes</p><li class=menu>no<li>yes</article>', "yes yes"), ("<article><p>😀 x</p></article>".encode("utf-16", "surrogatepass").decode("utf-16"), "😀 x"),
])
def test_cases(html, want):
    assert pages.main_text(html, TREE) == want


def test_long_pages_take_linear_time():
    for piece in ("<p>word ", "<a '", "<div class=x>", "</x>", "<", "&", "<!--", "<li>", '<a b="'):
        pages.main_text("<article>" + piece * 60_000, TREE)
    text = "<p>tide and river</p>" * 100_000
    assert pages.main_text(f"<article>{text}</article>", TREE) == " ".join(["tide and river"] * 100_000)


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars long, words int"
    rows = [(1, "u", "<article>a b</article>", "no", 9, 1), (1, "u", "<article>a b</article>", "no", 9, 1), (None, None, None, None, None, None), (2, None, "", "x", 1, 1)]
    got = sorted(map(tuple, pages.query(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(1, "u", "a b", 3), (1, "u", "a b", 3), (None, None, "", 0), (2, None, "", 0)], key=str)
    assert pages.query(spark.createDataFrame([], schema)).collect() == []
