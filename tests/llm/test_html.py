"""Main text of pages against texts the pages were built from, and wrapper induction on its own."""

import html as stdlib
import random
import re
import time

import pytest

from tributary.llm import html as H


def plain_article(source):
    """For pages with one article of h1 and p: its blocks by regular expressions alone."""
    m = re.search(r"<article>(.*?)(?:</article>|$)", source or "", re.S)
    if not m:
        return None
    body = re.sub(r"<[^>]*$", "", m[1])
    parts = re.split(r"</?(?:p|h1|footer)>", re.sub(r"<footer>.*", "", body, flags=re.S))
    clean = [" ".join(stdlib.unescape(re.sub(r"<[^>]*>", lambda t: " " if "br" in t[0] else "", x)).split()) for x in parts]
    return "\n".join(c for c in clean if c)


def test_table_equals_its_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = {r.page_id: r for r in H.main_text(pages).collect()}
    for p in pages.collect():
        assert rows[p.page_id].url == p.url
        if (want := plain_article(p.html)) is not None:
            assert rows[p.page_id].text == want, p.page_id
            assert rows[p.page_id].n_chars == len(want)


def site(rng, n, article=False):
    """Pages of a host without semantic elements; text and what should be found."""
    words = lambda k: " ".join(rng.choice("alpha beta gamma delta eps zeta eta".split()) + str(rng.randrange(99)) for _ in range(k))
    out = []
    for _ in range(n):
        blocks = [words(3)] + [words(rng.randrange(5, 12)) for _ in range(rng.randrange(2, 5))]
        body = f"<h2>{blocks[0]}</h2>" + "".join(f"<p>{b}" for b in blocks[1:])
        out.append((f"<html><head><title>t</title></head><body><div id=top>Site name</div><div class=menu><a href=x>{words(2)}</a></div>"
                    f"<div id=text>{body}<div class=tools>Print this page</div></div><form>Search {words(1)}</form>"
                    f"<div id=end>All rights reserved</div></body></html>", "\n".join(blocks)))
    return out


def test_wrapper_finds_the_varying_slots(spark):
    rng = random.Random(4)
    pages = [(i, f"http://site.example/{i}", h, t) for i, (h, t) in enumerate(site(rng, 12))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, want string")
    for r in H.main_text(df).join(df.select("page_id", "want"), "page_id").collect():
        assert r.text == r.want


def test_tree_matching_is_largest_ordered_match():
    a = H.skeleton(H.parse("<body><div><h1>x</h1><p>a</p></div><ul><li>1</ul></body>"))
    b = H.skeleton(H.parse("<body><ul><li>0</ul><div><p>b</p><p>c</p></div><ul><li>1<li>2</ul></body>"))
    pairs = {(a.label[x], b.label[y]) for x, y in H.tree_match(a, b)}
    assert pairs == {("", ""), ("body", "body"), ("div", "div"), ("p", "p"), ("ul", "ul"), ("li", "li")}


BROKEN = [
    ("<article><p>a&nbsp;&amp; b<p>c <b>d</b>e<br>f<div class='ad x'>no</div><ul><li>g<li>h</ul>i</article>", "a & b\nc de f\ng\nh\ni"),
    ("<article><h1>T</h1><script>var t='</p><article>';</script><style>p{}</style><p>x<!-- <p>no --> y</article><p>after", "T\nx y"),
    ("<article><p>one</p><section class=\"comments\"><p>no</p></section><aside>no</aside><p>two &am", "one\ntwo &am"),
    ("<article><p>cut <b", "cut"),
    ("<body><nav>n</nav><p>plain &lt;text&gt; 1 < 2</p><footer>f</footer>", "plain <text> 1 < 2"),
    ("<article><p>x</p><article class='comment'><p>no</p></article></article>", "x"),
    ("<main><div role=navigation>no</div><table><tr><td>a<td>b<tr><td>c</table></main>", "a\nb\nc"),
    ("<p hidden>no<p>yes", "yes"), ("", ""), (None, ""), ("just text\n  here", "just text here"), ("<!DOCTYPE html>", ""),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ("<article>" + "<p>w " * 20000 + "</article>", "\n".join(["w"] * 20000)),
    ("<article>" + "<h2>a</h2><p>b" * 5000 + "</article>", "\n".join(["a", "b"] * 5000)),
    ("<article>" + "".join(f"<div class=x{'abcdefghij'[i % 10] * (i // 10 + 1)}>q</div>" for i in range(900)) + "</article>",
     "\n".join(["q"] * 900)),
]


def test_broken_pages_and_edge_rows(spark):
    hosts = [f"http://h{min(i, 13)}.example/" for i in range(len(BROKEN))]  # the last ones share a host
    rows = [(i, hosts[i], h) for i, (h, _) in enumerate(BROKEN)] + [(None, None, BROKEN[0][0]), (0, "http://h0.example/", BROKEN[0][0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as root", "3 as text")
    got = H.main_text(df).collect()
    assert sorted(((r.page_id, r.text) for r in got), key=str) == sorted(
        [(i, t) for i, (_, t) in enumerate(BROKEN)] + [(None, BROKEN[0][1]), (0, BROKEN[0][1])], key=str)
    assert H.main_text(df.limit(0)).count() == 0


def test_copies_on_one_host_keep_their_text(spark):
    page = "<html><body><div id=a><p>same words on every page</div></body></html>"
    df = spark.createDataFrame([(i, "http://c.example/", page) for i in range(5)], "page_id long, url string, html string")
    assert {r.text for r in H.main_text(df).collect()} == {"same words on every page"}


def test_constant_parts_of_an_article_stay(spark):
    page = "<body><nav>a</nav><article><h1>Weekly notes</h1><div><p>text {}</p><p>more {}</p></div></article></body>"
    df = spark.createDataFrame([(i, "http://w.example/", page.format(i, i)) for i in range(6)], "page_id long, url string, html string")
    assert sorted(r.text for r in H.main_text(df).collect()) == [f"Weekly notes\ntext {i}\nmore {i}" for i in range(6)]


@pytest.mark.parametrize("n", [47, 48, 60, 300])
def test_many_differently_named_parts_are_all_content(spark, n):
    names = [f"part-{'abcdefghij'[i % 10] * (i // 10 + 1)}" for i in range(n)]
    rows = []
    for k in range(5):
        parts = "".join(f"<div id={x}><p>{x} of page {k}</p></div>" for x in names[1:])
        rows.append((k, "http://parts.example/", f"<body><div id={names[0]}><p>{names[0]} of page {k}</p></div>"
                     f"<div id=legal><p>All rights reserved</p></div>{parts}</body>", "\n".join(f"{x} of page {k}" for x in names)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, want string")
    for r in H.main_text(df).join(df.select("page_id", "want"), "page_id").collect():
        assert r.text == r.want


def plain_match(a, b):
    """Size of the largest match by the textbook recursion."""
    ca, cb = a.children(), b.children()

    def size(x, y):
        if a.label[x] != b.label[y]:
            return 0
        m = [[0] * (len(cb[y]) + 1) for _ in range(len(ca[x]) + 1)]
        for p in range(len(ca[x])):
            for q in range(len(cb[y])):
                m[p + 1][q + 1] = max(m[p][q + 1], m[p + 1][q], m[p][q] + size(ca[x][p], cb[y][q]))
        return m[-1][-1] + 1
    return size(0, 0)


def test_matches_are_largest_whole_or_in_halves(monkeypatch):
    rng = random.Random(8)
    cells = H.TABLE_CELLS
    for _ in range(60):
        a, b = (H.skeleton(H.parse("<body>" + "".join(f"<div class={rng.choice('abcd')}><p>x<ul><li>y</ul></div>" if rng.random() < .5
                else f"<div class={rng.choice('abcd')}>x</div>" for _ in range(rng.randrange(1, 30))))) for _ in range(2))
        for limit in (cells, 0):
            monkeypatch.setattr(H, "TABLE_CELLS", limit)
            pairs = H.tree_match(a, b)
            assert len(pairs) == plain_match(a, b) == len({x for x, _ in pairs}) == len({y for _, y in pairs})
            assert sorted(y for _, y in pairs) == [y for _, y in sorted(pairs)]
            assert all(a.label[x] == b.label[y] and (not x or (a.parent[x], b.parent[y]) in set(pairs)) for x, y in pairs)


@pytest.mark.parametrize("n", [20, 47, 60, 400])
def test_a_constant_line_is_cut_however_many_paragraphs(spark, n):
    """A line that all pages have between their paragraphs is template at any length of the page."""
    rows = []
    for k in range(5):
        parts = [f"<p>paragraph {i} of page {k}</p><div class=tip>Read more here</div>" for i in range(n // 2 + k)]
        rows.append((k, "http://tips.example/", f"<body><div id=text><h2>title {k}</h2>{''.join(parts)}<p>end {k}</p></div></body>",
                     "\n".join([f"title {k}"] + [f"paragraph {i} of page {k}" for i in range(n // 2 + k)] + [f"end {k}"])))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, want string")
    for r in H.main_text(df).join(df.select("page_id", "want"), "page_id").collect():
        assert r.text == r.want


def test_deep_pages_take_no_longer():
    began = time.perf_counter()
    assert text("<body>" + "<div class=x>a" * 20000) == "\n".join(["a"] * 20000)
    sk = H.skeleton(H.parse("<body>" + "<div class=x>a" * 20000))
    other = H.skeleton(H.parse("<body>" + "<div class=x>b" * 19000))
    assert len(H.tree_match(sk, other)) == 19002
    votes = {i: (1, 2 if i > 5000 else 1, 3, False) for i in range(20002)}
    root, constant = H.wrapper(sk, votes)
    assert root is not None and len(constant) == 5001
    assert time.perf_counter() - began < 10  # alone on a core: about a second


def text(source):
    return H.extract(source, None, frozenset())


def test_names_do_not_drop_articles_mains_and_what_holds_them():
    for page in ("<article class='post has-comments'><p>x</p></article>", "<div id='content' class='no-sidebar'><p>x</p></div>",
                 "<div class='wrapper header-fixed'><article><p>x</p></article></div>", "<main class='related-layout'><p>x</p></main>",
                 "<main class=related><p>x</p></main>", "<div class=banner><div id=header><main><p>x</p></main></div></div>",
                 "<div class=banner><article><p>x</p></article></div>", "<article class=notice><p>x</p></article>",
                 "<a class=promo><article><p>x</p></article></a>", "<div data-id='related'><p>x</p></div>",
                 "<div title='the hidden river' data-class=ad data-hidden><p>x</p></div>"):
        assert text(f"<body>{page}</body>") == "x", page
        assert text(f"<body>{page}<div class='cookie-notice'>no</div><div class='ad x'>no</div><p hidden>no</body>") == "x", page
    # boilerplate articles beside or in the page's own one
    assert text("<article><p>x</p><article class=comment>no</article></article><div id=comments><article>no</article></div>") == "x"
    assert text("<div><p>x</p></div><div id=comments><article class=comment><p>no</p></article></div>") == "x"
    # no text beside an article of boilerplate name is lost
    assert text("<div><p>x</p></div><div class=related><article><p>y</p></article></div>") == "x\ny"
    assert text("<main><p>x</p><div class='banner'><article><p>y</p></article></div></main>") == "x\ny"


@pytest.mark.parametrize("page,want", [
    ('<p class="x"">one</p><p>two</p>', "one\ntwo"), ("<p title=it's>one</p><p>two's</p>", "one\ntwo's"),
    ("<!--><p>one</p><!---><p>two</p><!-- x --!><p>three</p>", "one\ntwo\nthree"), ("<p a=\"1\"b='2'c=3>one", "one"),
    ('<p "">one</p><p =x="y>z">two</p><a href=/a/b>three</a>', "one\ntwo\nthree"), ("<p\nclass\n=\n'ad'\n>no</p>yes", "yes"),
    ("one</ p></>two</3>", "onetwo"), ("<br/><p/>one<p / class=ad>no", "one"), ("<p data-x='a > b'>one", "one"),
    ("<img alt=\"it's 5 > 3\">one", "one"), ('<p class="x>one</p>', ""),
])
def test_tags_are_read_as_the_standard_reads_them(page, want):
    assert text(f"<body>{page}") == want


def test_forms_that_frame_the_page_are_read_through():
    assert text("<body><form id=aspnetForm><div><h1>T</h1><p>text of the page</p></div><form><input>Search now</form></form>") == "T\ntext of the page"
    assert text("<body><form><main><p>x</p></main></form>") == "x"
    assert text("<body><form><nav>menu of many words here</nav><article>x</article></form>") == "x"
    # a form that is a part of the page goes, also with a paragraph in it
    assert text("<body><p>a text that is longer than the form</p><form><p>Search</p><input></form>") == "a text that is longer than the form"
    assert text("<body><form>Search the site</form><p>x</p>") == "x"
    assert text("<article><p>a text that is longer than the form</p><form><p>Subscribe</p></form></article>") == "a text that is longer than the form"


@pytest.mark.parametrize("name", ["class=widget", "id=notice"])
def test_varying_slots_outweigh_names(spark, name):
    page = "<body><div id=top>Site name</div><div class=wrap><div {}><h2>title {}</h2><p>text {}</p></div></div></body>"
    rows = [(i, "http://n.example/", page.format(name, i, i)) for i in range(6)]
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(f"title {i}\ntext {i}" in got[i] for i in range(6))
    # beside other slots a name still marks boilerplate
    more = [(i, u, h.replace("</body>", f"<div id=text><p>story {i}</p></div></body>")) for i, u, h in rows]
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(more, "page_id long, url string, html string")).collect()}
    assert got == {i: f"story {i}" for i in range(6)}
