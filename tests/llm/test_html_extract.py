import pytest

from greenlake.llm import html_extract as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><header><p>Site</p></header><div id="sidebar">Side</div><!-- c --><div class="ad-slot">Buy</div>
<article><h1>Head &amp; more</h1><p><b>First   line<br><p>Second <i>in</i>line&nbsp;text&#33;</p><script>var a="</p>";</script>
<form><input value="q">Search</form><div class="comments"><p>Reader says</p></div><p>Third</article><footer>&copy; x</footer></body></html>"""


def test_article_blocks():
    assert h.main_text(PAGE) == "Head & more\n\nFirst line\n\nSecond inline text!\n\nThird"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain  words", "plain words"), ("<p>a<p>b", "a\n\nb"), ("<div>a<div>b</div>c</div>", "a\n\nb\n\nc"),
        ("</p></div>x", "x"), ("<p title='>'>q</p>", "q"), ("<script>never", ""), ("a &lt; b", "a < b"), ("<ul><li>1<li>2</ul>", "1\n\n2"),
        ("<p>" * 3000 + "deep", "deep"), ("<div>" * 300 + "deep", "deep"), ("<p hidden", "<p hidden"),
    ],
)
def test_loose_markup(page, text):
    assert h.main_text(page) == text


def site(n, host="http://h.com/"):
    """Pages without telling names: a fixed strip beside text of their own."""
    return [(i, f"{host}{i}", f"<body><div><span>Subscribe to us</span></div><section><p>Text {i} a</p>{'<p>More %d</p>' % i * (i % 5)}</section></body>", 1) for i in range(n)]


def test_low_importance_branches_go(frame):
    schema = "page_id long, url string, html string, text int"
    for few in (200_000, 0):  # nodes in every task, or joined
        rows = h.extract_main_text(frame(site(60), schema), broadcast_nodes=few).collect()
        assert len(rows) == 60
        for r in rows:
            assert "Subscribe" not in r["text"] and r["text"].startswith(f"Text {r['page_id']} a") and r["n_chars"] == len(r["text"])
    alone = h.extract_main_text(frame(site(3), schema)).first()
    assert "Subscribe" in alone["text"]  # too few pages for an estimate


def test_importance_by_hand(frame):
    import math

    tree = {r["path"]: r for r in h.style_tree(frame(site(50), "page_id long, url string, html string, text int")).collect()}
    assert abs(tree["/body/div"]["importance"]) < 1e-9 and tree["/body/div"]["pages"] == 50
    # five child sequences of ten pages each; texts are unique or shown once
    shown = (math.log(50) - 5 * 10 * math.log(10) / 50) / math.log(50)
    assert abs(tree["/body/section"]["importance"] - (shown + 1) / 2) < 1e-9


def test_edge_rows(frame):
    schema = "page_id long, url string, html string"
    rows = h.extract_main_text(frame([(1, None, PAGE), (1, None, PAGE), (None, "x", None), (3, "http://a", "")], schema)).collect()
    assert sorted(r["n_chars"] for r in rows)[:2] == [0, 0] and len(rows) == 4
    assert h.extract_main_text(frame([], schema)).count() == 0


def test_wrapped_articles_stay(frame):
    # The wrapper's child sequence is the same on every page and half of its blocks are fixed.
    strip = "".join(f"<nav><a>Go {i}</a></nav>" for i in range(7))
    rows = [(i, f"http://h.com/{i}", f"<body><div class=page>{strip}<article><p>Own {i} a</p><p>Own {i} b</p></article></div></body>") for i in range(40)]
    low = {r["path"] for r in h.style_tree(frame(rows, "page_id long, url string, html string")).where("importance < 0.4").collect()}
    assert "/body/div.page" in low
    got = h.extract_main_text(frame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"Own {i} a\n\nOwn {i} b" for i in range(40)}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><p>one <svg class="i"/> two</p><p>three</p></article>', "one two\n\nthree"),
        ("<p>a</p><title-bar>b</title-bar><p>c</p>", "a\n\nb\n\nc"), ("<p>a<svg><path d='x'/>no</svg>b</p>", "ab"),
        ("<p>a<script src=/x/y.js data-t='>'>no</script>b</p>", "ab"), ("<p>a<video src='a/b'/>b</p>", "ab"), ("<p>a<svg/>b", "ab"),
    ],
)
def test_raw_tags_end_where_they_end(page, text):
    assert h.main_text(page) == text


def test_the_tree_decides_on_the_given_pages(spark):
    """Every block that goes, goes by its node's weighed importance; without a tree the texts are others."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    got = {r["page_id"]: r["text"] for r in h.extract_main_text(pages).collect()}
    assert all(got[i] != h.main_text(x, low=()) for i, x in html.items() if x)
    # On these pages the article's blocks are what lies inside its tags.
    for i, x in html.items():
        inside = x[x.find("<article>") : x.find("</article>")] if x else ""
        assert got[i] == h.main_text(inside)


def test_strips_inside_articles_go_by_entropy(frame):
    rows = [(i, f"http://h.com/{i}", f"<body><article><p>Own {i} a</p><div>Read our terms</div><p>{'Own more. ' * (1 + i % 7)}{i}</p></article></body>") for i in range(60)]
    schema = "page_id long, url string, html string"
    got = {r["page_id"]: r["text"] for r in h.extract_main_text(frame(rows, schema)).collect()}
    assert all("terms" not in t and t.startswith(f"Own {i} a\n\nOwn more.") for i, t in got.items())
    few = h.extract_main_text(frame(rows[:3], schema)).first()
    assert "terms" in few["text"]


def test_copies_of_an_article_stay(frame):
    # Equal pages are one page to the tree, however many there are.
    rows = [(i, f"http://h.com/{i}", f"<body><nav><a>Go {i % 3}</a></nav><article><p>The same article</p></article></body>") for i in range(80)]
    rows += [(100 + i, f"http://h.com/x{i}", f"<body><nav><a>Go {i % 3}</a></nav><article><p>Own {i}</p></article></body>") for i in range(20)]
    got = {r["page_id"]: r["text"] for r in h.extract_main_text(frame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "The same article" if i < 100 else f"Own {i - 100}" for i in got} and len(got) == 100


def test_very_long_page(frame):
    page = "<body><article>" + "<p>word </p>" * 50_000 + "</article></body>"
    assert h.extract_main_text(frame([(1, "http://a/", page)], "page_id long, url string, html string")).first()["n_chars"] == 50_000 * 6 - 2


def test_equal_pages_are_judged_alike(frame):
    rows = [(i, "http://h.com/1", "<body><div>Same</div><p>Own</p></body>") for i in range(30)]
    assert {r["text"] for r in h.extract_main_text(frame(rows, "page_id long, url string, html string")).collect()} == {"Same\n\nOwn"}


@pytest.mark.parametrize("n", [1, 100, 300, 3000])
def test_named_furniture_goes_at_every_host_size(frame, n):
    """Menus, sidebars, notices and footers with text of their own on each page, which entropy can't tell from articles."""
    own = lambda i: "".join(f"<a>go {i} {k}</a>" for k in range(1 + i % 4))
    rows = [
        (i, f"http://one.com/{i}", f"<body><nav><ul><li>{own(i)}</li></ul></nav><div class=sidebar><p>Side {i}</p></div><article><h1>Head {i}</h1><p>Own {i} text</p></article>"
         f"<div class='cookie-notice'>Notice {i}</div><footer><p>Foot {i}</p></footer></body>") for i in range(n)
    ]
    got = {r["page_id"]: r["text"] for r in h.extract_main_text(frame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Head {i}\n\nOwn {i} text" for i in range(n)}


def test_entropy_decides_about_nodes_without_names(frame, monkeypatch):
    rows = [(i, f"http://h.com/{i}", f"<body><div class=strip>All of {i % 2}</div><article><p>Own {i}</p></article></body>") for i in range(400)]
    pages = frame(rows, "page_id long, url string, html string")
    got = h.extract_main_text(pages).collect()
    assert all(r["text"] == f"Own {r['page_id']}" for r in got)
    blind = h.extract_main_text(pages, plain_pages=10**9).collect()  # entropy is outweighed everywhere
    assert all(r["text"].startswith("All of") for r in blind)
