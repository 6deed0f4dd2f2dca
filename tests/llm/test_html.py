import html as lib
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from bandscope.llm.html import Page, densities, extract, furniture, main_text

LONG = "This paragraph has quite a few words in it, as the body of an article would. " * 3


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
    <header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
    <div class="cookie-notice"><p>{LONG}</p></div><!-- <p>hidden</p> --><div id="ad-top">Buy</div>
    <article><header><h1>Head &amp; line</h1></header><p>{LONG}</p><div class="ad">Buy now</div><p>Short.</p><form><p>Name</p></form>
    <section><p>In<b>li</b>ne &lt;tag&gt;<br>next  line</p><ul><li>one<li>two</ul></section><section class="comments"><p>{LONG}</p></section></article>
    <aside><p>{LONG}</p></aside><div class="sidebar">{LONG}</div><footer>&copy; us</footer><script>var x = "<p>no</p>";</script></body></html>"""
    assert main_text(page).split("\n\n") == ["Head & line", LONG.strip(), "Short.", "Inline <tag> next line", "one", "two"]


def test_density_finds_the_content_without_an_article_element():
    links = "".join(f"<li><a href=/{i}>link number {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div class=x><h1>Title</h1><div><p>{LONG}</p><p>Two</p><p>{LONG}</p></div></div><div><p><a href=/>more</a></p></div></body>"
    assert main_text(page).split("\n\n") == ["Title", LONG.strip(), "Two", LONG.strip()]


def test_content_beside_the_article_element():
    lead = "The lead of this story stands before its article and has some length. " * 3
    links = "".join(f"<li><a href=/{i}>link number {i}</a></li>" for i in range(30))
    story = f"<h1>Title</h1><p>{lead}</p><article><p>{LONG}</p><p>Two</p><p>{LONG}</p></article><ul>{links}</ul>"
    want = ["Title", lead.strip(), LONG.strip(), "Two", LONG.strip()]
    for page in (f"<main>{story}</main>", f"<body><div>{story}</div></body>", f"<body><div role=main><div>{story}</div></div></body>"):
        assert main_text(page).split("\n\n") == want, page
    two = f"<body><article><p>{LONG}</p><p>{LONG}</p></article><article><p>{lead}</p><p>{lead}</p></article></body>"
    assert main_text(two).split("\n\n") == [LONG.strip()] * 2 + [lead.strip()] * 2


def test_names_of_furniture():
    story = "<article><div class=post-header><h1>Head</h1></div><p>Short text.</p>{}</article>"
    for name in ("ad", "widget", "newsletter-box", "cookie notice", "user-comments", "related-posts"):
        assert main_text("<body>" + story.format(f'<div class="{name}">{LONG}</div>')) == "Head\n\nShort text."
    assert main_text(f"<div class=header><h1>Site</h1></div><div class=content-with-sidebar><h1>Head</h1><p>{LONG}</p></div>").startswith("Head")
    assert main_text(f"<div class='page header'><article><p>{LONG}</p></article></div>") == LONG.strip()


def test_names_do_not_cut_running_text():
    """A name counts as a whole, on containers; in the article paragraphs and headlines stay whatever they are called."""
    text = "<p class='related'>One.</p><p class='social-science'>Two.</p><p id='notice-of-rights'>Three.</p>"
    assert main_text(f"<article><h1>Head</h1>{text}</article>") == "Head\n\nOne.\n\nTwo.\n\nThree."
    for name in (
        "social-science", "notice-of-rights", "share-prices", "alert-level-two", "login-design", "promo-free-zone", "ad-hoc", "menu-of-the-day",
        "comments-on-kant", "advert-history", "modal-logic",
    ):
        page = f"<article><h1>Head</h1><div class='{name}'><p>One.</p></div><section id='{name}'><h2>More</h2><p>Two.</p></section></article>"
        assert main_text(page) == "Head\n\nOne.\n\nMore\n\nTwo.", name
    for tag in ("p", "h2", "blockquote", "li", "figcaption"):
        assert main_text(f"<article><h1>Head</h1><{tag} class='widget related'>One.</{tag}></article>") == "Head\n\nOne.", tag
    # Much text under such a name is no article, and little text under none no furniture.
    assert main_text(f"<article><p>Short.</p><div class='related posts'><p>{LONG}</p></div></article>") == "Short."


def test_names_on_what_holds_the_page():
    for name in ("widget", "sidebar", "page header", "modal", "comments"):
        assert main_text(f"<div class='{name}'><article><p>{LONG}</p></article></div>") == LONG.strip()
        assert main_text(f"<div class='{name}'><p>{LONG}</p></div>") == LONG.strip()
    assert main_text(f"<div class='widget'><h1>Head</h1><p>{LONG}</p></div><div class='ad'>Buy</div>") == f"Head\n\n{LONG.strip()}"
    assert main_text(f"<div class='page-header'><h1>Site</h1></div><div><h1>Head</h1><p>{LONG}</p></div>") == f"Head\n\n{LONG.strip()}"


def slow_densities(page, cut):
    """Densities by walking down from every element anew, sums over children, and the element with the largest sum."""
    children = [[j for j, p in enumerate(page.parent) if p == i] for i in range(len(page.tag))]
    own = [sum(len("".join(t.split())) for e, _, t in page.pieces if e == i) for i in range(len(page.tag))]

    def walk(i, linked):
        """Characters, elements, characters in links and links, of i and what is below."""
        linked = linked or page.tag[i] == "a"
        c, t, lc, lt = (0, 0, 0, 0) if cut[i] else (own[i], 1, own[i] if linked else 0, int(page.tag[i] == "a"))
        for j in children[i]:
            c, t, lc, lt = (x + y for x, y in zip((c, t, lc, lt), walk(j, linked)))
        return c, t, lc, lt

    def above(i):
        return page.parent[i] >= 0 and (page.tag[page.parent[i]] == "a" or above(page.parent[i]))

    body = next((i for i, t in enumerate(page.tag) if t == "body"), 0)
    c, _, lc, _ = walk(body, above(body))
    share = lc / max(1, c)
    density = []
    for i in range(len(page.tag)):
        c, t, lc, lt = walk(i, above(i))
        if not c or cut[i]:
            density.append(0.0)
            continue
        base = max(1.0001, math.log(c / max(1, c - lc) * lc + share * c + math.e))
        shown = math.log(max(1.0, c / max(1, lc) * max(1, t - 1) / max(1, lt))) / math.log(base)
        density.append(c / max(1, t - 1) * max(0.0, shown))
    total = [sum(density[j] for j in children[i]) for i in range(len(page.tag))]
    return density, total, max(range(len(total)), key=lambda i: (total[i], -i)) if max(total) > 0 else body


def test_densities_against_a_slow_version(spark, sf):
    """Every page with its article element, and with a plain div in its place."""
    for r in spark.read.parquet(f"{sf}/pages.parquet").filter("html IS NOT NULL").collect():
        for html in (r.html, r.html.replace("article>", "div>")):
            page = Page(html)
            density, total, core = densities(page, furniture(page))
            want, want_total, want_core = slow_densities(page, furniture(page))
            assert max(abs(a - b) for a, b in zip(density, want)) < 1e-9 * max(1, max(want)) and core == want_core
            assert max(abs(a - b) for a, b in zip(total, want_total)) < 1e-9 * max(1, max(want_total))


def test_the_article_element_is_seldom_needed(spark, sf):
    """Without it the densities alone find the same text of nearly all pages."""
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").filter("html IS NOT NULL").collect()]
    same = sum(main_text(h) == main_text(h.replace("<article>", "<div>").replace("</article>", "</div>")) for h in pages)
    assert same >= 0.95 * len(pages)


def test_broken_markup():
    assert main_text("<p>a<p>b") == "a\n\nb"
    assert main_text("<article><p>a &am") == "a &am"
    assert main_text("<article><p>a<div") == "a"
    assert main_text("<article><p>a <b>b</article>") == "a b"
    assert main_text("<article>1 < 2 <3 </p></i>x<!-- open") == "1 < 2 <3 x"
    assert main_text("<article><p>a<script>if (a</b) {}") == "a"
    assert main_text("just text &eacute;&#33;&nbsp;") == "just text é!"
    assert [main_text(x) for x in ("", "<", "<nav>a</nav>", "<html></html>", "<!---->", "</p>")] == ["", "<", "", "", "", ""]


def test_quotes_inside_tags():
    for tag in ("<a title=it's>", '<div class="x"">', "<p title=5'hidden>", "<p title='a>b' x='>'>", '<p title="open hidden>', '<p title = "a>b"c=\'>\'">'):
        assert main_text(f"<article><p>before</p>{tag}after</article>").split() == ["before", "after"], tag
    assert main_text("<article><p>before <a title=it's>link</a> it's after") == "before link it's after"
    # The page ends inside a tag.
    assert main_text("<article><p>before<img alt='a > b' src=") == "before"


def test_long_pages_take_time_in_proportion():
    for unit in ("<", "<a", "<p>x", "<b>", "&amp;", "</p>", "<!--", "<a href='", "x "):
        main_text("<article>" + unit * 20_000)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/!-ab p=\"'&;\n", max_size=60))
def test_any_text_is_read(text):
    out = main_text(text)
    assert out == "\n\n".join(" ".join(b.split()) for b in out.split("\n\n"))
    assert len(Page(text).tag) == len(Page(text).parent)


def test_pages_against_the_article_element(spark, sf):
    """The test pages hold their text in one article of headlines and paragraphs."""
    for r in extract(spark.read.parquet(f"{sf}/pages.parquet").withColumnRenamed("url", "link").withColumnRenamed("html", "page"), "page").join(
        spark.read.parquet(f"{sf}/pages.parquet"), "page_id"
    ).collect():
        body = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1])
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body.replace("<br>", " ")))
        want = "\n\n".join(b for b in (" ".join(lib.unescape(b).split()) for b in blocks) if b)
        assert (r.text, r.n_chars) == (want, len(want))


def test_null_empty_repeated_and_clashing_columns(spark):
    rows = [(1, None, "old"), (1, "", "old"), (2, "<p>x é</p>", None), (2, "<p>x é</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string").selectExpr("*", "7 as n_chars", "1 as _x", "2 as _html", "3 as page")
    got = sorted(tuple(r) for r in extract(pages).select("page_id", "text", "n_chars").collect())
    assert got == [(1, "", 0), (1, "", 0), (2, "x é", 3), (2, "x é", 3)]
    assert extract(pages).columns == ["page_id", "_x", "_html", "page", "text", "n_chars"]
    assert extract(pages.limit(0)).count() == 0
