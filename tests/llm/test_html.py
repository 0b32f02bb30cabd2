import itertools
import random

import pytest

from tessera.llm import html
from tessera.llm.html import ARTICLE, OPEN, blocks


def texts(page):
    return [t for t, _ in blocks(page)]


def test_structure():
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p><p>x';</script></head><body>"
            "<header>H</header><nav><ul><li><a href='/x'>Menu<li>Two</ul></nav><!-- c --><div class=\"ad\">buy</div>"
            "<article><h1>Title &amp; more</h1><p><b>One\n two&nbsp;three<br><p>Four</p>"
            "<aside>side</aside><div class='comments'><p>me too</p></div><p>Five &lt;p&gt;</p>"
            "<figure><img src=a><figcaption>Cap</figcaption></figure><form>f<input></form></article>"
            "<footer>&copy; x</footer>")
    assert texts(page) == ["Title & more", "One two three", "Four", "Five <p>", "Cap"]
    assert all(k == ARTICLE for _, k in blocks(page))


@pytest.mark.parametrize("page,want", [
    ("", []), ("   \n", []), ("plain text", ["plain text"]), ("<p>a<p>b</p>c", ["a", "b", "c"]),
    ("<div>a<span>b</span> c</div>d", ["ab c", "d"]), ("a < b and 3<4", ["a < b and 3<4"]),
    ("<article><p>x</article>tail", ["x", "tail"]), ("<nav>gone", []), ("<script>never closed <p>x</p>", []),
    ("<p>a</p></div></nav><p>b</p>", ["a", "b"]), ("<ul><li>one<li>two</ul>", ["one", "two"]),
    ("<p title='a>b'>x</p>", ["x"]), ("<div role='navigation'>m</div><p>x", ["x"]), ("<p hidden>x</p>y", ["y"]),
    ("<p>a<br/>b</p>", ["a b"]), ("&#233;&eacute;&bogus;", ["éé&bogus;"]),
    ("<div class='sidebar-left'><div>in</div>x</div><p>out", ["out"]), ("<p class='lead'>x", ["x"]),
    ("<!-- open", []), ("<article></article><p>x", ["x"]),
])
def test_blocks(page, want):
    assert texts(page) == want


def brute_runs(streams, n):
    """Covered blocks by definition: every run of n words or more that also stands in another stream."""
    cover = [set() for _ in streams]
    for a, b in itertools.permutations(range(len(streams)), 2):
        if streams[a] == streams[b]:
            continue
        s, t = streams[a], streams[b]
        for i in range(len(s)):
            for j in range(i + 1, len(s) + 1):
                if sum(len(x.split()) for x in s[i:j]) >= n and any(t[k:k + j - i] == s[i:j] for k in range(len(t))):
                    cover[a] |= set(range(i, j))
    return cover


def test_host_suffixes_against_brute_force(spark):
    rng = random.Random(3)
    pool = ["a", "b c", "d e f", "one two three four five six seven eight", "g", "h i j k"]
    streams = [[rng.choice(pool) for _ in range(rng.randint(0, 9))] for _ in range(30)]
    streams += [streams[0], ["unique words here that are long enough to count as text"]]
    rows = [(i, "http://H.org/%d" % i, "".join(f"<p>{t}</p>" for t in s), 1) for i, s in enumerate(streams)]
    rows += [(100, "http://other.org/x", rows[1][2], 1), (101, None, None, 1), (102, "x", "", 1), (None, "http://h.org/", "<article>z</article>" + rows[2][2], 1)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(4)
    got = {r.page_id: r.text for r in html.extract(d, min_words=8).collect()}
    cover = brute_runs([*streams, ["z", *streams[2]]], 8)
    for i, s in enumerate(streams):
        assert got[i] == "\n\n".join(t for k, t in enumerate(s) if k not in cover[i]), i
    assert got[100] == "\n\n".join(streams[1]) and got[101] == got[102] == "" and got[None] == "z"


def test_long_page_and_empty_table(spark):
    page = "<article>" + "<p>" + "w " * 20 + "</p>" * 2 + "</article>"
    big = "<article>" + "".join(f"<p>par {i} &amp; more</p>" for i in range(20000)) + "</article>"
    d = spark.createDataFrame([(1, "u", page), (2, "u", big)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(d).collect()}
    assert got[2].count("\n\n") == 19999 and got[1] == ("w " * 20).strip()
    assert html.extract(d.limit(0)).count() == 0
    assert [k for _, k in blocks("<p>x</p>")] == [OPEN]


@pytest.mark.parametrize("page,want", [
    ('<div class="content" style="overflow:hidden"><p>x</div>', ["x"]), ("<p title='the hidden cost'>x", ["x"]),
    ('<div data-hidden="false">x</div>', ["x"]), ("<div title=\"role='navigation'\">x</div>", ["x"]),
    ("<article class='overflow-hidden'>x</article>", ["x"]), ("<main class='has-sidebar header-fixed'>x</main>", ["x"]),
    ("<article class='post comments-open category-promo'><h2 id='related-work'>r</h2>x</article>", ["r", "x"]),
    ("<article class='promo'>x</article>", ["x"]), ("<div class='sidebar'><main>x</main>y</div>", ["x", "y"]),
    ("<div class='widget'><div class='ad'>no</div><article>x</article></div><div class='social-share'>s</div>", ["x"]),
    ("<div class='cookie-banner'>c</div><div id='newsletter_signup'>n</div><p HIDDEN>h</p><p aria-hidden=true>h</p><p class='hidden'>h</p>y", ["y"]),
    ("<main><article>x</article><div id='comments'><article class='comment'>me too</article></div></main>", ["x"]),
    ("<article>x <span class='ad'>no</span> y</article>", ["x", "y"]), ("<div class='page-header'><h1>T</h1></div>x", ["T", "x"]),
])
def test_attributes_and_whole_class_tokens(page, want):
    assert texts(page) == want


def test_copies_of_a_page_gather_one_pages_runs(spark):
    notice = "<p>this notice of eight words stands on every page</p>"
    page = notice + "".join(f"<p>own block {i} of the page that has many copies</p>" for i in range(5))
    rows = [(i, f"http://h.org/?q={i}", page if i < 300 else notice + f"<p>the other page {i}</p>") for i in range(302)]
    src = html._keyed(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), "page_id", "url", "html")
    seen = []
    spans = html.page_runs

    def record(runs):
        seen.append(spans(runs))
        return seen[-1]
    html.page_runs = record
    try:
        gone = html.boilerplate(src, 8).collect()
    finally:
        html.page_runs = spans
    assert len(gone) == 3 and all([(x.pos, x.len) for x in r.spans] == [(0, 1)] for r in gone)
    collected = seen[0].groupBy("_key").count().collect()
    assert len(collected) == 3 and all(r["count"] == 1 for r in collected)


def test_host_verdict_beside_articles(spark):
    own = lambda i: f"the main text of page {i} stands in a plain element with number {i} here"
    notice = "we value your privacy and set many small files on your device"
    pages = {
        1: f"<article>teaser</article><div>{own(1)}</div><div>{notice}</div><div>short</div>",
        2: f"<article>teaser</article><div>{own(2)}</div><div>{notice}</div>",
        3: f"<article><p>{own(3)}</p><p>{notice}</p></article>",
        4: f"<article><p>{own(4)}</p><p>{notice}</p></article><div class='cookie-notice'>{notice}</div>",
    }
    rows = [(i, "http://h.org/%d" % i, p) for i, p in pages.items()] + [(8, "http://else.org/", pages[1].replace("1", "8"))]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: (r.text, r.removed) for r in html.extract(d, min_words=8).collect()}
    assert got[1] == (f"teaser\n\n{own(1)}", 1) and got[2] == (f"teaser\n\n{own(2)}", 1)
    assert got[3] == (f"{own(3)}\n\n{notice}", 0) and got[4] == (f"{own(4)}\n\n{notice}", 0)     # lines of an article stay
    assert got[8] == (f"teaser\n\n{own(8)}\n\n{notice}\n\nshort", 0)                              # another host


STRONG = ["ad-300x250", "adsbygoogle", "advertisement-block-2", "user-comments", "post-comments", "cookie-notice-2", "paywall-notice",
          "article-footer", "social-media", "related-stories", "signup-cta", "ad", "comments", "cookie-banner", "share"]


@pytest.mark.parametrize("token", STRONG)
def test_strong_words_remove_beside_other_parts(token):
    body = "the article goes on for a while and says what it has to say"
    assert texts(f"<article><p>{body}</p><div class='x {token} y'><p>not this</p></div></article>") == [body]
    assert texts(f"<article><p>{body}</p><section id='{token}'>nor this</section></article>") == [body]


@pytest.mark.parametrize("token", ["ad-free-theme", "post-comments-open", "related-content-page", "has-social-bar", "no-ads"])
def test_strong_words_keep_what_holds_most_of_the_text(token):
    body = "the article goes on for a while and says what it has to say"
    assert texts(f"<div class='{token}'><h1>Title</h1><p>{body}</p></div><p>tail</p>") == ["Title", body, "tail"]
    assert texts(f"<div class='{token}'><article>x</article></div>") == ["x"]
    assert texts(f"<h2 class='{token}'>a heading stays</h2><p>{body}</p>") == ["a heading stays", body]


def test_headings_and_short_paragraphs_beside_articles(spark):
    pages = {1: "<h1>Short title</h1><article>body one</article><p>Signed: one</p><p>All rights reserved</p><div>42</div>",
             2: "<h1>Other title</h1><article>body two</article><p>Signed: two</p><p>All rights reserved</p><div>43</div>",
             3: "<h2 id='related-work'>Related work</h2><article>body three</article>"}
    d = spark.createDataFrame([(i, "http://h.org/%d" % i, p) for i, p in pages.items()], "page_id long, url string, html string").repartition(3)
    got = {r.page_id: (r.text, r.removed) for r in html.extract(d, min_words=8).collect()}
    assert got[1] == ("Short title\n\nbody one\n\nSigned: one", 1) and got[2] == ("Other title\n\nbody two\n\nSigned: two", 1)
    assert got[3] == ("Related work\n\nbody three", 0)
