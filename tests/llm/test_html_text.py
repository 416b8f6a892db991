import html
import re

import pytest

from tillroll.llm.html_text import extract, main_text, op1_html_text

SF = "/root/testdata/sf0.01"
P = "A paragraph of words that goes on for a while, with commas, and is plainly part of the article body."


@pytest.mark.parametrize("page, text", [
    (f"<body><header>Site</header><nav><a href=x>Home</a></nav><div id=content class='has-sidebar'><h1>Title</h1>"
     f"<div class=body><p>{P}</p><p>{P}</p><p>Short.</p></div></div><div class=sidebar><ul><li><a href=a>One</a><li>Two</ul></div>"
     f"<div class='comments'><p>No! {P}</p></div><footer>c</footer></body>", f"Title {P} {P} Short."),
    (f"<div class=cookie-notice>Cookies</div><main><h1>T &amp; U</h1><p>{P}<p>x&nbsp;&eacute;<table><tr><td>a<td>b</table>"
     f"<form><input name=q>Search</form><section id=comments><p>{P}</section></main><aside>more</aside>", f"T & U {P} x é a b"),
    (f"<div><p>{P}</p><script>var a='<p>no</p>';</script><p>{P}<b>bold</b>end</p></div><div><a href=x>link {P}</a></div>",
     f"{P} {P}boldend"),
    (f"<article><h1>A</h1><div class='ad'>{P} {P} {P}</div><p>b</p><div class=related><a>r</a></div></article>", "A b"),
    (f"<article><p>{P}<nav>never closed<p>{P}</article>tail", P),
    (f"<article><div class='long-form'><h2>T</h2><p>{P}</p></div><div class='share-buttons'>Share</div></article>", f"T {P}"),
    (f"<div id='page' class='no-sidebar'><p>{P}</p><p>{P}</p></div><div class='related'><p>Other</p></div>", f"{P} {P}"),
    ("just text", "just text"), ("", ""), ("   ", ""), ("<nav>only a menu</nav>", ""), ("<p>", ""), ("<ul><li>a<li>b</ul>", "a b"),
    ("<p>3 < 4 &lt;x &#228;\n\t line</p>", "3 < 4 <x ä line"), ("<article>" + "<div>" * 5000 + "deep", "deep"),
    ("<article>" + "<p>word</p>" * 20000 + "</article>", " ".join(["word"] * 20000)),
    ("<article><!-- <p>no</p> --><p hidden>no</p><p style='display:none'>no</p>yes</article>", "yes"),
])
def test_pages(page, text):
    assert main_text(page) == text


def test_article_in_several_sections():
    part = lambda k: "".join(f"<p>{k}{i} {P}</p>" for i in range(5))
    text = lambda k: " ".join(f"{k}{i} {P}" for i in range(5))
    links = "<div>" + "".join(f"<a href=x>more of {P}</a>" for _ in range(6)) + "</div>"
    assert main_text(f"<body><div><section>{part('a')}</section><section>{part('b')}</section></div></body>") == f"{text('a')} {text('b')}"
    page = f"<body>{links}<div><div><h2>One</h2><div>{part('a')}</div></div>{links}<div>{part('b')}</div><div>{part('c')}</div></div>{links}</body>"
    assert main_text(page) == f"One {text('a')} {text('b')} {text('c')}"


@pytest.mark.parametrize("mark", ["ad-free", "entry-content ad-free", "with-sidebar", "promo-code-guide", "comment-policy", "navigation-history",
                                  "reply-to-critics", "post subscription-required", "menu-planning", "adFree"])
def test_compound_classes_of_article_parts(mark):
    assert main_text(f"<article><h1>T</h1><div class='{mark}'><p>{P}</p><p>{P}</p></div></article>") == f"T {P} {P}"
    page = f"<article><p>{P}</p><p>{P}</p><section class='{mark}'><p>{P}</p></section></article>"
    assert main_text(page) == f"{P} {P} {P}"


@pytest.mark.parametrize("mark", ["comment-list", "site-footer", "cookieNotice", "ad-slot-3", "related-posts", "share_buttons", "nav-main"])
def test_compound_classes_of_other_parts(mark):
    assert main_text(f"<article><p>{P}</p><p>{P}</p><div class='{mark}'><p>Some words.</p></div></article>") == f"{P} {P}"


def test_several_articles_and_sections_around_the_article():
    text = f"{P} {P}"
    part = f"<p>{P}</p><p>{P}</p>"
    assert main_text(f"<body><main><article>{part}</article><article>{part}</article></main></body>") == f"{text} {text}"
    assert main_text(f"<body><article>{part}</article><article>{part}</article><footer>f</footer></body>") == f"{text} {text}"
    assert main_text(f"<body><article>{part}</article><section><h2>More</h2>{part}</section></body>") == f"{text} More {text}"
    teasers = "".join(f"<article><a href=x>Read about {i}</a></article>" for i in range(5))
    assert main_text(f"<body><article>{part}</article><div>{teasers}</div></body>") == text


def test_lists_of_links_inside_the_article():
    links = "".join(f"<li><a href=x{i}>Another page {i}</a></li>" for i in range(6))
    part = f"<p>{P} <a href=y>with a link</a></p><p>{P}</p>"
    want = f"{P} with a link {P}"
    assert main_text(f"<main><ul>{links}</ul>{part}</main>") == want
    assert main_text(f"<main>{part}<ul><li>{P}</li><li><a href=z>one link</a></li></ul></main>") == f"{want} {P} one link"


def test_query_keeps_articles_whole(spark):
    """Brute force for this table: all that stands in the article element, block by block."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op1_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = re.sub(r"</?(?:p|h1|br)>", " \0 ", inner).replace("<b>", "").replace("</b>", "")
        assert r.text == " ".join(html.unescape(blocks).replace("\0", " ").split())
        assert r.n_chars == len(r.text)


def test_edge_rows(rows):
    data = [(1, "u", None, 5), (1, "u", None, 5), (None, None, "<p>x 😀", 5), (2, "v", "", 5)]
    got = extract(rows(data, "page_id long, url string, html string, text int")).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(x) for x in
                                                        [(1, "u", "", 0), (1, "u", "", 0), (None, None, "x 😀", 3), (2, "v", "", 0)])
    assert extract(rows([], "page_id long, url string, html string")).count() == 0
