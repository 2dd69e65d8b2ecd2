import random
import re
from collections import Counter

import pytest

from agentlake.llm.html_extract import Page, extract_pages, host_paths, main_text

PARAGRAPH = "Words of an article that says something, at some length and with commas. "


def site(k, extra=""):
    return (
        f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body class='has-sidebar page-{k}'><header><p>{PARAGRAPH * 4}</p></header>"
        f"<nav><ul><li><a href='/a'>Home</a></ul></nav><div class='wrap'><div class='post-{k} entry'><h1>Title {k}</h1><p>{PARAGRAPH}</p>{extra}"
        f"<ul><li>one<li>two <b>bold</b></ul><form><p>no form</p></form></div><div id='sidebar'><p>{PARAGRAPH * 6}</p></div>"
        f"<section class='comments'><p>{PARAGRAPH * 9}</p></section></div><footer>&copy;</footer></body></html>")


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b&nbsp;&lt;c\n d", "a\nb <c d"),
    ("<div><script>if(a<b){'</div>'}</script><!-- <p>no</p> --><p>yes 1 < 2</p><style>p{}</style>", "yes 1 < 2"),
    ("<article><p title='a>b'>q</p><p title=\"open>r</p></article>", "q\nr"), ("<p>one<br>two</p>", "one two"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<nav><p>menu</p></nav>", ""), ("</p></div>x</b>", "x"), ("<!-- open", ""),
    ("<script>never closed <p>no", ""), ("<dl><dt>a<dd>b</dl>", "a\nb"), ("<main><p>x</p><aside>n</aside><div class='cookie-notice'>n</div></main>", "x"),
])
def test_pages(html, text):
    assert main_text(html, None) == text


@pytest.mark.parametrize("start", [
    "article class='post type-post category-social tag-menu'", "article class='story promotion'", "main class='social related'", "div class='article-content with-comments'",
    "div class='post type-post category-social'", "div class='category-advertising'", "div class='has-comments'", "div class='no-ads wrap'", "div class='layout with-sidebar no-menu'",
    "div id='content' class='social'", "div role='main' class='subscription'"])
def test_class_words_that_do_not_name_the_element_keep_it(start):
    assert main_text(f"<body><{start}><p>{PARAGRAPH}</p></{start.split()[0]}><div><p>left</p></div></body>", None).startswith(PARAGRAPH.strip())


@pytest.mark.parametrize("start", [
    "div class='post-comments'", "div class='main-menu'", "div class='content-ad'", "ul class='category-menu'", "div id='comments' class='content'", "div role='navigation' class='main'",
    "div class='related'", "article class='comment'"])
def test_menus_adverts_and_comments_are_left_out(start):
    tag = start.split()[0]
    assert main_text(f"<body><article><p>x</p><{start}><p>{PARAGRAPH}</p></{tag}></article></body>", None) == "x"


ARTICLE = f"<article><h1>Title</h1><p>{PARAGRAPH * 3}</p></article>"
TEXT = f"Title\n{(PARAGRAPH * 3).strip()}"


@pytest.mark.parametrize("html", [
    f"<body><form id='aspnet'><input><div>{ARTICLE}</div></form></body>",
    f"<body><form action=x><div>{ARTICLE}</div></body>",
    f"<body><nav><ul><li><a href=x>Home</a><li>News</ul>{ARTICLE}</body>",
    f"<body><div><nav><ul><li>Home</ul><div>{ARTICLE}</div></div><nav><p>second</p></nav></body>",
    f"<body><select><option>one<option>two{ARTICLE}</body>",
    f"<body><div class='social-news'>{ARTICLE}</div></body>",
    f"<body><div class='login-enabled'><p>x</p>{ARTICLE}</div></body>",
    f"<body><div class='comments-open'>{ARTICLE}<section class='comments'><article>{PARAGRAPH * 9}</article></section></div></body>",
    f"<body><div id='search'>{ARTICLE}</div><p>short</p></body>",
    f"<body><div id='app' hidden>{ARTICLE}</div></body>",
    f"<body><div style='color:red; display: none'><p>{PARAGRAPH}</p></div>{ARTICLE}</body>",
    f"<body><aside><p>note</p>{ARTICLE}</aside></body>",
    f"<head><title>t</title><meta a=b><body>{ARTICLE}",
    f"<body><form><h1>Title</h1><p>{PARAGRAPH * 3}</p></form></body>",
    f"<body><div hidden><h1>Title</h1><p>{PARAGRAPH * 3}</p></div></body>",
    f"<body><div class='social-news'><h1>Title</h1><p>{PARAGRAPH * 3}</p></div></body>",
    f"<body><div class='social-news'><div class='entry-content'><h1>Title</h1><p>{PARAGRAPH * 3}</p></div><div class='comments'><p>{PARAGRAPH * 9}</p></div></div></body>",
])
def test_wrappers_and_unclosed_elements_lose_no_article(html):
    assert main_text(html, None) == TEXT


@pytest.mark.parametrize(("html", "text"), [
    (f"<body><div class='text'><p>{PARAGRAPH * 2}</p></div><section class='comments'><article><p>{PARAGRAPH}</p></article><article><p>{PARAGRAPH}x</p></article></section>", (PARAGRAPH * 2).strip()),
    (f"<body><article><p>{PARAGRAPH}</p></article><form><div class='content'><p>{PARAGRAPH * 9}</p></div></form>", PARAGRAPH.strip()),
    (f"<body><form><h1>Title</h1><p>{PARAGRAPH * 3}</p></form><p>short</p></body>", f"{TEXT}\nshort"),
    ("<body><div class='menu-wrapper'><a href=x>Home</a> <a href=y>About</a></div></body>", ""),
    (f"<body><section class='post-comments'><p>{PARAGRAPH * 9}</p></section></body>", ""),
    (f"<body><article><p>a <span hidden>b</span>c<span style='display:none'>d <i>e</i></span> f</p></article>", "a c f"),
    (f"<body><nav><p>menu</p></nav><footer><p>{PARAGRAPH * 9}</p></footer></body>", ""),
])
def test_zones_stay_out_beside_text(html, text):
    assert main_text(html, None) == text


def test_site_text():
    assert main_text(site(7), None) == f"Title 7\n{PARAGRAPH.strip()}\none\ntwo bold"
    assert Page(site(7)).best() == Page(site(8)).best()


def test_deep_and_long_pages_end():
    assert main_text("<div>" * 3000 + "x" + "</div>" * 10, None) == "x"
    assert len(main_text("<p>" + "word " * 200_000, None)) == 999_999
    assert main_text("<a b=\"" * 5000 + "x", None) is not None


def test_host_consensus_wins_over_a_page(spark):
    """A page whose largest container is a list of quotes follows its host, whose container holds a fair share too."""
    odd = site(9, "").replace("<section class='comments'>", f"<div class='quotes'><p>{PARAGRAPH * 3}</p></div><section class='comments'>")
    rows = [(k, f"http://User@Example.com:80/{k}?q#f", site(k)) for k in range(5)] + [(9, "https://example.com", odd), (10, "http://other.org/", odd), (11, None, None), (9, "https://example.com", odd)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS N_chars")
    got = extract_pages(pages)
    assert got.columns == ["page_id", "url", "html", "host", "text", "n_chars"]
    texts = {(r.page_id, r.url): (r.text, r.n_chars) for r in got.collect()}
    own = f"Title 9\n{PARAGRAPH.strip()}\none\ntwo bold"
    assert texts[9, "https://example.com"] == (own, len(own)) and texts[11, None] == ("", 0)
    assert texts[10, "http://other.org/"][0].count("Words") == 3 and got.count() == 9
    assert extract_pages(pages.limit(0)).collect() == []
    votes = host_paths(pages.selectExpr("'h' AS host", "html")).first()
    assert votes.winners[0] == Page(site(1)).best()


def test_all_paths_of_a_host_have_votes(spark):
    """Forty templates on a host: the rarest one still decides for a page whose largest container is another."""
    def page(k, extra=""):
        return f"<body><div class='x{'abcdefghij'[k // 10]}{'abcdefghij'[k % 10]}'><p>{PARAGRAPH * 3}{k}</p></div>{extra}</body>"

    rows = [(k * 10 + n, f"http://h.com/{n}", page(k) + " " * n) for k in range(40) for n in range(2 + (k < 30))]
    rows.append((999, "http://h.com/odd", page(39, f"<div class='quotes'><p>{PARAGRAPH * 9}</p></div>")))
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows) and got[999] == f"{PARAGRAPH * 3}39"
    paths = host_paths(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("'h' AS host", "html")).first().winners
    assert len(paths) == 41


def test_small_container_of_another_template_does_not_win(spark):
    """Lists are the majority of the host; its articles hold a short list of teasers too."""
    rows = [(k, f"http://h.com/{k}", f"<body><div class='list'><p>{PARAGRAPH * 5}{k}</p></div></body>") for k in range(6)]
    rows += [(k, f"http://h.com/{k}", f"<body><div class='list'><p>{PARAGRAPH}</p></div><div class='text'><p>{PARAGRAPH * 9}{k}</p></div></body>") for k in range(6, 8)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"{PARAGRAPH * (5 if k < 6 else 9)}{k}" for k in range(8)}


def test_articles_of_own_templates_beside_lists(spark):
    """Each article has a path of its own and a one-paragraph list; the host's list pages are in the majority."""
    long = (PARAGRAPH * 30).strip()
    rows = [(k, f"http://h.com/{k}", f"<body><div class='list'><p>{PARAGRAPH * 5}{k}</p></div></body>") for k in range(6)]
    starts = ["article class='post-alpha'", "article class='post-beta'", "div class='own gamma'"]
    rows += [(10 + k, f"http://h.com/a{k}", f"<body><{x}><p>{long}</p></{x.split()[0]}><div class='list'><p>{PARAGRAPH}</p></div></body>") for k, x in enumerate(starts)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[10 + k] for k in range(3)] == [long] * 3 and got[0] == f"{PARAGRAPH * 5}0"


def plain_extract(pages):
    """The vote in plain Python, over (url, html) pairs."""
    def host(url):
        return (re.search(r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", url or "") or ["", ""])[1].lower()

    read = [Page(html or "") for _, html in pages]
    votes = Counter((host(url), page.best()) for (url, _), page in zip(pages, read))
    texts = []
    for (url, _), page in zip(pages, read):
        ranked = sorted((-votes[host(url), path], path) for path in page.candidates() if votes[host(url), path])
        texts.append(page.text(ranked[0][1]) if ranked else "")
    return texts


@pytest.mark.parametrize("part_pages", [3, 10_000])
def test_equals_plain_voting(spark, part_pages, monkeypatch):
    monkeypatch.setattr("agentlake.llm.html_extract.PART_PAGES", part_pages)
    r = random.Random(part_pages)
    names = ["list", "post-{}", "entry", "col-{}", "quotes", "wrap", "text slug{}", "sidebar"]

    def element(depth):
        kind = r.choice(["div", "section", "article", "td"])
        inner = "".join(element(depth - 1) for _ in range(r.randint(0, 2))) if depth else ""
        words = " ".join(r.choice("abcdefgh") * 5 for _ in range(r.randint(0, 30)))
        return f"<{kind} class='{r.choice(names).format(r.randint(0, 3))}'><p>{words}.</p>{inner}</{kind}>"

    templates = [[element(2) for _ in range(3)] for _ in range(6)]
    pages = [(r.choice(["http://a.com/x", "https://u@B.org:8/y?z", None, "mailto:x", "http://a.com/z"]), "<body>" + r.choice(r.choice(templates)) + r.choice(["", element(1), r.choice(templates)[0]]) + "</body>") for _ in range(300)]
    pages += [(None, None), ("http://a.com/x", "")] + pages[:5]
    df = spark.createDataFrame([(k, u, h) for k, (u, h) in enumerate(pages)], "page_id long, url string, html string").repartition(7)
    got = {x.page_id: x.text for x in extract_pages(df).collect()}
    assert [got[k] for k in range(len(pages))] == plain_extract(pages)
