import html
import re

import pytest

from palimpsest.llm import html_text as H

from .helpers import SF


def test_articles_of_the_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in H.extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        body = r["html"].split("<article>", 1)[1].split("</article>")[0]
        body = re.sub(r"<[^>]*>|<[^>]*$", lambda m: " " if re.match(r"</?(p|h1|br)\b", m.group()) else "", body)
        want = " ".join(html.unescape(body).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain text", "plain text"), ("<p>x", "x"), ("a < b &amp; c", "a < b & c"),
    ("<!-- <p>no</p> --><p>yes</p>", "yes"), ("<!-- open <p>no", ""), ("<script>if (a</b) x='</p>'</script><p>yes</p>", "yes"),
    ("<p>one<p>two", "one two"), ("<p>fo<b>o</b>t", "foot"), ("<p>a<br>b</p>", "a b"), ("<p>a&nbsp;&#65;&#x42;&lt;p&gt;</p>", "a AB<p>"),
    ("<p title='x > y'>t</p>", "t"), ("<p>cut <a href='", "cut"), ("<ul><li>one<li>two</ul>", "one two"),
])
def test_markup(source, text):
    assert H.main_text(source) == text


def page(article, before="", after=""):
    return f"<html><head><title>T</title></head><body class='no-sidebar'>{before}<div id='content'><div class='text'>{article}</div></div>{after}</body></html>"


LONG = "<p>" + "lorem ipsum dolor sit amet consectetur " * 6 + "</p>"


@pytest.mark.parametrize("junk", [
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<header><h1>Site</h1></header>", "<footer>&copy; me</footer>",
    "<div class='cookie-notice'>We use cookies and want you to know about them now</div>", "<aside><p>side story of another kind</p></aside>",
    "<div class='ad'>Buy now</div>", "<form><label>Name</label><input name='a'><button>Send</button></form>", "<style>p{}</style>",
    "<section id='comments'><article class='comment'><p>Great post, thank you so much for it</p></article></section>", "<div role='navigation'>Go</div>",
    "<div class='sidebar'><p>Recent posts and so on and so on</p></div>"])
def test_what_is_not_the_article_is_left_out(junk):
    want = " ".join(re.sub("<[^>]*>", " ", LONG * 3).split())
    assert H.main_text(page(LONG * 3, before=junk)) == want
    assert H.main_text(page(LONG * 3, after=junk)) == want
    assert H.main_text(f"<body>{junk}<article>{LONG * 3}</article></body>") == want


@pytest.mark.parametrize("mark", ["class='content no-sidebar'", "id='page-with-header'", "class='post has-comments'", "class='wrap' id='sidebar-none'", "class='widget'"])
@pytest.mark.parametrize("tag", ["div", "section"])
def test_a_wrapper_of_the_article_stays(tag, mark):
    want = " ".join(re.sub("<[^>]*>", " ", LONG * 3).split())
    junk = "<div class='cookie-notice'>We use cookies</div><div class='sidebar' id='ad-2'><p>Recent posts</p></div>"
    assert H.main_text(f"<body>{junk}<{tag} {mark}>{LONG * 3}</{tag}>{junk}</body>") == want


@pytest.mark.parametrize("tag", ["form", "dialog", "object"])
def test_a_form_around_the_page_does_not_take_the_article_along(tag):
    want = " ".join(re.sub("<[^>]*>", " ", LONG * 3).split())
    control = "<label>Name</label><input name='a'><select><option>one</select><textarea>write</textarea><button>Send</button>"
    login = "<form><p>Sign in to your account here</p></form>" if tag != "form" else ""
    for article in (f"<div>{LONG * 3}</div>", f"<article>{LONG * 3}</article>"):
        assert H.main_text(f"<body><{tag} action='x'>{login}<nav><a href='/'>Home</a></nav>{article}{control}</{tag}></body>") == want
    # the article outside it: then it goes, however long
    assert H.main_text(f"<body><{tag}>{'<p>terms and conditions apply to all</p>' * 90}</{tag}><article>{LONG * 3}</article></body>") == want


@pytest.mark.parametrize("source", ["<b>" * 60_000 + "</i>" * 60_000 + "x", "<i><div>" + "<b>" * 60_000 + "</i>" * 60_000 + "x", "<b>" * 60_000 + "<hr>" * 60_000 + "x",
                                    "<p>" + "<b>" * 60_000 + "<li>" * 60_000 + "x", "</p>" * 60_000 + "x"])
def test_unmatched_tags_take_linear_time(source):
    import time

    start = time.process_time()
    assert H.main_text(source) == "x"
    assert time.process_time() - start < 10


def test_pages_without_article_elements_by_density():
    """Columns of links around a column of text: the text wins."""
    links = "<div>" + "".join(f"<p><a href='/{i}'>story {i} about something else</a> today</p>" for i in range(12)) + "</div>"
    want = " ".join(re.sub("<[^>]*>", " ", LONG * 5).split())
    got = H.main_text(f"<body><div id='wrap'>{links}<div id='text'>{LONG * 5}</div>{links}</div></body>")
    assert got == want


def test_links_outside_the_core_lose():
    menu = "<div>" + "".join(f"<div><a href='/{i}'>some other story number {i}</a></div>" for i in range(20)) + "</div>"
    assert "other story" not in H.main_text(page(LONG * 4, before=menu, after=menu))


def test_deep_and_long_pages():
    assert H.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert len(H.main_text("<article>" + "<p>word word</p>" * 20_000 + "</article>")) == 20_000 * 10 - 1


def test_odd_rows(spark):
    rows = [(1, "u", None), (None, None, "<p>x</p>"), (1, "u", "<p>x</p>"), (2, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = H.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and sorted(r["text"] for r in got.collect()) == ["", "", "x", "x"]
    assert H.extract(df.where("false")).count() == 0
