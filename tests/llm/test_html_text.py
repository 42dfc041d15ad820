import html
import re

from millrace.llm.html_text import SURGE, extract, main_text, spread
from millrace.llm.queries import queries
from millrace.llm.shared import table

SF = "/root/testdata/sf0.01"
LONG = "A paragraph that is long enough to be told from what menus say, with words enough to surge. " * 2


def test_query_finds_each_article(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, SF, "pages").collect()}
    rows = queries()["op5_line_blocks"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_without_article_element():
    page = f"""<html><head><title>T</title></head><body>
      <div id="menu"><a href="/">Home</a> <a href="/b">News of the day and of the week and of the month and of the year</a></div>
      <div><ul><li><a href="/1">one</a></li><li><a href="/2">two</a></li></ul></div>
      <div class="content"><h2>Head &amp; line</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>
      <div class="cookie-notice"><p>{LONG}</p></div><div id="comments"><p>{LONG}</p></div>
      <div class="sidebar"><p>{LONG}</p></div><form><p>{LONG}</p></form><footer><p>{LONG}</p></footer></body></html>"""
    assert main_text(page).split("\n") == ["Head & line", LONG.strip(), "Short.", LONG.strip()]


def test_inside_an_article():
    page = f"""<article><header><h1>Title</h1></header><p>One<br>two &nbsp; three&#33;</p><aside>No</aside>
      <div class="ad">No</div><p>{LONG}</p><!-- <p>No</p> --><script>if (a < b) "<p>No</p>"</script>
      <section class="comments"><p>No</p></section><blockquote>Said.</blockquote></article><p>No</p>"""
    assert main_text(page).split("\n") == ["Title", "One two three!", LONG.strip(), "Said."]


def test_boilerplate_left_open_does_not_swallow_the_article():
    assert main_text(f"<nav><ul><li>Menu<article><p>{LONG}</article>") == LONG.strip()
    assert main_text(f"<article><p>{LONG}</p></article><footer>No<p>No") == LONG.strip()


def test_surge_and_dive():
    lines = [("menu", 4), ("", 0), ("", 0), ("", 0), ("a" * 50, 0), ("b" * 50, 0), ("", 0), ("", 0), ("", 0), ("end", 0)]
    assert spread(lines, SURGE) == ["a" * 50, "b" * 50]
    assert spread([], SURGE) == [] and spread([("x", 1)], SURGE) == []
    assert spread([("short", 0), ("", 0), ("", 0), ("", 0), ("menu", 4)], SURGE) == ["short"]


def test_edges(spark):
    huge = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    pages = [(1, None, None), (2, "u", ""), (3, "u", "<"), (4, "u", "no markup"), (5, "u", "<p"), (None, "u", huge), (5, "u", "<p")]
    made = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string")
    rows = extract(made).collect()
    assert len(rows) == 7
    assert {r["page_id"]: r["text"] for r in rows if r["page_id"]} == {1: "", 2: "", 3: "<", 4: "no markup", 5: ""}
    assert len([r for r in rows if r["page_id"] is None][0]["text"].split("\n")) == 20_000
    assert extract(made.limit(0)).collect() == []


def test_names_that_do_not_set_an_article_apart():
    assert main_text(f'<body class="no-sidebar"><article class="post has-sidebar"><p>{LONG}</p></article>') == LONG.strip()
    nested = f'<div class="post"><p>{LONG}</p><div><p>Short.</p></div><div><p>{LONG}</p></div></div>'
    assert main_text(nested).split("\n") == [LONG.strip(), "Short.", LONG.strip()]
    assert main_text("<p>Short page.</p>") == "Short page."


def test_silent_elements_end_at_their_own_end_tag():
    article = f"<article><p>{LONG}</p></article>"
    for lead in (
        "<html><head><title>T</title><meta charset=utf-8><body>",
        "<html><head id=header><title>T</title>",
        "<script>for(i=0;i<n;i++)f();</script>",
        "<script>if(a<b&&c>d)'<!--'</script >",
        "<style>a<b{}</STYLE>",
        "<title>a <b</title>",
        "<noscript>No",
        "<script src=x />",
        "<select><option>No<option>No</select>",
    ):
        assert main_text(lead + article) == LONG.strip(), lead
    assert main_text(article + "<script>if (a < b) '<p>No'") == LONG.strip()
    assert main_text(article.replace("</p>", "</p><script>i<n;</script><p>End.</p>")).endswith("\nEnd.")


def test_doubtful_names_inside_an_article_are_judged_by_their_blocks():
    page = f"""<article><header class="entry-header"><h1>Title</h1></header><p>{LONG}</p>
      <section class="discussion"><h2>Discussion</h2><p>Short.</p></section><div class="related-work"><p>{LONG}</p></div>
      <h2 class="section-header">Sub</h2><div class="related"><h3>Related</h3><ul><li><a href="/">No</a><li><a>No</a></ul></div>
      <div class="tags"><span>No</span></div><div class="review"><div class="legal">No</div><p>{LONG}</p></div></article>"""
    text = LONG.strip()
    assert main_text(page).split("\n") == ["Title", text, "Discussion", "Short.", text, "Sub", text]


def test_comments_marked_as_articles_are_dropped():
    text, comment = LONG.strip(), f"<p>No {LONG}</p>"
    for after in (
        f"<div id='comments'><article>{comment}</article></div>",
        f"<section class='comments'><article class='c1'><article>{comment}</article></article></section>",
        f"<article class='comment-body'>{comment}</article>",
        f"<article class='comment'>{comment}<article class='reply'>{comment}</article></article>",
        f"<footer><article>{comment}</article></footer>",
    ):
        assert main_text(f"<article><p>{LONG}</p></article>" + after) == text, after
        assert main_text(f"<article><p>{LONG}</p>{after}</article>") == text, after
        assert main_text(f"<div><p>{LONG}</p></div>" + after) == text, after
    assert main_text(f"<article class='post has-comments'><p>{LONG}</p></article>") == text


def test_short_first_and_last_containers_without_an_article():
    text, menu = LONG.strip(), "<div><ul><li><a href='/1'>one</a></li><li><a href='/2'>two</a></li></ul></div>"
    page = f"{menu}<div><h1>Title</h1></div><div>By someone</div><div><p>{LONG}</p></div><div>The end.</div>{menu}<div>No.</div>"
    assert main_text(page).split("\n") == ["Title", "By someone", text, "The end."]
    assert main_text(f"<div>Site name</div><div><p>{LONG}</p></div><div>Copyright 2020. All rights reserved.</div>") == text
    between = f"<div><p>{LONG}</p><p><a href='/x'>A paragraph that is one link</a></p><p>{LONG}</p></div>{menu}"
    assert main_text(between).split("\n") == [text, "A paragraph that is one link", text]


def test_generated_pages_without_an_article_are_told_apart():
    """Every mix of menus, sidebars and comments around a body; the body's blocks are known."""
    import itertools
    import random

    rng = random.Random(3)
    menu = "<div class=top><ul>" + "".join(f"<li><a href='/{i}'>Topic number {i}</a>" for i in range(8)) + "</ul></div>"
    side = f"<div class='sidebar'><p>No {LONG}</p></div>"
    notes = f"<section id=comments><article><p>No {LONG}</p></article></section>"
    for before, after in itertools.product(("", menu, side, menu + side), ("", menu, notes, side + notes, notes + menu)):
        body = [" ".join(rng.choice(LONG.split()) for _ in range(rng.randrange(20, 60))) + "." for _ in range(rng.randrange(1, 6))]
        page = f"<body>{before}<div><h1>The head</h1></div><div>{''.join(f'<p>{b}</p>' for b in body)}</div>{after}</body>"
        assert main_text(page).split("\n") == ["The head", *body], (before, after)


def test_deeply_nested_pages_take_linear_time():
    import time

    start = time.process_time()
    deep = 60_000
    for page in (
        "<div>" * deep + f"<p>{LONG}" + "</div>" * deep,
        "<section><div>" * deep + f"<p>{LONG}" + "</article>" * deep,
        "<nav><article>" * deep + f"<p>{LONG}",
        "<article><div class=related>" * deep + f"<p>{LONG}",
    ):
        assert main_text(page) == LONG.strip()
    assert time.process_time() - start < 60
