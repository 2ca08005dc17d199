import pytest

from sparkcivic.llm import html_text as h

PAGE = """<html><head><title>T &amp; t</title><style>p{x:"</p>"}</style></head><body class="has-sidebar">
<div id="cookie-banner">We use cookies, please accept them all now</div><div class="site-header"><a href=/>Home</a></div>
<ul class=menu><li><a href=1>Eins</a><li><a href=2>Zwei</a></ul>
<div class="content"><h1>Title &amp; more</h1><p>First <b>para</b>graph with quite some text to read, it is the article.
<p>Second one<br>here, also&nbsp;long enough to count as content.</p><p>Short.</p>
<div class="ad">Buy now this great thing that you need</div><p>Third paragraph with more words for the reader.</p></div>
<div class="sidebar"><p>Other stories that you may like to read when bored</p></div>
<div id="comments"><div class="comment"><p>I liked this article very much, thanks for it.</p></div></div>
<form><p>Subscribe here</p></form><footer>(c) a site with a long imprint</footer></body>"""


def test_region_by_density_without_semantic_tags():
    assert h.extract(PAGE).split("\n\n") == [
        "Title & more", "First paragraph with quite some text to read, it is the article.",
        "Second one here, also long enough to count as content.", "Short.", "Third paragraph with more words for the reader."]


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<script>x</script>", ""), ("plain", "plain"), ("<p>a<p>b", "a\n\nb"), ("<<p>>a</p", "<\n\n>a"),
    ("<article><h1>A</h1><p><b>A one.<br><p>Two</article><footer>x</footer>", "A\n\nA one.\n\nTwo"),
    ("<main><p>hello</p><nav>n</nav><article class=comment>no</article></main>", "hello"),
    ("<article><p>x &lt;b&gt; &#233;&eacute;</p><aside>s</aside><p hidden>h</p></article>", "x <b> éé"),
    ("<article><p>a\n\t  b</p><div class='share-buttons'>tweet</div><pre>c  d</pre></article>", "a b\n\nc d"),
])
def test_cases(html, text):
    assert h.extract(html) == text


def test_named_content_beside_a_longer_list():
    page = """<body><div id="post-1" class="entry-content"><h2>Head</h2><p>Some words of the article that is short.</p>
<p>Tiny.</p></div><div class="x"><p>Another block, which nothing names</p></div><table><tr><td>cell</td></tr></table></body>"""
    assert h.extract(page) == "Head\n\nSome words of the article that is short.\n\nTiny."


def test_comments_and_headers_of_other_layouts():
    page = """<header><h1>Site</h1></header><main><h1>T</h1><p>Text of the article, long enough to count.</p>
<section id="comments"><ol class="commentlist"><li><p>nice</p></li></ol></section>
<div class="cookieNotice">ok?</div><div class="page_content"><p>More text</p></div></main><div role="contentinfo">imprint</div>"""
    assert h.extract(page) == "T\n\nText of the article, long enough to count.\n\nMore text"


STORY = "".join(f"<p>Paragraph {i} of the story, which is long enough for a cluster.</p>" for i in range(6))
STORY_TEXT = "\n\n".join(f"Paragraph {i} of the story, which is long enough for a cluster." for i in range(6))


@pytest.mark.parametrize("page", [
    f"<main>{STORY}<article>%s</article></main>",
    f"<main>{STORY}<article class='promo'>%s</article></main>",
    f"<div class=content>{STORY}</div><div><article>%s</article></div>",
    f"<div class=x>{STORY}</div><article><p>%s</p></article>",
    f"<main><p>%s</p></main><div class=x>{STORY}</div>",
])
def test_a_teaser_in_an_article_is_not_the_region(page):
    got = h.extract(page % "A teaser of something else.")
    assert got == STORY_TEXT


@pytest.mark.parametrize("page", [
    f'<div class="wrapper no-sidebar"><article>{STORY}</article></div>',
    f'<div id="content" class="has-sidebar">{STORY}<div class="widget"><p>Popular this week</p></div></div>',
    f'<div class="layout two-sidebars search"><div id="cookie-banner">We use cookies</div>{STORY}</div>',
    f'<div class="page-header-layout"><div class="layout search"><main>{STORY}</main><div class="sidebar">More of it</div></div></div>',
    f'<article class="post has-sidebar comments-open">{STORY}</article><div class="related"><article><p>Teaser</p></article></div>',
    f'<div class="layout search">{STORY}</div><article>A teaser.</article>',
    f'<article>{STORY}</article><div class="comments">' + "<p>I also think so, and so does everyone else here.</p>" * 20 + "</div>",
    f'<div class="wrapper no-sidebar"><article>{STORY}</article><div class="ad">{"Buy this now. " * 20}</div></div>',
    f'<main>{STORY}<div class="related"><article>A teaser of something else.</article></div></main>',
])
def test_names_of_layouts_drop_no_text(page):
    assert h.extract(page) == STORY_TEXT


def test_a_long_advert_beside_a_short_article_goes():
    assert h.extract(f"<div class=ad>{'Buy this now. ' * 20}</div><article><h1>Head</h1><p>{'A short story. ' * 8}</p></article>") == (
        "Head\n\n" + ("A short story. " * 8).strip())


def test_nested_names():
    deep = "<div class=comment>" * 2000 + "x" + "</div>" * 2000
    assert h.extract(f"<article>{STORY}</article>{deep}") == STORY_TEXT


def test_an_article_that_holds_most_text_is_the_region():
    assert h.extract(f"<div class=content><p>Before the article.</p><article>{STORY}</article></div>") == STORY_TEXT


def test_smoothing_keeps_a_constant():
    import numpy as np
    assert np.allclose(h.smoothed(np.full(9, 3.0)), 3.0)


def test_rows(spark):
    long = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, PAGE, "y"), (None, long, "z")], "page_id long, html string, text string")
    got = df.select("page_id", h.main_text(df["html"]).alias("out")).collect()
    assert sorted(len(r["out"]) for r in got)[:2] == [0, 0] and max(len(r["out"]) for r in got) == 30_000 * 6 - 2
    assert df.limit(0).select(h.main_text(df["html"])).count() == 0


@pytest.mark.parametrize("page", [
    f"<body><form id=aspnetForm><nav><a href=1>Home</a></nav><article>{STORY}</article><footer>imprint</footer></form></body>",
    f"<body><form id=aspnetForm><div>{STORY}</div></form></body>",
    f"<fieldset>{STORY}</fieldset>", f'<body style="visibility:hidden">{STORY}</body>', f"<body hidden><div>{STORY}</div></body>",
    f'<div aria-hidden="true"><div class=x>{STORY}</div></div><p>Short.</p>'.replace("<p>Short.</p>", ""),
    f"<div role=dialog>{STORY}</div>", f"<div role=status><main>{STORY}</main></div>", f"<header><article>{STORY}</article></header>",
    f'<div style="display: none"><article>{STORY}</article></div><nav><a href=x>Home</a></nav>',
])
def test_marks_around_a_whole_page_lose_no_text(page):
    assert h.extract(page) == STORY_TEXT


@pytest.mark.parametrize("page", [
    f"<article>{STORY}</article><form><p>Give us your mail address and we will write to you.</p><p>We do so often.</p></form>",
    f"<article>{STORY}<aside><p>Something else that you may like to read as well.</p><p>And more.</p></aside></article>",
    f"<div>{STORY}</div><div role=dialog><p>Do you agree with all of our many rules?</p><p>You should.</p></div>",
    f"<div>{STORY}<p hidden>Not to be seen by any reader of this page, ever.</p></div>",
    f"<div><article>{STORY}</article>" + "<article><p>A teaser of one more story.</p></article>" * 8 + "</div>",
    f"<article>{STORY}<section><h3>3 Comments</h3><p>I also think so.</p><p>Me too.</p></section></article>",
    f"<article>{STORY}<h2>Comments (2)</h2><div><b>Ann</b> I also think so.</div><div>Me too.</div></article>",
    f"<article>{STORY}</article><!-- <article><p>hidden text that is not closed",
])
def test_marked_parts_beside_the_story_go(page):
    assert h.extract(page) == STORY_TEXT


def test_a_long_text_under_a_comments_heading_stays():
    assert h.extract(f"<article><p>Intro.</p><h2>Comments</h2>{STORY}</article>") == "Intro.\n\nComments\n\n" + STORY_TEXT


@pytest.mark.parametrize("unit,end", [
    ("<div>x", ""), ("<b>x<i>", ""), ("<!-- x", ""), ("&amp;&#233;&x;", ""), ("<div class=comment>x", ""), ("<form>x ", ""), ("<article>x", ""),
    ("<p>x</b>", ""), ("<b>", "</u>"), ("<div><b>", "</div>"), ("<li>x", "</ul>"), ("<a href=1>", "</a>"), ("</div>", "</p>"),
])
def test_time_is_linear_in_broken_markup(unit, end):
    import time
    n = 200_000 // len(unit + end)
    pages = ["<u><div>" + (unit + end) * n, "<u><div>" + unit * n + end * n, unit * n]
    times = []
    for page in pages:
        began = time.process_time()
        h.extract(page)
        times.append(time.process_time() - began)
    assert max(times) < 4, times  # a quadratic step takes minutes
