import pytest

from sparkloom.llm.html_text import extract_pages, main_text, parse

BODY = "<p>First paragraph of the article with words enough to be one.</p><p>Second &amp; last, with <b>bold</b>\n  and <a href='/x'>a link</a>.</p>"
WANT = "Title here\nFirst paragraph of the article with words enough to be one.\nSecond & last, with bold and a link."
NAV = "<nav><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two</a></li></ul></nav>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{NAV}<!-- ad --><div class='ad'>Buy now, this is a good offer for all.</div><article><h1>Title here</h1>{BODY}</article><footer>&copy; site. All rights kept by nobody.</footer></body></html>",
        f"<body><header>Site name</header><div id='content'><h1>Title here</h1>{BODY}</div><aside>Related words, quite a few of them here.</aside><form><label>Mail</label><input><button>Go</button></form></body>",
        f"<body><div class='cookie-notice'>We use cookies, do you accept that?</div><main><h1>Title here</h1>{BODY}<section class='comments'><p>A reader says that this is all wrong indeed.</p></section></main><div class='sidebar'><p>More to read in the sidebar of this page.</p></div></body>",
        f"<BODY><DIV><DIV><H1>Title here</H1>{BODY}</DIV></DIV>{NAV}",
        f"<body>{NAV}<article><h1>Title here</h1><p>First paragraph of the article with words enough to be one.<p>Second &amp; last, with <b>bold</b> and <a>a link</a>.<br></article>",
    ],
)
def test_main_text(page):
    assert main_text(page) == WANT


def test_unclosed_and_cut_pages():
    assert main_text("<article><h1>A</h1><p><b>text one<br><p>two</p></article>") == "A\ntext one\ntwo"
    assert main_text("<body><article><p>cut off in a reference &am") == "cut off in a reference &am"
    assert main_text("<body><article><p>cut in a tag <b clas") == "cut in a tag"
    assert main_text("plain words, no tags") == "plain words, no tags"
    assert main_text("") == main_text("<html></html>") == main_text("<body><nav>only this</nav></body>") == ""
    assert main_text("<body><p>a &lt;b&gt; &#233;&nbsp;&eacute;</p></body>") == "a <b> é é"
    assert parse("<ul><li>a<li>b</ul>").inside[0].inside[1].tag == "li"


def test_one_long_paragraph_keeps_its_heading():
    words = "word " * 5000
    assert main_text(f"<body>{NAV}<article><h1>Head</h1><p><b>{words}<br></article><footer>f</footer></body>") == "Head\n" + words.strip()


def test_pages(spark):
    rows = [(1, "u", "<body><article><p>x y</p></article></body>", "t", 3), (1, "u", "<body><article><p>x y</p></article></body>", "t", 3), (2, None, None, "t", 3), (None, "v", "", "t", 3), (3, "w", "<p>" + "long <i>text</i> " * 40_000, "t", 3)]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 3), (1, 3), (2, 0), (3, 40_000 * 10 - 1)]
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


LONG = "".join(f"<p>Paragraph {i} of the article, {'with words enough to be one and some more to be long. ' * 8}</p>" for i in range(6))


def test_threshold_leaves_out_unnamed_link_blocks_in_a_wrapper():
    links = "<div><ul>" + "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(8)) + "</ul></div>"
    teasers = "<div>" + "".join(f"<div><a href='/{i}'>Teaser {i}</a> more</div>" for i in range(4)) + "</div>"
    for start, end in (("<div>", "</div>"), ("", ""), ("<div><div>", "</div></div>")):
        text = main_text(f"<body>{start}{links}<div><h1>Head</h1>{LONG}<p>Brief.</p></div>{teasers}{end}</body>")
        assert text.startswith("Head\nParagraph 0") and text.endswith("long.\nBrief.") and text.count("\n") == 7


def test_threshold_keeps_dense_parts_with_their_headings():
    text = main_text(f"<body><div><h1>Head</h1><div>{LONG}</div><h2>Second</h2><div>{LONG}</div><h2>Elsewhere</h2><ul><li><a href='/'>x</a></li></ul></div></body>")
    assert text.split("\n")[0] == "Head" and "Second\nParagraph 0" in text and "Elsewhere" not in text and text.count("Paragraph") == 12


@pytest.mark.parametrize("start", ["div class='content with-sidebar'", "div class='has-sidebar'", "div id='no-comments'", "div class='nav-open'", "div class='post share-enabled'", "form action='/page.aspx'", "div class='modal'"])
def test_wrappers_are_not_left_out(start):
    page = f"<body><{start}><div class='site-header'>Name of the site</div><div><h1>Title here</h1>{BODY}</div><form><p>Your mail</p></form></{start.split()[0]}></body>"
    assert main_text(page) == WANT


def test_long_comments_are_left_out():
    assert main_text(f"<body><article><h1>Title here</h1>{BODY}</article><div class='comments'>{LONG}</div></body>") == WANT


def test_header_of_an_article_and_of_a_page():
    page = "<body><header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>This is a long article text about many things, with commas.</p></article></body>"
    assert main_text(page) == "Title\nThis is a long article text about many things, with commas."
