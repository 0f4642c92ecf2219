from depot.llm import html_blocks as H

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x";</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/a">a</a><li><a href="/b">b</a></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy the best of the best for you and the ones that you have.</div><div id="cookie-notice">We use cookies on this site and so on and on.</div>
<article><h1>Head &amp; more</h1><p><b>First   line<br>goes&nbsp;on</p><p>Short.<p>A &lt;b&gt; &#233; the long paragraph of the article that is here and has the words of it, and more of them to the end.
<ul><li>one<li>two</ul><div class="sidebar">no</div><aside>no</aside><form>no<input></form><blockquote>Said &amp;amp;</blockquote></article>
<section class="comments"><p>What a fine thing that is, and I have said so to all of them, so there it is.</p></section><footer>&copy; me</footer></body></html>"""


def test_article():
    assert H.main_text(ARTICLE).split("\n\n") == ["Head & more", "First line goes on", "Short.",
        "A <b> é the long paragraph of the article that is here and has the words of it, and more of them to the end.", "one", "two", "Said &amp;"]


def test_without_article_tags():
    long = "It is the one of them that has been with us for all of the time that we had, and so on to the end of it."
    page = f"<body><div><a href=x>Home</a> <a href=y>About us all</a></div><div><h2>Title here</h2><p>{long}</p><p>Yes.</p><p>{long}</p></div><div class='footer'>Imprint</div><div><a href=z>More links in this place</a></div></body>"
    assert H.main_text(page).split("\n\n") == ["Title here", long, "Yes.", long]


def test_odd_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<nav>x</nav>") == H.main_text("<script>var a = '<p>") == ""
    assert H.main_text("<article><p>cut off <b>here <a hre") == "cut off here"
    assert H.main_text("<article><p>a < b and c > d</p><p title=\"x>y\">e</p>") == "a < b and c > d\n\ne"
    assert H.main_text("<article>" + "<p>word " * 20_000).count("word") == 20_000
    assert H.main_text("<article>" + "<" * 50_000 + "<p 'x" * 300) is not None


def test_query_shape(spark):
    df = spark.createDataFrame([(1, "u", ARTICLE, "clash"), (1, None, None, "clash"), (None, "v", "", "c")], "page_id long, url string, html string, text string")
    rows = H.extract(df).collect()
    assert len(rows) == 3 and sorted(r.n_chars for r in rows)[:2] == [0, 0] and all(r.n_chars == len(r.text) for r in rows)
    assert H.extract(df.limit(0)).count() == 0


def test_attributes_by_whole_name():
    long = "It is the one of them that has been with us for all of the time that we had, and so on to the end of it."
    for attrs in ('style="overflow:hidden"', 'title="The hidden valley"', 'data-hidden="false"', 'data-class="sidebar"', "title='id=footer'", 'data-x=hidden', 'title="a\' class=ad"',
                  'style = "x" title = "role=navigation"', "hiddenx", 'data-role="search"', "x/=hidden", 'class="main" class="ad"'):
        assert H.main_text(f"<body><div {attrs}><div><p>{long}</p></div></div>") == long, attrs
    for attrs in ("hidden", "HIDDEN=''", "hidden/", 'title="a"hidden', 'style="x" class="ad"', "id = footer", "role='Navigation'", "aria-hidden=true", 'title="a" aria-hidden="TRUE"', 'class="a&#32;sidebar"'):
        assert H.main_text(f"<body><div {attrs}><div><p>{long}</p></div></div>") == "", attrs


def test_languages_without_stop_words():
    chinese = "这个城市的老图书馆在去年春天重新开放，许多居民带着孩子来到这里读书。" * 3
    polish = "Stara biblioteka miejska została ponownie otwarta wiosną ubiegłego roku, mieszkańcy przychodzą tutaj czytać książki."
    for text in (chinese, polish):
        page = f"<body><div><a href=x>{text}</a></div><div><h2>A</h2><p>{text}</p><p>B</p><p>{text}</p></div><div class='footer'>{text}</div></body>"
        assert H.main_text(page).split("\n\n") == ["A", text, "B", text]
    english = "It is the one of them that has been with us for all of the time that we had, and so on to the end of it."
    assert H.main_text(f"<body><p>{english}</p><div>{'Product number price cart ' * 5}</div></body>") == english
    assert H.main_text(f"<body><article><p>Short</p></article><div>{'Product number price cart ' * 5}</div></body>") == "Short"


def test_names_count_as_a_whole():
    """States of a wrapper are no furniture; weak names inside an article keep prose; strong ones do not."""
    long = "It is the one of them that has been with us for all of the time that we had, and so on to the end of it."
    for wrapper in ('class="content has-sidebar"', 'id="no-sidebar"', 'class="post comments-open"', 'class="with_menu main"', 'class="footer-less"'):
        assert H.main_text(f"<body><div {wrapper}><h2>Title</h2><p>{long}</p><p>Short.</p></div></body>").split("\n\n") == ["Title", long, "Short."], wrapper
    for inside in ('class="search-result"', 'class="alert"', 'id="social"', 'class="widget area"'):
        assert H.main_text(f"<article><p>{long}</p><div {inside}><p>{long}</p></div></article>").split("\n\n") == [long, long], inside
    links = "<a href=x>" + "to the one of them that is in the list of it and so on, " * 2 + "</a>"
    for inside, body in (('class="social"', "Share this"), ('class="social"', links), ('class="comments"', long), ('class="post-comments"', long), ('id="comment-12"', long),
                         ('class="ad-slot-1"', long), ('class="cookie-banner"', long), ('class="related-posts"', long), ('class="newsletter box"', long), ('class="main-nav"', long)):
        assert H.main_text(f"<article><p>{long}</p><div {inside}><p>{body}</p></div></article>") == long, (inside, body)
    for outside in ("site-header", "header", "page_header", "sidebar-left", "social", "search", "widget-area", "alert"):
        assert H.main_text(f"<body><div class='{outside}'><p>{long}</p></div><div><p>{long} More.</p></div></body>") == f"{long} More.", outside
