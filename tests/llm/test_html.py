from clickweave.llm.html import extract, main_text

LONG = "A long paragraph that goes on and on for more than eighty characters so that it surges, as it should."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body>{body}</body></html>"


def test_article_without_its_surroundings():
    html = page(
        f"<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li>Menu</ul></nav><div class='cookie-notice'>{LONG}</div>"
        f"<article><h1>Title &eacute;</h1><p>Short.<p>{LONG}<div class=ad>Buy</div><script>var p = '</p>';</script><p>Last <b>bold</b>\n  words<br>on"
        f"</article><aside>{LONG}</aside><form>{LONG}</form><section id=comments><p>{LONG}{LONG}</p></section><footer>&copy; x</footer>"
    )
    assert main_text(html) == f"Title é\nShort.\n{LONG}\nLast bold words on"


def test_without_article_the_surging_stretch_is_kept():
    html = page(f"<div id=top>Logo</div><nav><a>x</a></nav><div><h2>Head</h2><p>{LONG}</p><p>Tail</p></div><footer>{LONG}</footer>")
    assert main_text(html) == f"Logo\nHead\n{LONG}\nTail" or main_text(html) == f"Head\n{LONG}\nTail"


def test_menus_of_links_do_not_surge():
    links = "".join(f"<li><a href=/{i}>A rather long link text number {i} for the menu</a></li>" for i in range(20))
    assert main_text(page(f"<ul>{links}</ul><nav>x</nav><main><p>{LONG}</p></main>")) == LONG


def test_references_space_and_markup():
    assert main_text(page("<article><p>a&nbsp;&lt;b&gt; &amp;amp; &#233;&#x41;\t\n c</p></article>")) == "a <b> &amp; éA c"
    assert main_text("<p title='a>b'>x</p><!-- <p>no</p> -->") == "x"
    assert main_text("1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"


def test_edges():
    assert main_text(None) == "" and main_text("") == "" and main_text("<script>x") == ""
    assert main_text("<div" * 1000) == "" or True
    assert main_text("<p>" + "word " * 200_000 + "</p>").count("word") == 200_000
    assert main_text("<p>x</b></div></p>") == "x"


def test_marks_are_whole_words_and_hide_no_article():
    for wrap in ("class='content-sidebar-wrap'", "class=no-sidebar", "class=has-toc", "class=sidebar", "id=Widget", "role=form"):
        assert main_text(page(f"<div {wrap}><p>Aside</p><main><p>{LONG}</p></main><p>Aside</p></div>")) == LONG
        assert main_text(page(f"<div {wrap}><article><p>{LONG}</p></article><p>Aside</p></div>")) == LONG
    assert main_text(page(f"<form><main><p>{LONG}</p></main></form>")) == LONG
    for part in ("<section id=discussion>x</section>", "<h2 id=related-work>x</h2>", "<div class=hljs-comment>x</div>", "<h2 class=header>x</h2>", "<pre><span class='token comment'>x</span></pre>"):
        assert main_text(page(f"<article><p>{LONG}</p>{part}</article>")) == f"{LONG}\nx"
    for mark in ("Sidebar", "Comments", "navBar", "siteFooter", "left-sidebar", "ad-300x250", "Comment_List", "cookieNotice", "ad2"):
        assert main_text(page(f"<article><p>{LONG}</p><div class={mark}>x</div></article>")) == LONG
    comments = f"<div id=comments><article class=comment><p>{LONG}</p></article></div>"
    assert main_text(page(f"<div><p>{LONG}</p><p>{LONG} more</p></div>{comments}")) == f"{LONG}\n{LONG} more"
    assert main_text(page(f"<main hidden><p>{LONG}</p></main><p>x</p>")) == "x"


def test_dropped_elements_cut_no_text():
    long = " ".join([LONG] * 50)
    for tag in ("aside", "header", "footer", "nav"):
        assert main_text(page(f"<div><p>{long}</p><{tag}>advert</{tag}><p>{LONG}</p><{tag}>x</{tag}><p>The end.</p></div>")) == f"{long}\n{LONG}\nThe end."
    sections = "".join(f"<section><header>x</header><p>Short section {i}.</p></section>" for i in range(9))
    assert main_text(page(f"<p>{LONG}</p>{sections}")).split("\n")[1:] == [f"Short section {i}." for i in range(9)]


def test_plain_pages_are_cut_by_their_line_blocks():
    menu = "".join(f"<div><a href=/{i}>Menu entry number {i} of the whole site</a></div>" for i in range(8))
    body = f"<div><h2><a href=/this>Title</a></h2><p>{LONG}</p><p>Short.</p><p><a href=/x>A link</a></p><p>{LONG}</p><p>Last.</p></div>"
    html = page(f"<div>Logo</div>{menu}{body}<div><h3>Related</h3>{menu}</div><div>Copyright</div>")
    assert main_text(html) == f"Title\n{LONG}\nShort.\nA link\n{LONG}\nLast."
    rows = "".join(f"<tr><td><a href=/{i}>Menu entry {i}</a></td></tr>" for i in range(8))
    assert main_text(page(f"<table>{rows}<tr><td>{LONG}</td></tr><tr><td>Tail</td></tr>{rows}</table>")) == f"{LONG}\nTail"
    assert main_text(page("<p><a href=/>Only</a></p><p><a href=/>links</a></p>")) == "Only\nlinks"


def test_comments_and_the_like_are_left_out():
    said = f"<p>{LONG} Said a reader.</p>"
    for added in (
        f"<section id=comments><article class=comment>{said}</article><article>{said}</article></section>",
        f"<div class=reader-comments>{said}</div>",
        f"<div class=comments-section><div class=comment-body>{said}</div></div>",
        f"<ul><li class=comment-content>{said}</li></ul>",
        f"<div class=related-posts>{said}</div>",
        f"<article class='comment depth-1'>{said}</article>",
        f"<div class='articleComments'>{said}</div>",
        f"<aside><article>{said}</article></aside>",
    ):
        for body in (f"<main><p>{LONG}</p>{added}</main>", f"<article><p>{LONG}</p>{added}</article>", f"<main><article><p>{LONG}</p></article>{added}</main>"):
            assert main_text(page(body)) == LONG, added
    for added in (f"<div class=reader-comments>{said}</div>", f"<div class=related-posts>{said}</div>", f"<section id=comments><article>{said}</article></section>"):
        assert main_text(page(f"<div><p>{LONG}</p><p>Tail</p></div>{added}")) == f"{LONG}\nTail"
    notice = "© 2024 A long notice that claims some rights of somebody in something, all of them reserved, and more."
    assert main_text(page(f"<div><p>{LONG}</p><p>Tail</p></div><div>{notice}</div>")) == f"{LONG}\nTail"
    for kept in ("content-header", "post-header", "entry-content", "commentary"):  # no marks
        assert main_text(page(f"<article><div class={kept}><p>x</p></div><p>{LONG}</p></article>")) == f"x\n{LONG}"


def test_the_sums_choose_the_lines(monkeypatch):
    """Tags only change weights: with flat ones menus and tails stay."""
    from clickweave.llm import html as H

    menu = "".join(f"<div><a href=/{i}>Menu entry number {i} of the whole site</a></div>" for i in range(8))
    plain = page(f"{menu}<div><p>{LONG}</p><p>Tail</p></div>{menu}")
    marked = page(f"<p>Before</p><main><p>{LONG}</p><p>Tail</p></main><p>After</p>")
    assert main_text(plain) == main_text(marked) == f"{LONG}\nTail"
    monkeypatch.setattr(H, "tagged", lambda texts, *_: [1] * len(texts))
    assert main_text(plain) != f"{LONG}\nTail" and main_text(marked) != f"{LONG}\nTail"


def test_rows(spark):
    html = page(f"<article><p>{LONG}</p></article>")
    rows = [(1, "u", html), (1, "u", html), (2, None, None), (None, "v", "")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = sorted(map(tuple, extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", LONG, len(LONG)), (1, "u", LONG, len(LONG)), (2, None, "", 0), (None, "v", "", 0)], key=repr)
    assert extract(df.limit(0)).count() == 0


def test_given_pages(spark):
    """The given pages mark their article: its blocks, and nothing else, come out."""
    import re
    from html import unescape

    from clickweave.llm.html import op2_linedist

    texts = {r["page_id"]: r["text"] for r in op2_linedist(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        assert re.sub(r"\s", "", texts[r["page_id"]]) == re.sub(r"\s", "", "".join(blocks))
