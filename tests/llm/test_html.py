"""Main text of pages: built from known blocks, so the extraction must give them back."""

import html
import random

import pyarrow.parquet as pq
import pytest
from helpers import prose

from barforge.llm import op11_html
from barforge.llm.op11_html import main_text

NAV = '<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>'
MENU = '<div class="main-menu"><a href="/a">Home, sweet home</a> <a href="/b">All the news, every day</a></div>'
HEAD = '<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style><script>var t="</p><article>no</article>";</script></head>'
NOTICES = ['<div class="cookie-notice">We use cookies, as all sites do, and you must know it.</div>', '<div role="alert"><p>Service is slow, sorry, today.</p></div>',
           '<div id="newsletterSignup"><p>Sign up, now, for more, and more.</p></div>', '<p hidden>hidden, text, of, the, page</p>',
           '<div style="display: none"><p>not, seen, by, readers</p></div>']
ADVERTS = ['<div class="ad">Buy this, and that, and those.</div>', '<ins class="adsbygoogle">Buy, buy, buy</ins>',
           '<aside><p>By the way, a long, long, long remark, by our sponsors.</p></aside>', '<div class="sponsored-content"><p>Paid, text.</p></div>']
FORMS = ['<form action="/s"><label>Search, here</label><input name=q value="x > y"><select><option>one<option>two</select><button>Go, now</button></form>']
COMMENTS = ['<section id="comments"><h2>2 comments</h2><article class="comment"><p>I liked it, very much, truly, so well written, thanks.</p></article>'
            '<div class="comment-body"><p>Me too, me too, me too, me too.</p></div></section>']
FOOTER = "<footer>&copy; a, b &middot; and c<p>All rights, as they say, reserved.</p></footer>"
TEMPLATES = [
    "{head}<body>{nav}<!-- ad --><article>{body}</article>{junk}{footer}</body></html>",
    "{head}<body><header><h1>The Paper</h1>{nav}</header><main><article>{body}</article>{junk}</main>{footer}</body></html>",
    '{head}<body class="has-sidebar">{menu}<div id="wrap"><div class="content with-sidebar">{body}</div><div class="sidebar">{junk}</div></div>{footer}',
    "{head}<body><table><tr><td>{menu}<td><div>{body}</div><tr><td>{junk}</table>{footer}",
    "{head}{nav}<div><div><div>{body}</div></div></div>{junk}{footer}",
    '{head}<body><form id="aspnet" action="/"><div>{menu}</div><section>{body}</section>{junk}</form>{footer}</body></html>',
]


def marked_up(rng, block):
    """A block's words as HTML: references, odd white space, inline markup, comments."""
    out = []
    for w in block.split():
        w = html.escape(w)
        kind = rng.randrange(12)
        w = {0: f"<b>{w}</b>", 1: f"<i>{w}", 2: f'<a href="/x?a=1&b=2">{w}</a>', 3: f"<!-- no, not this <p> -->{w}", 4: f"<span class=x>{w}</span>"}.get(kind, w)
        out.append(w + rng.choice([" ", "\n", " \t ", "<br>", "&#32;", "&nbsp;", " "]))
    return "".join(out)


def paragraphs(rng):
    """(kind, text) of an article's blocks."""
    out = [("h1", prose(rng, 6))]
    for _ in range(rng.randrange(3, 9)):
        kind = rng.choice(["p", "p", "p", "p", "h2", "li", "blockquote", "pre"])
        text = prose(rng, rng.randrange(30, 60) if kind == "p" else rng.randrange(5, 12)).replace(" w3", ", w3")
        out.append((kind, text + (" R&D <x> é中" if kind == "p" else "")))
    return out + [("p", prose(rng, 40) + "."), ("p", "Short.")]


def built(rng, blocks):
    body = ""
    for kind, text in blocks:
        inner = marked_up(rng, text)
        close = "" if kind in ("p", "li") and rng.random() < 0.4 else f"</{kind}>"
        body += f"<ul><li>{inner}</ul>" if kind == "li" else f"<{kind}>{inner}{close}" + rng.choice(["", "\n", "  "])
    return body


@pytest.mark.parametrize("template", TEMPLATES)
def test_known_blocks_come_back(template):
    rng = random.Random(template)
    for _ in range(40):
        blocks = paragraphs(rng)
        junk = "".join(rng.sample(NOTICES + ADVERTS + FORMS + COMMENTS, rng.randrange(1, 5)))
        page = template.format(head=HEAD, nav=NAV, menu=MENU, junk=junk, footer=FOOTER, body=built(rng, blocks))
        if rng.random() < 0.3:
            page = page.upper().replace("&NBSP;", "&nbsp;").replace("&AMP;", "&amp;").replace("&LT;", "&lt;").replace("&GT;", "&gt;").replace("&COPY;", "&copy;") \
                .replace("&MIDDOT;", "&middot;").replace("&QUOT;", "&quot;").replace("&#X27;", "&#x27;")
            blocks = [(k, t.upper()) for k, t in blocks]
        if template.endswith("</html>") and rng.random() < 0.3:
            page = page[:page.lower().rindex("</body")]
        assert main_text(page) == "\n".join(" ".join(t.split()) for _, t in blocks)


def test_siblings_of_the_container_are_kept():
    a, b = "one, two, three " * 20, "four, five " * 20
    page = f"<h1>Title here</h1><div class=menu><a href=/>x</a></div><div><p>{a}</p><p>{a}</p></div><div><p>{b}</p></div><p>A plain last word.</p><div><a href=/>m</a><p><a href=/>n</a></div>"
    assert main_text(page).split("\n") == [x.strip() for x in ("Title here", a, a, b, "A plain last word.")]


def test_link_lists_are_no_text():
    text = "words, and more words " * 12
    links = "".join(f"<li><a href='/{i}'>A long headline, with commas, number {i}</a></li>" for i in range(60))
    page = f"<body><div><ul>{links}</ul></div><div><p>{text}</p><ul><li>An item, of the text<li>Another <a href=/>one</a> of it</ul><p>{text}</p></div>"
    assert main_text(page) == "\n".join([text.strip(), "An item, of the text", "Another one of it", text.strip()])


def test_article_headers_give_their_headings():
    page = "<header><h1>Site</h1></header><article><header><h1>Title</h1><div>By me, today</div></header><p>Text, of it.</p><footer>Filed under x</footer></article>"
    assert main_text(page) == "Title\nText, of it."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain words, no markup", "plain words, no markup"), ("<p>a &lt; b &amp;amp; &copy &#65;&#x42; &bogus; &am", "a < b &amp; © AB &bogus; &am"),
    ("a < b and c > d <", "a < b and c > d <"), ("<p>cut <b", "cut"), ("<p title='a>b'>quoted", "quoted"), ('<p title="open>x</p><p>y</p>', "x\ny"),
    ("<!-- never closed <p>x", ""), ("<script>x", ""), ("<p>a<!-->b<!--->c", "abc"), ("<nav><a href=/>x</a>", ""), ("</div></p></table>x", "x"),
    ("<nav>menu<main><p>The text</p></main>", "The text"), ("<p>a<div>b</div>c</p>", "a\nb\nc"), ("<p>a&#xD800;&#0;b", "a��b")])
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages_take_linear_time():
    deep = "<div>" * 30_000 + "<p>in, the, depth</p>" + "</i></li></p>" * 30_000
    assert main_text(deep) == "in, the, depth"
    assert main_text("<p>a, b" * 50_000).count("\n") == 49_999
    assert main_text("<h2>x</h2>" * 40_000 + "<div><p>text, text, text</p></div>").endswith("text, text, text")
    assert main_text('<p a="' * 30_000) == ""


def test_extract_keeps_every_row(spark):
    page = f"{HEAD}<body>{NAV}<article><h1>A</h1><p>b, c</p></article>"
    rows = [(1, "u", page, "x", 1), (1, "u", page, "x", 1), (None, None, page, "x", 1), (2, "v", None, "x", 1), (3, "w", "", "x", 1), (4, "z", "<p>" + "a " * 400_000, "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in op11_html.extract(pages).collect()), key=repr)
    assert got == sorted(((i, u, main_text(h), len(main_text(h))) for i, u, h, _, _ in rows), key=repr)
    assert op11_html.extract(pages).columns == ["page_id", "url", "text", "n_chars"]
    assert op11_html.extract(pages.limit(0)).count() == 0


def test_query_over_the_given_pages(spark):
    """Every page of the given table is one article between a menu, an advert and a footer."""
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{folder}/pages.parquet").to_pylist()}
    got = op11_html.op11_html(spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        for tag in ("<p>", "</p>", "</h1>"):
            inner = inner.replace(tag, "\0")
        for tag in ("<h1>", "<b>", "</b>", "<br>"):
            inner = inner.replace(tag, " ")
        want = [" ".join(html.unescape(x).split()) for x in inner.split("\0")]
        assert r.text == "\n".join(x for x in want if x) and r.n_chars == len(r.text)
