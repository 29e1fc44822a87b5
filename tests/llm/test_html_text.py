"""HTML extraction: planted pages, broken ones, and the article elements of the whole table."""

import html
import re
import time

import pytest

from tests.conftest import SF
from vigilake.llm import html_text, queries
from vigilake.llm.common import table
from vigilake.llm.html_text import main_text

LONG = "It rained for most of the week, and the river rose above its banks; nobody in the village could remember such a spring."
PARTS = [
    "<header><a href='/'>Site</a> Daily news for everyone, every day, since 1900.</header>",
    "<div class='cookie-notice'>We use cookies, and so do our partners. By staying here you agree, of course, to all of them.</div>",
    "<aside><h3>More</h3><p>An unrelated teaser that is fairly long, with commas, and one full stop.</p></aside>",
    "<div id='left-sidebar'><p>Another teaser, also long, which says nothing about the text; really nothing.</p></div>",
    "<form><p>Enter your address here, please, so that we can write to you.</p><input name=q><button>Go</button></form>",
    "<ul class=menu><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul>",
    "<section class='comments'><article><p>I do not agree with this, not at all; it was dry where I live, and sunny too, all week.</p></article></section>",
    "<ol id=commentList><li>First!</li><li>A long remark by a reader, who knows better, as always, and says it twice.</li></ol>",
    "<script>if (a < b) { document.write('<p>no</p>') }</script><style>p > b { x: y }</style><noscript>Turn it on.</noscript>",
    "<div class='ad'>Buy this now, it is cheap, and it will not last long.</div><!-- <p>hidden</p> -->",
    "<div style='display: none'>Secret words, and more of them.</div><nav>Home, News, Sport</nav>",
]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>", "<div>{}</div>", "<div class='layout has-sidebar no-comments'><div class='body'>{}</div></div>"])
def test_main_text_only(wrap):
    body = f"<h1>The  river</h1><p>{LONG}</p><p>Short.</p><ul><li>{LONG}</li><li>so</li></ul><blockquote>{LONG}</blockquote><p>A <b>bold</b><i>er</i> word&nbsp;&amp; a<br>break.</p>"
    want = "\n".join(["The river", LONG, "Short.", LONG, "so", LONG, "A bolder word & a break."])
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{''.join(PARTS[:6])}{wrap.format(body)}{''.join(PARTS[6:])}<footer><p>&copy; us, all rights reserved, in all countries.</p></footer></body></html>"
    assert main_text(page) == want
    inner = wrap.format(body + PARTS[6] + PARTS[9])
    assert main_text(f"<body>{PARTS[0]}{inner}</body>") == want


def test_text_in_body():
    page = f"<body>{''.join(PARTS)}<h1>River</h1><p>{LONG}<p>Short.<p>{LONG}"
    assert main_text(page) == f"River\n{LONG}\nShort.\n{LONG}"


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<html><body></body></html>", ""),
        ("plain text, without markup", "plain text, without markup"),
        ("<article><h1>A</h1><p>B", "A\nB"),
        ("<article><p>a < b &lt; c &#233;&#x20AC; &am</p></article>", "a < b < c é€ &am"),
        ("<article><p>x<b>y<p>z</article>", "xy\nz"),
        ("<div class=ad>ad, never closed<article><p>The text, which is here.</p></article>", "The text, which is here."),
        ("<nav><a>a</a></nav><article><p>cut in a tag</p><p cla", "cut in a tag"),
        ("<article><p>open comment</p><!-- <p>gone</p>", "open comment"),
        ("<article><p>t</p><script>var x = '</p>'", "t"),
        ("<article><p title='a > b'>q</p></article>", "q"),
        ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
        ("<article><header><h1>Own title</h1></header><p>Text.</p><footer>Tags</footer></article>", "Own title\nText."),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    ],
)
def test_small_pages(page, want):
    assert main_text(page) == want


def test_ratios_tell_plain_elements_apart():
    """No element says what it is: only the paths' ratios do."""
    links = "".join(f"<div><a href='/{k}'>Link {k}</a></div>" for k in range(8))
    page = f"<body><div><div>{links}</div></div><div><div>{''.join(f'<p>{LONG}</p>' for _ in range(4))}<p>Short.</p></div></div><div><span>Contact</span><span>Imprint</span></div></body>"
    assert main_text(page) == "\n".join([LONG] * 4 + ["Short."])


def test_long_and_deep_pages_take_linear_time():
    begun = time.time()
    assert main_text("<article>" + f"<p>{LONG}</p>" * 20_000).count("\n") == 19_999
    assert main_text("<article>" + "<div>x" * 30_000).count("x") == 30_000
    assert main_text("<article>" + "<b>x" * 30_000) == "x" * 30_000
    main_text("<div>" * 30_000 + "</section></b>" * 30_000)
    main_text("<a " * 100_000)
    main_text("<" * 100_000 + "'" * 1000)
    assert time.time() - begun < 30


def test_rows_and_columns(spark):
    rows = [(1, "<article><p>a</p></article>", "k", "old"), (1, "<article><p>a</p></article>", "k", "old"), (None, None, None, None), (2, "", "k", None)]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, html string, extra string, text string"))
    assert out.columns == ["page_id", "extra", "text", "n_chars"]
    assert sorted(out.collect(), key=str) == sorted([(1, "k", "a", 1), (1, "k", "a", 1), (None, None, "", 0), (2, "k", "", 0)], key=str)
    assert html_text.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_query(spark):
    """The pages of the table have their text in one article: its blocks, by plain regular expressions."""
    pages = table(spark, SF, "pages").collect()
    got = {r.page_id: r for r in queries.op11_html_text(spark, SF).collect()}
    assert len(got) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:h1|p)>", "\0", body)).split("\0")
        want = "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert (got[p.page_id].url, got[p.page_id].text, got[p.page_id].n_chars) == (p.url, want, len(want))
