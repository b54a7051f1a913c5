import html
import re

import pytest

from quotaloom.llm import html_text, queries

SENTENCE = "The committee met on Tuesday and agreed to widen the northern road before winter sets in."
ARTICLE = [f"{SENTENCE} Part {i}." for i in range(6)]


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<div role='main'>%s</div>", "<div class=body>%s</div>"])
@pytest.mark.parametrize(
    "other",
    [
        "<nav><ul><li><a href='/'>Home</a></li><li>About us and what we do for everyone, all year round</li></ul></nav>",
        f"<header>{SENTENCE}</header>",
        f"<footer><p>{SENTENCE}</p><p>{SENTENCE}</p></footer>",
        f"<aside><p>{SENTENCE}</p></aside>",
        f"<div class='cookie-notice'><div>{SENTENCE}</div><div>{SENTENCE}</div></div>",
        f"<div id=sideBar><p>{SENTENCE}<p>{SENTENCE}</div>",
        f"<div class='ad'>{SENTENCE}</div>",
        f"<form><label>{SENTENCE}</label><textarea>{SENTENCE}</textarea></form>",
        f"<script>var s = '</p><p>{SENTENCE}';</script><style>p::after {{ content: '{SENTENCE}' }}</style>",
        f"<!-- <p>{SENTENCE}</p> -->",
        f"<section id='comments'><article class='comment'><p>{SENTENCE}</p></article></section>",
        f"<div hidden>{SENTENCE}</div><p style='display: none'>{SENTENCE}</p>",
        f"<div role='dialog'>{SENTENCE}</div>",
    ],
)
def test_other_parts_go(wrap, other):
    body = wrap % paragraphs(ARTICLE)
    want = "\n\n".join(ARTICLE)
    assert html_text.extract(page(other + body + other)) == want
    if "<header>" not in other:  # an article's own header is part of it
        assert html_text.extract(page(wrap % (paragraphs(ARTICLE[:3]) + other + paragraphs(ARTICLE[3:])))) == want


def test_surge_and_dive_points():
    menu = "".join(f"<div><a href='/{w}'>{w}</a></div>" for w in "Home News Sport Weather Contact".split())
    body = f"<div>{menu}</div><div><h2>A road</h2>{paragraphs(ARTICLE[:2])}<p>Short one.</p>{paragraphs(ARTICLE[2:])}</div><div>{menu}</div><div>Top</div>"
    assert html_text.extract(page(body)) == "\n\n".join(["A road", *ARTICLE[:2], "Short one.", *ARTICLE[2:]])
    # Two stretches of text with a long menu between them are both kept.
    assert html_text.extract(page(paragraphs(ARTICLE[:2]) + menu + paragraphs(ARTICLE[2:]))) == "\n\n".join(ARTICLE)


def test_short_blocks_of_a_declared_article_stay():
    assert html_text.extract(page("<article><h1>A</h1><p>b<p>c<ul><li>d<li>e</ul></article><p>" + SENTENCE)) == "A\n\nb\n\nc\n\nd\n\ne"


def test_blocks_and_references():
    got = html_text.extract(page("<article><p>a &amp; b&nbsp;&nbsp; c<br>\n d &#x41;&eacute &lt;i&gt; <b>e</b>f</p>\n\n<td>g</td><P CLASS=x>h</P></article>"))
    assert got == "a & b c d Aé <i> ef\n\ng\n\nh"


@pytest.mark.parametrize(
    "source,want",
    [
        ("", ""),
        ("no markup at all, only text", "no markup at all, only text"),
        ("<p", ""),
        ("<article><p>open <b>ended", "open ended"),
        ("<article>a</p></div></nav>b</article>", "a\n\nb"),
        ("<article><a title='x > y' href=z>in</a> 1 < 2 <3</article>", "in 1 < 2 <3"),
        ("<article>a<!-- never closed <p>b</p></article>", "a"),
        ("<article>a<script>never closed <p>b</p></article>", "a"),
        ("<div class='menu'><p>named badly</p></div>", "named badly"),
        ("<form><p>a form around all</p></form>", "a form around all"),
        ("<article><p>cut off</p><p cla", "cut off"),
        ("<article><nav><p>x<li>y</nav>z</article>", "z"),
    ],
)
def test_broken_pages(source, want):
    assert html_text.extract(source) == want


@pytest.mark.parametrize("piece", ["<", "<a", "<!", "<b>", "<td>x</td>", "<p>x<b>", "<a\">", "</p>", "&", "<!--", "<div>x"])
def test_long_pages(piece):
    html_text.extract("<b>" * 20_000 + piece * 40_000 + ">")


def test_messy_tables(spark):
    rows = [(1, "u", "<p>a</p>", "t"), (1, "u", "<p>a</p>", "t"), (None, None, None, None), (2, "v", "", "t"), (3, "w", "<p>x</p>" * 50_000, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.main_text(df)
    assert got.columns == ["page_id", "url", "text", "text_", "n_chars"]
    assert sorted(((r.page_id, r.text_[:3], r.n_chars) for r in got.collect()), key=str) == sorted(
        [(1, "a", 1), (1, "a", 1), (None, "", 0), (2, "", 0), (3, "x\n\n", 149_998)], key=str
    )
    assert html_text.main_text(df.limit(0)).collect() == []


def test_query_gives_whole_articles(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in queries.op11_html_text(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:  # these pages mark the article and its blocks alike
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", inside))
        want = "\n\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)
        assert got[r.page_id][1:] == (r.url, want, len(want))
